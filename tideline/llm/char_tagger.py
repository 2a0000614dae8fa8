"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Small on purpose: characters are reduced to a few kinds, so that the model learns the shape of
what surrounds a span and not its letters. Windows have one width; shorter ones are padded, and
padding is labelled as outside.
"""

from __future__ import annotations

import numpy as np

WIDTH = 64
#: Characters with a code of their own; the rest share codes by what they are.
MARKS = "@.+-()_%/:=,;\"'<> \n\t"
PAD, DIGIT, LOWER, UPPER, OTHER = range(5)
SYMBOLS = 5 + len(MARKS)

_ASCII = np.full(128, OTHER, np.int64)
for _code in range(128):
    _char = chr(_code)
    if _char in MARKS:
        _ASCII[_code] = 5 + MARKS.index(_char)
    elif _char.isdigit():
        _ASCII[_code] = DIGIT
    elif _char.isalpha():
        _ASCII[_code] = LOWER if _char.islower() else UPPER


def codes(text: str) -> np.ndarray:
    """A code for each code point; letters beyond ASCII count as lower case."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], LOWER)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Scores ``labels`` labels per character and decodes the best sequence."""

    def __init__(self, labels: int, embed: int = 8, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: rng.normal(0, (2 / sum(shape)) ** 0.5, shape)
        self.labels, self.hidden = labels, hidden
        self.w = {
            "embed": rng.normal(0, 0.5, (SYMBOLS, embed)),
            "x0": scale(embed, 4 * hidden), "h0": scale(hidden, 4 * hidden), "b0": np.zeros(4 * hidden),
            "x1": scale(embed, 4 * hidden), "h1": scale(hidden, 4 * hidden), "b1": np.zeros(4 * hidden),
            "out": scale(2 * hidden, labels), "bias": np.zeros(labels), "step": np.zeros((labels, labels)),
        }
        for name in ("b0", "b1"):
            self.w[name][hidden : 2 * hidden] = 1  # remember at first

    def _lstm(self, x: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        n, width, _ = x.shape
        k, w = self.hidden, self.w
        pre = x @ w[f"x{way}"] + w[f"b{way}"]
        h, c = np.zeros((n, k)), np.zeros((n, k))
        out, kept = np.empty((n, width, k)), [None] * width
        for t in range(width) if way == 0 else range(width - 1, -1, -1):
            z = pre[:, t] + h @ w[f"h{way}"]
            gates, new = _sigmoid(z[:, : 3 * k]), np.tanh(z[:, 3 * k :])
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            last_h, last_c = h, c
            c = f * c + i * new
            bent = np.tanh(c)
            h = o * bent
            out[:, t] = h
            kept[t] = (i, f, o, new, last_h, last_c, bent)
        return out, kept

    def _lstm_back(self, x: np.ndarray, way: int, kept: list, grad_out: np.ndarray, grads: dict) -> np.ndarray:
        n, width, _ = x.shape
        w = self.w[f"h{way}"]
        grad_z = np.empty((n, width, 4 * self.hidden))
        grad_h, grad_c = np.zeros((n, self.hidden)), np.zeros((n, self.hidden))
        for t in range(width - 1, -1, -1) if way == 0 else range(width):
            i, f, o, new, last_h, last_c, bent = kept[t]
            gh = grad_out[:, t] + grad_h
            gc = grad_c + gh * o * (1 - bent * bent)
            z = np.concatenate(
                [gc * new * i * (1 - i), gc * last_c * f * (1 - f), gh * bent * o * (1 - o), gc * i * (1 - new * new)], 1
            )
            grads[f"h{way}"] += last_h.T @ z
            grad_h, grad_c = z @ w.T, gc * f
            grad_z[:, t] = z
        flat = grad_z.reshape(-1, grad_z.shape[2])
        grads[f"x{way}"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[f"b{way}"] += flat.sum(0)
        return grad_z @ self.w[f"x{way}"].T

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Label scores of every character of windows of codes, ``(n, width, labels)``."""
        x = self.w["embed"][windows]
        both = np.concatenate([self._lstm(x, 0)[0], self._lstm(x, 1)[0]], axis=2)
        return both @ self.w["out"] + self.w["bias"]

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best labels of one sequence of scores, by Viterbi."""
        back = np.empty(scores.shape, np.int64)
        best = scores[0]
        for t in range(1, len(scores)):
            reach = best[:, None] + self.w["step"]
            back[t] = reach.argmax(0)
            best = reach.max(0) + scores[t]
        path = np.empty(len(scores), np.int64)
        path[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def _loss(self, windows: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold paths, and its gradient."""
        w, (n, width) = self.w, windows.shape
        x = w["embed"][windows]
        (ahead, kept0), (behind, kept1) = self._lstm(x, 0), self._lstm(x, 1)
        both = np.concatenate([ahead, behind], axis=2)
        scores, step = both @ w["out"] + w["bias"], w["step"]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, width):
            alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + step, 1) + scores[:, t]
        for t in range(width - 2, -1, -1):
            beta[:, t] = _logsum(step + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsum(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        path = scores[rows, np.arange(width), gold].sum(1) + step[gold[:, :-1], gold[:, 1:]].sum(1)
        grad = np.exp(alpha + beta - total[:, None, None])
        pairs = np.exp(
            alpha[:, :-1, :, None] + step + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ).sum((0, 1))
        np.subtract.at(pairs, (gold[:, :-1], gold[:, 1:]), 1)
        grad[rows, np.arange(width), gold] -= 1
        grads = {name: np.zeros_like(v) for name, v in w.items()}
        grads["step"] = pairs / n
        grad /= n
        grads["out"] = both.reshape(-1, both.shape[2]).T @ grad.reshape(-1, self.labels)
        grads["bias"] = grad.sum((0, 1))
        grad_both = grad @ w["out"].T
        grad_x = self._lstm_back(x, 0, kept0, grad_both[:, :, : self.hidden], grads)
        grad_x += self._lstm_back(x, 1, kept1, grad_both[:, :, self.hidden :], grads)
        np.add.at(grads["embed"], windows, grad_x)
        return float((total - path).mean()), grads

    def fit(self, windows: np.ndarray, gold: np.ndarray, steps: int = 240, batch: int = 48, rate: float = 0.02, seed: int = 7) -> float:
        """Adam on batches in a fixed order of chance; the mean loss of the last batches."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses = []
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(windows), min(batch, len(windows)))
            loss, grads = self._loss(windows[pick], gold[pick])
            losses.append(loss)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            pace = rate * min(1.0, 2 * (steps - t + 1) / steps)
            for name, grad in grads.items():
                grad = grad * min(1.0, 5 / (size + 1e-9))
                mean[name] = 0.9 * mean[name] + 0.1 * grad
                square[name] = 0.99 * square[name] + 0.01 * grad * grad
                self.w[name] -= pace * (mean[name] / (1 - 0.9**t)) / (np.sqrt(square[name] / (1 - 0.99**t)) + 1e-8)
        return float(np.mean(losses[-20:]))

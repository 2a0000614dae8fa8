"""Quality of a text as a sparse ensemble of rules over its statistics.

Shallow boosted trees over a bounded sample of labelled texts give conjunctions: each path from a
root is a rule. Logistic regression with an L1 penalty keeps few of them, and the score of a text
is a Spark column: the logistic function of the weights of the rules it meets.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import hashed_sample

#: Labelled rows that a model is fitted on at most, chosen by a hash of their id.
SAMPLE = 8_000
#: A text passes from this score on.
PASSES = 0.3
FOLDS = 5

STATISTICS = (
    "log_words", "mean_word", "distinct_words", "top_word", "distinct_pairs", "upper", "marks", "digits",
    "spaces", "sign_words", "marked_words", "repeated_lines", "line_words", "long_words", "entropy", "top_mark",
)

_KIND = np.zeros((5, 256))
for _b in range(256):
    _c = chr(_b)
    _KIND[0, _b] = _b >= 128 or _c.isalpha()
    _KIND[1, _b] = _b < 128 and _c.isupper()
    _KIND[2, _b] = _b < 128 and _c.isdigit()
    _KIND[3, _b] = _b in b" \t\n\v\f\r"
    _KIND[4, _b] = 32 < _b < 128 and not _c.isalnum()


def statistics(text: str | None) -> tuple[float, ...]:
    """The numbers rules are made of, all finite; a text without words has zeros for what it lacks."""
    data = (text or "").encode()
    size = max(1, len(data))
    counts = sum(
        (np.bincount(np.frombuffer(data[i : i + (1 << 20)], np.uint8), minlength=256) for i in range(0, len(data), 1 << 20)),
        np.zeros(256, np.int64),
    )
    letters, upper, digits, spaces, marks = _KIND @ counts
    words = data.split()
    n = max(1, len(words))
    known = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in data.split(b"\n") if line.strip()]
    share = counts[counts > 0] / size
    mark_counts = counts * _KIND[4]
    plain = {w: w.isascii() and not w.isalnum() for w in known}
    return (
        math.log1p(len(words)),
        sum(map(len, words)) / n,
        len(known) / n,
        max(known.values(), default=0) / n,
        pairs / max(1, len(words) - 1),
        upper / max(1.0, letters),
        marks / size,
        digits / size,
        spaces / size,
        sum(k for w, k in known.items() if plain[w] and not any(97 <= b <= 122 or 65 <= b <= 90 for b in w)) / n,
        sum(k for w, k in known.items() if plain[w]) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(len(words) / max(1, len(lines))),
        sum(k for w, k in known.items() if len(w) > 14) / n,
        float(-(share * np.log2(share)).sum()) if len(share) else 0.0,
        float(mark_counts.max()) / size,
    )


def with_statistics(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(t) for t in batch], dtype=object)

    return docs.withColumn(into, of(F.col(text)))


#: Conditions that hold together: a statistic's place, whether it is above, and of what.
Rule = tuple[tuple[int, bool, float], ...]


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    out = []
    for column in x.T:
        cut = np.unique(np.quantile(column, quantiles))
        out.append(cut[cut < column.max()])
    return out


def _tree(codes: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, depth: int, least: int, usable: np.ndarray):
    """Paths of one regression tree on the gradient, and its prediction for each row."""
    paths: list[Rule] = []
    out = np.zeros(len(grad))

    def grow(rows: np.ndarray, path: Rule, left: int) -> None:
        total, n = grad[rows].sum(), len(rows)
        best, split = 1e-9, None
        if left and n >= 2 * least:
            for f in usable:
                if not len(cuts[f]):
                    continue
                sums = np.bincount(codes[rows, f], grad[rows], len(cuts[f]) + 1).cumsum()[:-1]
                ns = np.bincount(codes[rows, f], minlength=len(cuts[f]) + 1).cumsum()[:-1]
                ok = (ns >= least) & (n - ns >= least)
                if ok.any():
                    safe = np.where(ok, ns, 1)
                    gain = np.where(ok, sums**2 / safe + (total - sums) ** 2 / np.where(ok, n - ns, 1) - total**2 / n, 0)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, split = gain[k], (int(f), k)
        if split is None:
            out[rows] = total / max(1, n)
            return
        f, k = split
        above = codes[rows, f] > k
        for side, part in ((False, rows[~above]), (True, rows[above])):
            longer = (*path, (f, side, float(cuts[f][k])))
            paths.append(longer)
            grow(part, longer, left - 1)

    grow(np.arange(len(grad)), (), depth)
    return paths, out


def _simplified(path: Rule) -> Rule:
    """The same conditions with one bound per statistic and side, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for f, above, cut in path:
        old = tight.get((f, above))
        tight[f, above] = cut if old is None else max(old, cut) if above else min(old, cut)
    return tuple(sorted((f, above, cut) for (f, above), cut in tight.items()))


def meets(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """Which rows (first axis) meet which rules."""
    out = np.ones((len(rules), len(x)), bool)
    for j, rule in enumerate(rules):
        for f, above, cut in rule:
            out[j] &= x[:, f] > cut if above else x[:, f] <= cut
    return out.T


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradient."""
    n, k = r.shape
    mean, spread = r.mean(0, dtype=float), np.maximum(r.std(0, dtype=float), 0.02)
    z = r - mean.astype(np.float32)
    z /= spread.astype(np.float32)
    lip = 0.25 * (1 + np.linalg.eigvalsh((z.T @ z).astype(float) / n)[-1] * 1.001)
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w = v = np.zeros(k)
    b = vb = math.log(rate / (1 - rate))
    t = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v.astype(np.float32) + vb))) - y
        new = v - z.T @ error.astype(np.float32) / n / lip
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / lip, 0)
        new_b = vb - error.mean() / lip
        ahead = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / ahead * (new - w), new_b + (t - 1) / ahead * (new_b - b)
        w, b, t = new, new_b, ahead
    w = w / spread
    return float(b - w @ mean), w


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + meets(list(self.rules), x) @ np.array(self.weights))))

    def column(self, statistics: str = "statistics") -> Column:
        """The score as a column over the array of statistics."""

        def holds(rule: Rule) -> Column:
            at = [F.col(statistics)[f] > F.lit(c) if up else F.col(statistics)[f] <= F.lit(c) for f, up, c in rule]
            return reduce(Column.__and__, at)

        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, seed: int = 11, most: int = 200) -> RuleModel:
    """A model of ``y`` (0 to 1). Without rows, or with one label alone, it is a constant."""
    n = len(y)
    rate = (y.sum() + 0.5) / (n + 1)
    constant = RuleModel(math.log(rate / (1 - rate)), (), ())
    if n < 20 or y.min() == y.max():
        return constant
    rng = np.random.default_rng(seed)
    cuts = _cuts(x, 32)
    codes = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], 1)
    margin, found = np.full(n, math.log(rate / (1 - rate))), {}
    for _ in range(trees):
        rows = rng.random(n) < 0.6
        usable = rng.choice(x.shape[1], max(4, x.shape[1] // 2), replace=False)
        grad = y - 1 / (1 + np.exp(-margin))
        paths, _ = _tree(codes[rows], cuts, grad[rows], depth, max(5, n // 400), usable)
        found.update(dict.fromkeys(map(_simplified, paths)))
        if paths:
            # A step towards the mean gradient of each leaf, over all rows.
            leaves = [p for p in paths if not any(q[: len(p)] == p and q != p for q in paths)]
            for member in meets(leaves, x).T:
                margin[member] += 1.2 * grad[member].mean() if member.any() else 0.0
    rules = list(found)
    if not rules:
        return constant
    r = meets(rules, x)
    # Rules that the same rows meet are one.
    first = {column.tobytes(): j for j, column in reversed(list(enumerate(np.packbits(r, axis=0).T)))}
    away, told = y - y.mean(), {}
    for j in first.values():
        share = r[:, j].mean()
        told[j] = abs(away[r[:, j]].sum()) / (n * math.sqrt(share * (1 - share))) if 0 < share < 1 else 0.0
    chosen = sorted(told, key=lambda j: (-told[j], j))[:most]
    rules, r = [rules[j] for j in chosen], r[:, chosen].astype(np.float32)
    check = np.arange(n) % 4 == 0
    best = (math.inf, 0.0)
    for penalty in (0.03, 0.01, 0.003, 0.001):
        b, w = _lasso(r[~check], y[~check], penalty, 200)
        p = np.clip(1 / (1 + np.exp(-(b + r[check] @ w))), 1e-6, 1 - 1e-6)
        loss = -float(np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)))
        best = min(best, (loss, penalty))
    b, w = _lasso(r, y, best[1])
    kept = [j for j in range(len(rules)) if abs(w[j]) > 1e-6]
    return RuleModel(b, tuple(rules[j] for j in kept), tuple(float(w[j]) for j in kept))


def _fold(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """A model of ``labels[label]``, which learns from no row of the held-out fold.

    Null labels and ids count for nothing; the labels of an id that has several are averaged.
    At most ``sample`` labelled ids, chosen by a hash, are looked up, and at most ``sample`` different
    rows of statistics come to the driver; the list of ids is small enough to be broadcast by that bound.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    known = known.where(_fold("_id") != 0).groupBy("_id").agg(F.avg("_y").alias("_y"))
    known = hashed_sample(known, sample, ["_id"])
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t"))
    found = with_statistics(texts.join(F.broadcast(known), "_id"), "_t", "_s").select("_id", "_y", "_s")
    rows = sorted(hashed_sample(found.distinct(), sample, ["_id", "_s"]).collect())
    x = np.array([r["_s"] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit_rules(x, np.array([r["_y"] for r in rows], float))


def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; null texts are scored as empty ones."""
    scored = with_statistics(docs, text, "_statistics").withColumn("score", model.column("_statistics"))
    return scored.withColumn("predicted", (F.col("score") >= PASSES).cast("int")).drop("_statistics")


def scores(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``; a missing id counts as empty text."""
    plain = docs.select("doc_id", "text").withColumn("held_out", _fold("doc_id") == 0)
    return score(plain, model).select("doc_id", "held_out", "score", "predicted")

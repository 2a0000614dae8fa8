"""Personal data: base patterns, and a character model that adds spans beyond them.

The patterns find what they define, in time that grows with the text alone. A bidirectional LSTM
with CRF transitions is trained from labelled spans in a bounded sample of windows: the base spans
of the texts, and the same texts with each span written in a form that the patterns miss or cut
short (see :func:`varied`). It reads windows that overlap, around every word that has a digit, an
@ or an at in brackets, without which no kind can be; the scores of overlapping windows are
averaged, each weighing most in its middle, and one path is decoded over the whole stretch. A span
it adds must still look like its kind and either touches no base span or contains those it
touches, one of its kind among them; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.char_tagger import PAD, WIDTH, Tagger, codes

KINDS = ("email", "ip", "card", "phone")
OUTSIDE, LABELS = 0, 1 + 2 * len(KINDS)  # 1, 3, ... begin a kind; 2, 4, ... go on with it
#: Windows the model learns from at most, and characters between the starts of two windows.
SAMPLE, STRIDE = 3000, 32
#: Batches the model is trained on.
STEPS = 500
#: Characters that the model reads on both sides of a word it reads, and windows at a time.
MARGIN, AT_ONCE = 24, 512
#: The sample is cut in as many parts by a hash; half of them are of windows with a span.
PARTS = 64

Span = tuple[int, int, int]  # start, place of its kind in KINDS, end (exclusive)

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits ends as the one from its beginning does, so the
# look-behind changes no match; without it a long run would be read again for each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({]at[\])}]", re.IGNORECASE)
_WORD = re.compile(r"\S+")
_SPELLED = re.compile(r"[^\s@]+ ?[\[({]at[\])}] ?[^\s@]+(?: ?[\[({]dot[\])}] ?[^\s@]+)*", re.IGNORECASE)
_PARTED = re.compile(r"[0-9]{1,3}(?:(?: ?\. ?|\[\.\])[0-9]{1,3}){3}")
_EXTENSION = re.compile(r",? ?(?:x|ext\.?|extension) ?[0-9]{1,6}$", re.IGNORECASE)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: a match has the longest local part that is still free before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str | None) -> list[Span]:
    """Spans by start, then kind; offsets count code points. None in null and empty texts.

    Matches of a kind are leftmost and do not overlap; one that fails its check is dropped and
    nothing else is tried in its place. Spans of different kinds may overlap.
    """
    if not text:
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # A part is compared without leading zeros, so that no long run is turned into a number.
            if all(len(p) < 4 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def varied(kind: int, text: str, pick: int) -> str:
    """A base span's text in another form of its kind, which the base patterns miss or cut short.

    Emails get a letter beyond ASCII or an at in brackets, addresses spaced or bracketed dots, cards
    dots or slashes between groups of four, phones an extension, slashes, or no plus.
    """
    digits = _digits(text)
    if kind == 0:
        local, _, domain = text.partition("@")
        middle = len(local) // 2
        spelled = domain.replace(".", " [dot] ")
        return (
            f"{local[:middle]}{'éüøñ'[pick // 5 % 4]}{local[middle + 1 :]}@{domain}",
            f"{local} [at] {spelled}", f"{local}[at]{domain}", f"{local} (at) {domain}", f"{local} [at] {domain}",
        )[pick % 5]
    if kind == 1:
        return text.replace(".", (" . ", "[.]")[pick % 2])
    if kind == 2:
        return "./"[pick % 2].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return (
        f"{text} ext. {pick // 4 % 90 + 10}", f"{text} x{pick // 4 % 900 + 100}",
        f"+{digits[:-10] or digits[:1]}/{digits[-10:-7]}/{digits[-7:]}", f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}",
    )[pick % 4]


def varied_text(text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The text with its spans in other forms, chosen by a hash of each; of spans that overlap the first."""
    parts, out, at, length = [], [], 0, 0
    for a, kind, b in spans:
        if a < at:
            continue
        form = varied(kind, text[a:b], xxhash.xxh32_intdigest(f"{text[a:b]}:{a}"))
        parts += [text[at:a], form]
        length += a - at
        out.append((length, kind, length + len(form)))
        length, at = length + len(form), b
    return "".join([*parts, text[at:]]), out


def _stretches(text: str) -> list[tuple[int, int]]:
    """Where the model reads: words that a span can have part in, with what lies around them, merged where they touch."""
    out: list[list[int]] = []
    for m in _WORD.finditer(text):
        if not _TRIGGER.search(text, m.start(), m.end()):
            continue
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _windows(low: int, high: int) -> Iterator[tuple[int, int]]:
    """Overlapping windows over a stretch."""
    for start in range(low, max(low + 1, high - WIDTH + STRIDE), STRIDE):
        yield start, min(start + WIDTH, high)


def _gold(spans: list[Span], start: int, end: int) -> np.ndarray:
    labels = np.zeros(WIDTH, np.int64)
    for a, kind, b in spans:
        if a < end and b > start and not labels[max(a, start) - start : min(b, end) - start].any():
            labels[max(a, start) - start : min(b, end) - start] = 2 + 2 * kind
            if a >= start:
                labels[a - start] = 1 + 2 * kind
    return labels


def _padded(text: str, start: int, end: int) -> np.ndarray:
    out = np.full(WIDTH, PAD, np.int64)
    out[: end - start] = codes(text[start:end])
    return out


def _labelled(text: str) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Part, hash, codes and labels of the windows of a text and of its varied form."""
    spans = base_spans(text)
    for one, found in [(text, spans), varied_text(text, spans)] if spans else [(text, spans)]:
        for stretch in _stretches(one):
            for a, b in _windows(*stretch):
                window = _padded(one, a, b).astype(np.int8).tobytes()
                labels = _gold(found, a, b).astype(np.int8).tobytes()
                digest = xxhash.xxh64_intdigest(window + labels) >> 1
                half = PARTS // 2
                yield digest % half + half * any(labels), digest, window, labels


def _first_of_parts(found: set[tuple], quota: int) -> set[tuple]:
    """The least ``quota`` windows of each part."""
    parts: dict[int, list] = {}
    for one in sorted(found):
        parts.setdefault(one[0], []).append(one)
    return {one for part in parts.values() for one in part[:quota]}


def training_windows(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` windows of codes with their labels, chosen by a hash of the window.

    Half of them at most are without a span. Each task cuts its windows to the sample's size, so
    only so many of a task are shuffled, and the sample does not depend on partitions.
    """
    quota = max(1, sample // PARTS)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[tuple] = set()
        for batch in batches:
            for one in batch["t"]:
                for window in _labelled(one):
                    found.add(window)
                    if len(found) > 8 * quota * PARTS:
                        found = _first_of_parts(found, quota)
        yield pd.DataFrame(sorted(_first_of_parts(found, quota)), columns=["part", "hash", "window", "labels"])

    rows = docs.select(F.col(text).alias("t")).where(F.col("t").rlike(r"(?i)[0-9@]|[\[({]at[\])}]"))
    windows = rows.mapInPandas(task, "part int, hash long, window binary, labels binary").distinct()
    order = Window.partitionBy("part").orderBy("hash", "window", "labels")
    return windows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= quota).select("window", "labels")


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """A model of the spans in a bounded sample; none where there is nothing to learn from."""
    rows = sorted(training_windows(docs, text, sample).collect())
    if not rows:
        return None
    windows = np.stack([np.frombuffer(r.window, np.int8).astype(np.int64) for r in rows])
    gold = np.stack([np.frombuffer(r.labels, np.int8).astype(np.int64) for r in rows])
    tagger = Tagger(LABELS)
    tagger.fit(windows, gold, steps=STEPS, batch=64)
    return tagger


def _looks_right(kind: int, text: str) -> bool:
    """What an added span must have; wider than the base patterns, and still telling."""
    digits = _digits(text)
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+[A-Za-z0-9]", text) or _SPELLED.fullmatch(text))
    if kind == 1:
        return bool(_PARTED.fullmatch(text)) and all(int(p) <= 255 for p in re.findall("[0-9]+", text))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 ./-]", text)
    number = _EXTENSION.sub("", text)
    return 10 <= len(_digits(number)) <= 15 and bool(re.search(r"[(+]", number)) and not re.search(r"[^0-9 ().+/-]", number)


_WEIGHT = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(float)


def model_spans(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """What the model alone finds in each text."""
    sums: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
    plan = []
    for i, text in enumerate(texts):
        stretches = _stretches(text)
        sums.append({low: (np.zeros((high - low, LABELS)), np.zeros((high - low, 1))) for low, high in stretches})
        plan += [(i, low, a, b) for low, high in stretches for a, b in _windows(low, high)]
    for k in range(0, len(plan), AT_ONCE):
        part = plan[k : k + AT_ONCE]
        scores = tagger.scores(np.stack([_padded(texts[i], a, b) for i, _, a, b in part]))
        for (i, low, a, b), score in zip(part, scores):
            total, weight = sums[i][low]
            w = _WEIGHT[: b - a, None]
            total[a - low : b - low] += w * score[: b - a]
            weight[a - low : b - low] += w
    out: list[list[Span]] = [[] for _ in texts]
    for i, stretches in enumerate(sums):
        for low, (total, weight) in stretches.items():
            path, start = tagger.decode(total / weight), None
            for t, label in enumerate([*path, OUTSIDE]):
                kind = (label - 1) // 2
                if start is not None and not (label and label % 2 == 0 and kind == start[1]):
                    out[i].append((low + start[0], start[1], low + t))
                    start = None
                if label % 2:
                    start = (t, int(kind))
    return out


def _adds(span: Span, base: list[Span]) -> bool:
    """Whether a span touches no base span, or contains all that it touches and extends one of its kind."""
    a, kind, b = span
    touched = [s for s in base if s[0] < b and a < s[2]]
    inside = all(a <= x and y <= b for x, _, y in touched)
    return not touched or (inside and span not in touched and any(k == kind for _, k, _ in touched))


def all_spans(texts: list[str | None], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) for t in texts]
    read = [i for i, t in enumerate(texts) if t and _TRIGGER.search(t)] if tagger else []
    added: list[list[Span]] = [[] for _ in texts]
    for i, found in zip(read, model_spans([texts[i] for i in read], tagger) if read else []):
        text = texts[i]
        for a, kind, b in found:
            while b > a and text[b - 1] in " .,;:\n\t":
                b -= 1
            while a < b and text[a] in " .,;:\n\t":
                a += 1
            if b > a and _looks_right(kind, text[a:b]) and _adds((a, kind, b), base[i]):
                added[i].append((a, kind, b))
    return list(zip(base, added))


def detect(docs: DataFrame, tagger: Tagger | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the number of base spans of each kind, ``base_sha256``, ``spans``, ``n_added``.

    One row per row of ``docs``; null and empty texts have no spans. ``base_sha256`` is of the
    base spans as :func:`written` writes them, ``spans`` has the added ones as well. Other
    columns are ignored.
    """
    counts = [f"n_{k}" for k in KINDS]

    @F.pandas_udf(", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string, n_added long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for base, added in all_spans(list(batch), tagger):
                n = [sum(1 for s in base if s[1] == k) for k in range(len(KINDS))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*n, digest, written(sorted(base + added)), len(added)))
            yield pd.DataFrame(rows, columns=[*counts, "base_sha256", "spans", "n_added"])

    return docs.select(F.col(doc_id).alias("doc_id"), of(F.col(text)).alias("d")).select("doc_id", "d.*")


def redact(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with each span in its texts replaced by its kind, as ``<EMAIL>``.

    Spans that overlap are replaced together, by the kind that starts first. Null texts stay null.
    """

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = list(batch), []
            for one, (base, added) in zip(texts, all_spans(texts, tagger)):
                parts, at, covered = [], 0, 0
                for a, kind, b in sorted(base + added):
                    if a >= covered:
                        parts += [one[at:a], f"<{KINDS[kind].upper()}>"]
                    at = covered = max(covered, b)
                out.append("".join([*parts, one[at:]]) if parts else one)
            yield pd.Series(out, dtype=object)

    return docs.withColumn(text, of(F.col(text)))

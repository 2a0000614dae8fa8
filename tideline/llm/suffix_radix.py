"""Repeated byte strings by a radix sort of suffixes that goes no deeper than the threshold.

Suffixes are told apart through their first ``threshold`` bytes only, in passes from the most
telling digit on; a bucket with one suffix needs no further pass, and the groups that are equal
after the last pass are exactly the repeated windows.

- A suffix's first digit is the gram that its window selects: the least in a hash of all the grams
  in the window. Equal windows select the same gram at the same place, and the suffixes around one
  gram stand next to each other, so a *run* of them moves as one row.
- Runs in one bucket that are equal as a whole are done. Others are cut into *pieces* of a few
  suffixes at fixed distances from the gram; their second digit is the *core*, the
  bytes that all windows of a piece share.
- What is left has the whole window as its last digit, one row per suffix.

Digits are 64-bit hashes, and each is compared among rows that agree in all digits before it, so
what counts as equal agrees in 128 bits at least. Buckets are counted by aggregation and joined
back, both of which share out a bucket that many rows fall into.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import Stored

#: Most suffixes a run can have; places and gram offsets fit a few bits by it.
RUN_BITS = 9

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(400).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9FB21C651E98DF25)
    return x ^ (x >> _U(28))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        power = np.full(size, _U(base))
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


class Hashes:
    """Rolling hashes of all substrings of some bytes."""

    def __init__(self, data: np.ndarray, size: int):
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def all(self, width: int) -> np.ndarray:
        return _mix((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width])


@dataclass(frozen=True)
class Depth:
    """The threshold, and the words that a run has if it is shorter than twice the threshold; a run
    with fewer stays. Other lengths change no result: how many suffixes a piece has, and how many
    bytes a task hashes at a time."""

    threshold: int = 400
    piece: int = 8
    chunk: int = 1 << 19
    words: int = 0

    @property
    def gram(self) -> int:
        return max(1, self.threshold // 2, self.threshold - (1 << RUN_BITS) + 2)

    @property
    def reach(self) -> int:
        """Grams of a window, which bounds the suffixes of a run."""
        return self.threshold - self.gram + 1


def _selected(grams: np.ndarray, reach: int) -> np.ndarray:
    """Place of the least gram, the first of equal ones, in each ``reach`` of them."""
    n = len(grams) - reach + 1
    blocks = -(-len(grams) // reach)
    keys = np.full(blocks * reach, ~_U(0))
    keys[: len(grams)] = (grams >> _U(28) << _U(28)) | np.arange(len(grams), dtype=np.uint64)
    square = keys.reshape(blocks, reach)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n])
    return (least & _U((1 << 28) - 1)).astype(np.int64)


def _runs_of_chunk(data: np.ndarray, ends: np.ndarray, depth: Depth, size: int):
    """First suffix, count, offset of the gram, gram and whole of each run; ``ends`` has, for each
    byte, where its text ends."""
    t = depth.threshold
    hashes = Hashes(data, size)
    grams = hashes.all(depth.gram)
    at = _selected(grams, depth.reach)
    n = len(data) - t + 1
    valid = np.arange(n) + t <= ends[:n]
    new = np.ones(n + 1, bool)
    new[1:-1] = (at[1:] != at[:-1]) | ~valid[:-1] | ~valid[1:]
    first = np.flatnonzero(new[:-1] & valid)
    last = np.flatnonzero(new[1:] & valid)
    offset = at[first] - first
    whole = hashes.of(first, last + t) ^ _mix(offset.astype(np.uint64) + _U(7) * (last - first).astype(np.uint64))
    return first, last - first + 1, offset, grams[at[first]], _mix(whole)


def runs(texts: list[bytes], depth: Depth) -> tuple[np.ndarray, ...]:
    """Text number, first suffix, count, gram offset, gram and whole of every run."""
    t, chunk = depth.threshold, depth.chunk
    size = chunk + t
    found = []
    part: list[tuple[int, int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal part, held
        if part:
            lengths = np.array([len(b) for _, _, b in part])
            stops = np.cumsum(lengths)
            data = np.frombuffer(b"".join(b for _, _, b in part), np.uint8)
            first, count, offset, gram, whole = _runs_of_chunk(data, np.repeat(stops, lengths), depth, size)
            unit = np.searchsorted(stops, first, "right")
            shift = np.array([at for _, at, _ in part]) - (stops - lengths)
            found.append((np.array([i for i, _, _ in part])[unit], first + shift[unit], count, offset, gram, whole))
        part, held = [], 0

    for i, text in enumerate(texts):
        for at in range(0, len(text) - t + 1, chunk):
            piece = text[at : at + chunk + t - 1]
            if held + len(piece) > size:
                flush()
            part.append((i, at, piece))
            held += len(piece)
    flush()
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal ones, in order; touching ones are joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(new[1:], True)]


# --- rows -----------------------------------------------------------------------------------------
# ``place`` packs a check of the text's key, a first suffix, a count and an offset into one number.


def _pack(tag, first, count, offset):
    return tag << 49 | first << 18 | count << RUN_BITS | offset


def _unpacked(place: str) -> dict[str, Column]:
    mask = (1 << RUN_BITS) - 1
    return {
        "tag": F.shiftright(place, 49).cast("int"),
        "first": F.shiftright(place, 18).bitwiseAND(0x7FFFFFFF).cast("int"),
        "count": F.shiftright(place, RUN_BITS).bitwiseAND(mask).cast("int"),
        "offset": F.col(place).bitwiseAND(mask).cast("int"),
    }


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64) if x.dtype.kind == "u" else x.astype(np.int64))


def _int(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32))


def _grouped(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merged intervals of each owner."""
    # Owners one after the other on one line, so far apart that their intervals never touch.
    step = int(end.max(initial=0)) + 2
    base = owner.astype(np.int64) * step
    s, e = merged(base + start, base + end)
    return s // step, s % step, e - s // step * step


def _run_rows(docs: DataFrame, depth: Depth) -> DataFrame:
    """Runs of all texts.

    Those that a text has twice are settled here: rows with ``until`` are intervals to remove, and
    one run of each kind stays with ``times`` two, to match the runs of others.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, tags = (batch.column(c).to_numpy().astype(np.int64) for c in ("key", "tag"))
            text, first, count, offset, gram, whole = runs(batch.column("body").to_pylist(), depth)
            order = np.lexsort((whole, gram, text))
            again = np.zeros(len(order), bool)
            again[1:] = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in (text, gram, whole)])
            twice = again.copy()
            twice[:-1] |= again[1:]
            kept, settled = order[~again], order[twice]
            n = len(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    _long(gram[kept]), _long(whole[kept]), _long(keys[text[kept]]),
                    _long(_pack(tags[text], first, count, offset)[kept]), _int(1 + twice[~again]), pa.nulls(n, pa.int32()),
                ],
                names=_RUN_NAMES,
            )
            i, start, end = _grouped(text[settled], first[settled], first[settled] + count[settled] - 1 + depth.threshold)
            none = np.zeros(len(i), np.int64)
            yield pa.RecordBatch.from_arrays(
                [_long(none), _long(none), _long(keys[i]), _long(_pack(tags[i], start, 0, 0)), _int(none), _int(end)],
                names=_RUN_NAMES,
            )

    return docs.select("key", "tag", "body").mapInArrow(task, _RUN_SCHEMA)


_RUN_SCHEMA = "gram long, whole long, key long, place long, times int, until int"
_RUN_NAMES = ["gram", "whole", "key", "place", "times", "until"]


def _refined(rows: DataFrame, digit: str, used: list[Stored]) -> DataFrame:
    """``rows`` whose bucket (``gram`` and ``digit``) holds another one.

    ``alike``: all of the bucket are equal as a whole. Otherwise they go on to the next digit.
    """
    by = ["gram"] if digit == "gram" else ["gram", digit]
    buckets = rows.groupBy(*by).agg(
        F.sum("times").alias("_n"), F.min("whole").alias("_low"), F.max("whole").alias("_high")
    )
    held = buckets.where("_n > 1").select(*by, (F.col("_low") == F.col("_high")).alias("alike"))
    return rows.join(_kept(held, "counted", used).hint("merge"), by)


def _kept(df: DataFrame, name: str, used: list[Stored]) -> DataFrame:
    """``df`` as a stored table, noted in ``used``.

    Counts that are joined as they come would be tied to the layout they were counted in, and a
    bucket that holds many of the other side's rows could not be split. They grow with the input and
    are several times larger in memory than in files, so joins with them broadcast nothing.
    """
    used.append(Stored(df, name))
    return used[-1].df


# What a text's row says about one of its intervals or runs.
_REMOVE, _CUT, _MATCH = 0, 1, 2


def _first_passes(found: DataFrame, depth: Depth, used: list[Stored]) -> DataFrame:
    """``key, tag`` and the list of what the first two digits say about each text."""
    judged = _kept(_refined(found.where("times > 0"), "gram", used).drop("until"), "judged", used)
    mixed = judged.where("NOT alike")
    wholes = mixed.groupBy("gram", "whole").agg(
        F.sum("times").alias("n"), F.min(F.struct("key", "place")).alias("one")
    )
    mixed = mixed.join(_kept(wholes, "counted", used).hint("merge"), ["gram", "whole"]).withColumn("repeated", F.col("n") > 1)
    settled = (
        judged.where("alike").select("key", "place", "times").union(mixed.where("repeated").select("key", "place", "times"))
    ).where("times = 1")
    # Of runs that are equal as a whole one is enough to match the others of the bucket.
    onward = mixed.where(~F.col("repeated") | (F.struct("key", "place") == F.col("one"))).select(
        "key", "place", F.when(F.col("repeated"), _MATCH).otherwise(_CUT).alias("say"), "gram"
    )
    none = F.lit(0).cast("long")
    told = (
        settled.select("key", "place", F.lit(_REMOVE).alias("say"), none.alias("gram"), F.lit(None).cast("int").alias("until"))
        .union(onward.select("*", F.lit(None).cast("int")))
        .union(found.where("until IS NOT NULL").select("key", "place", F.lit(_REMOVE), none, "until"))
    )
    told = told.withColumns(_unpacked("place"))
    # Rows that are the same in all columns share their key and say the same: a set has it once.
    end = F.coalesce("until", F.col("first") + F.col("count") - 1 + depth.threshold)
    return told.groupBy("key", "tag").agg(
        F.collect_set(F.struct("say", "first", end.alias("until"), "offset", "gram")).alias("told")
    )


def _pieces(data: bytes, first: int, count: int, offset: int, depth: Depth):
    """Core, whole, first suffix and window digits of the pieces of one run."""
    t = depth.threshold
    part = np.frombuffer(data, np.uint8, count - 1 + t, first)
    hashes = Hashes(part, depth.chunk + t)
    windows = hashes.all(t)
    steps = np.arange(count)
    kind = (offset - steps) // depth.piece  # by distance from the gram, which does not depend on the run
    at = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    last = np.append(at[1:], count) - 1
    kind = kind[at]
    low = offset - depth.piece * kind  # the core: what the windows at these distances all have
    core = _mix(hashes.of(low, low - depth.piece + 1 + t) ^ _mix(kind.astype(np.uint64) + _U(1)))
    extent = ((offset - at) << RUN_BITS) + last - at
    whole = _mix(hashes.of(at, last + t) ^ _mix(extent.astype(np.uint64)))
    return core, whole, first + at, windows, np.append(at, count)


def cut_out(data: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    at, out = 0, []
    for s, e in zip(start.tolist(), end.tolist()):
        out.append(data[at:s])
        at = e
    return b"".join([*out, data[at:]])


def cut_text(data: bytes, start: np.ndarray, end: np.ndarray) -> str:
    """What is left as text: characters that lie in a removed run only in part stay whole."""
    begins = lambda i: i >= len(data) or data[i] & 0xC0 != 0x80
    s, e = start.copy(), end.copy()
    for k in range(len(s)):
        while not begins(s[k]):
            s[k] += 1
        while not begins(e[k]):
            e[k] -= 1
    return cut_out(data, s, e).decode()


_OUT_SCHEMA = "n_bytes long, n_removed long, n_spans long, kept string, kept_sha256 string"
_OUT_NAMES = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]


def _with_words(body: bytes, start: np.ndarray, end: np.ndarray, depth: Depth) -> tuple[np.ndarray, np.ndarray]:
    """The runs that go for their words or their length."""
    enough = [
        b - a >= 2 * depth.threshold or len(body[a:b].split()) >= depth.words for a, b in zip(start.tolist(), end.tolist())
    ]
    return start[np.array(enough, bool)], end[np.array(enough, bool)]


def _results(bodies: list[bytes], spans: list[tuple[np.ndarray, np.ndarray]], depth: Depth) -> list[pa.Array]:
    if depth.words:
        spans = [_with_words(b, s, e, depth) for b, (s, e) in zip(bodies, spans)]
    kept = [cut_text(b, s, e) for b, (s, e) in zip(bodies, spans)]
    digests = [hashlib.sha256(cut_out(b, s, e)).hexdigest() for b, (s, e) in zip(bodies, spans)]
    return [
        _long(np.array([len(b) for b in bodies])),
        _long(np.array([int((e - s).sum()) for s, e in spans])),
        _long(np.array([len(s) for s, _ in spans])),
        pa.array(kept, pa.string()),
        pa.array(digests, pa.string()),
    ]


def _lists(column: pa.Array, fields: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each row the fields of its list of structs; empty for null."""
    flat = column.flatten()
    values = [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]
    at = 0
    lengths = column.value_lengths().fill_null(0).to_numpy()
    for n in lengths.tolist():
        yield tuple(v[at : at + n] for v in values)
        at += n


def _open_texts(texts: DataFrame, depth: Depth) -> DataFrame:
    """Results of the texts that are settled; the others keep their bytes and get their pieces."""
    pieces_type = pa.list_(
        pa.struct([("gram", pa.int64()), ("core", pa.int64()), ("whole", pa.int64()), ("first", pa.int32()),
                   ("times", pa.int32()), ("windows", pa.list_(pa.int64()))])
    )
    intervals_type = pa.list_(pa.struct([("first", pa.int32()), ("until", pa.int32())]))
    schema = (
        f"rest {texts.schema['rest'].dataType.simpleString()}, key long, tag int, {_OUT_SCHEMA}, body binary, "
        "known array<struct<first:int,until:int>>, "
        "pieces array<struct<gram:long,core:long,whole:long,first:int,times:int,windows:array<long>>>"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            spans, pieces, wide = [], [], []
            for body, (say, first, until, offset, gram) in zip(
                bodies, _lists(batch.column("told"), ("say", "first", "until", "offset", "gram"))
            ):
                gone = say == _REMOVE
                spans.append(merged(first[gone].astype(np.int64), until[gone].astype(np.int64)))
                wide.append(bool((say == _CUT).any()))
                own = []
                for k in np.flatnonzero(~gone):
                    n = int(until[k]) - int(first[k]) + 1 - depth.threshold
                    core, whole, at, windows, cuts = _pieces(body, int(first[k]), n, int(offset[k]), depth)
                    own.append((int(gram[k]), core, whole, at, 1 + int(say[k] == _MATCH), windows, cuts))
                pieces.append(own)
            flat = [p for own in pieces for p in own]
            joined = lambda k, kind: np.concatenate([p[k] for p in flat]) if flat else np.empty(0, kind)
            counts = np.array([len(p[1]) for p in flat], np.int64)
            sizes = np.concatenate([np.diff(p[6]) for p in flat]) if flat else np.empty(0, np.int64)
            structs = pa.StructArray.from_arrays(
                [
                    _long(np.repeat(np.array([p[0] for p in flat], np.int64), counts)),
                    _long(joined(1, np.uint64)), _long(joined(2, np.uint64)), _int(joined(3, np.int64)),
                    _int(np.repeat(np.array([p[4] for p in flat], np.int64), counts)),
                    pa.ListArray.from_arrays(_int(np.append(0, np.cumsum(sizes))), _long(joined(5, np.uint64))),
                ],
                names=[f.name for f in pieces_type.value_type],
            )
            ends = np.cumsum([sum(len(p[1]) for p in own) for own in pieces], dtype=np.int64)
            known = [
                [{"first": a, "until": b} for a, b in zip(s.tolist(), e.tolist())] if w else None
                for (s, e), w in zip(spans, wide)
            ]
            names = ["rest", "key", "tag", *_OUT_NAMES, "body", "known", "pieces"]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rest"), batch.column("key"), batch.column("tag"), *_results(bodies, spans, depth),
                    pa.array([b if w else None for b, w in zip(bodies, wide)], pa.binary()),
                    pa.array(known, intervals_type),
                    pa.ListArray.from_arrays(_int(np.append(0, ends)), structs),
                ],
                names=names,
            )

    return texts.select("rest", "key", "tag", "body", "told").mapInArrow(task, schema)


def _last_passes(opened: DataFrame, depth: Depth, used: list[Stored]) -> DataFrame:
    """``key, tag`` and the intervals that the pieces and single suffixes add."""
    pieces = opened.where("size(pieces) > 0").select("key", "tag", F.explode("pieces").alias("p")).select("key", "tag", "p.*")
    judged = _kept(_refined(pieces, "core", used), "pieces", used)
    # Two rows of one bucket are no two texts' if one of them stands for many; those have two times.
    settled = judged.where("alike AND times = 1").select(
        "key", "tag", "first", (F.col("first") + F.size("windows") - 1 + depth.threshold).alias("until")
    )
    single = judged.where("NOT alike").select(
        "key", "tag", "first", "times", F.xxhash64("gram", "core").alias("bucket"), F.posexplode("windows").alias("nth", "digit")
    )
    repeated = single.groupBy("bucket", "digit").agg(F.sum("times").alias("n")).where("n > 1").drop("n")
    last = (
        single.where("times = 1")
        .join(_kept(repeated, "counted", used).hint("merge"), ["bucket", "digit"])
        .select("key", "tag", (F.col("first") + F.col("nth")).alias("first"))
        .withColumn("until", F.col("first") + depth.threshold)
    )
    return settled.union(last).groupBy("key", "tag").agg(F.collect_set(F.struct("first", "until")).alias("added"))


def _closed_texts(opened: DataFrame, schema_of: DataFrame, depth: Depth) -> DataFrame:
    schema = f"rest {schema_of.schema['rest'].dataType.simpleString()}, {_OUT_SCHEMA}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(*(_lists(batch.column(c), ("first", "until")) for c in ("known", "added")))
            spans = [
                merged(np.append(a[0], b[0]).astype(np.int64), np.append(a[1], b[1]).astype(np.int64)) for a, b in both
            ]
            out = _results(batch.column("body").to_pylist(), spans, depth)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *out], names=["rest", *_OUT_NAMES])

    return opened.select("rest", "body", "known", "added").mapInArrow(task, schema)


def _dropped(used: list[Stored]) -> None:
    while used:
        used.pop().drop()


def without_repeats(docs: DataFrame, text: str = "text", depth: Depth = Depth()) -> DataFrame:
    """Each row of ``docs`` without the bytes of strings as long as the threshold that stand elsewhere too.

    Elsewhere is any other place of any text, the same text included; places may overlap, and all
    of them are judged on the input. The result has the columns of ``docs`` but ``text`` in a
    struct ``rest``, and ``n_bytes, n_removed, n_spans, kept, kept_sha256``: the UTF-8 length, how
    many bytes and maximal runs go, what is left as text, where a character that would go in part
    stays, and the SHA-256 of the bytes that are left. Null texts count as empty; rows that are the
    same in all columns count as texts of their own, so all lose what is long enough. With
    ``depth.words`` a maximal run shorter than twice the threshold goes only if it has that many words.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    named = [c.cast("string") for c in rest]
    texts = docs.select(
        F.struct(*rest).alias("rest") if rest else F.struct(F.lit(None).cast("int").alias("_")).alias("rest"),
        F.xxhash64(F.lit(1), body, *named).alias("key"),
        F.pmod(F.xxhash64(F.lit(2), *named, body), F.lit(1 << 14)).cast("int").alias("tag"),
        body.alias("body"),
    )
    used: list[Stored] = []
    found = _kept(_run_rows(texts.where(F.length("body") >= depth.threshold), depth), "runs", used)
    told = Stored(_first_passes(found, depth, used), "told")
    _dropped(used)
    opened = Stored(_open_texts(texts.join(told.df, ["key", "tag"], "left"), depth), "opened").df
    told.drop()
    added = Stored(_last_passes(opened, depth, used), "added").df
    _dropped(used)
    unsettled = opened.where("body IS NOT NULL").select("rest", "key", "tag", "body", "known")
    closed = _closed_texts(unsettled.join(added, ["key", "tag"], "left"), opened, depth)
    return opened.where("body IS NULL").select("rest", *_OUT_NAMES).union(closed)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: Depth = Depth()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text``, one row per row of ``docs``.

    ``text`` is what is left, as :func:`without_repeats` has it.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = without_repeats(plain, "text", depth)
    return out.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"))

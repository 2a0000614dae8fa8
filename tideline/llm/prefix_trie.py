"""Prefix trie of conversations, by vertical bitmaps.

Conversations are dealt by ranges of ids into *shards* of a bounded number of conversations. A
shard indexes each (position, turn) to the bitset of its conversations that have that turn
there, and each length to the bitset of those that end there. Depth-first, the children of a node
are the intersections of its bitset with the postings of the next position; popcounts are the
members, and members that end at the node are its end list. What shards find is added up by the
key of the prefix, so no shard needs a whole subtree and a first turn that a third of all
conversations share is counted in every shard on its own.

Sums over subtrees take one round for each power of two below the deepest shared node: after
round k a node has summed all that lies less than ``2 ** (k + 1)`` below it, by adding what the
nodes ``2 ** k`` below it had. Nodes with one member have no shared node below them, need no
sums, and stay out of the rounds.

Turns are compared by an MD5 of role and text and prefixes by BLAKE2b over these, 128 bits each;
texts themselves are not moved.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import Stored

#: A rebuilt conversation starts with turns of the first of ``GROUP`` ids, fewer than ``HEADS``.
GROUP, HEADS = 5, 9
#: Bounds of a shard; the conversation that reaches the second one is its last.
CONVERSATIONS, TURNS = 2048, 100_000
#: Bytes of a key, and nodes in a batch.
KEY, BATCH = 16, 16_384
ROOT = b"\0" * KEY
EMPTY = hashlib.sha256(b"").hexdigest()

_PARTS = "key binary, depth long, n long, conv_id long, bytes long, ancestors binary, ends string"
_ARROW = pa.schema([
    ("key", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()), ("conv_id", pa.int64()),
    ("bytes", pa.int64()), ("ancestors", pa.binary()), ("ends", pa.string()),
])


def borrowed(conv_id: int) -> int:
    """How many turns a rebuilt conversation takes from the first of its group."""
    return zlib.crc32(b"%d" % conv_id) % HEADS


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """Names a turn by role and text; null ones are empty."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary"))


class Shard:
    """Conversations ``(conv_id, digests, lengths)`` and the nodes of their trie."""

    def __init__(self, rows: list[tuple[int, list[bytes], list[int]]]):
        self.rows = sorted(rows, key=lambda r: r[0])
        sizes = sorted(len(r[1]) for r in rows)
        # Beyond the second longest there is one conversation, and nothing to intersect.
        shared = sizes[-2] if len(sizes) > 1 else 0
        self.postings: list[dict[bytes, int]] = [{} for _ in range(shared)]
        self.ends: dict[int, int] = {}
        for i, (_, digests, _) in enumerate(self.rows):
            bit = 1 << i
            self.ends[len(digests)] = self.ends.get(len(digests), 0) | bit
            for at, digest in zip(self.postings, digests):
                at[digest] = at.get(digest, 0) | bit

    def _ids(self, bits: int) -> str:
        out = []
        while bits:
            low = bits & -bits
            out.append(str(self.rows[low.bit_length() - 1][0]))
            bits ^= low
        return ",".join(out)

    def nodes(self) -> Iterator[tuple]:
        """Rows of ``_PARTS``, parents before their children."""
        path = [ROOT]
        stack = [(0, (1 << len(self.rows)) - 1, ROOT)]
        while stack:
            depth, bits, key = stack.pop()
            del path[depth:]
            path.append(key)
            first = (bits & -bits).bit_length() - 1
            conv_id, digests, lengths = self.rows[first]
            if bits & (bits - 1) == 0:
                # One member: the rest of its turns is a chain.
                for at in range(depth, len(digests) + 1):
                    if at > depth:
                        path.append(_next(path[-1], digests[at - 1]))
                    yield (path[at], at, 1, conv_id, lengths[at - 1] if at else 0, _above(path, at),
                           str(conv_id) if at == len(digests) else None)
                continue
            ended = bits & self.ends.get(depth, 0)
            yield (key, depth, bits.bit_count(), conv_id, lengths[depth - 1] if depth else 0, _above(path, depth),
                   self._ids(ended) if ended else None)
            rest = bits & ~ended
            while rest:
                digest = self.rows[(rest & -rest).bit_length() - 1][1][depth]
                child = rest & self.postings[depth][digest] if depth < len(self.postings) else rest
                rest ^= child
                stack.append((depth + 1, child, _next(key, digest)))


def _next(key: bytes, digest: bytes) -> bytes:
    return hashlib.blake2b(key + digest, digest_size=KEY).digest()


def _above(path: list[bytes], depth: int) -> bytes:
    """Keys of the ancestors 1, 2, 4 ... levels up, one after the other."""
    return b"".join([path[depth - (1 << k)] for k in range(depth.bit_length())])


def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """Rebuilt conversations from rows ordered by group, first of the group first, id and turn."""
    held: tuple[int, list[bytes], list[int]] | None = None
    head: tuple[int | None, list[bytes], list[int]] = (None, [], [])

    def done() -> tuple[int, list[bytes], list[int]]:
        nonlocal head
        conv_id, digests, lengths = held
        base = int(np.fmod(conv_id, GROUP))
        if base == 0:
            head = (conv_id, digests[: HEADS - 1], lengths[: HEADS - 1])
            return held
        h = borrowed(conv_id)
        there = head if head[0] == conv_id - base else (None, [], [])
        return conv_id, there[1][:h] + digests[h:], there[2][:h] + lengths[h:]

    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        digests, lengths = batch.column("digest").to_pylist(), batch.column("bytes").to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if held is not None and held[0] != ids[low]:
                yield done()
                held = None
            if held is None:
                held = (int(ids[low]), [], [])
            held[1].extend(digests[low:high])
            held[2].extend(lengths[low:high])
    if held is not None:
        yield done()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    def found(rows: list) -> Iterator[pa.RecordBatch]:
        for node in Shard(rows).nodes():
            out.append(node)
            if len(out) >= BATCH:
                yield packed()

    rows: list = []
    turns = 0
    for one in rebuilt(batches):
        # A group stays whole, so that the ids of shards lie one after the other.
        full = len(rows) >= CONVERSATIONS or turns >= TURNS
        if full and _base(one[0]) != _base(rows[-1][0]):
            yield from found(rows)
            rows, turns = [], 0
        rows.append(one)
        turns += len(one[1])
    if rows:
        yield from found(rows)
    if out:
        yield packed()


def _base(conv_id: int) -> int:
    return conv_id - int(np.fmod(conv_id, GROUP))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of end lists that arrive in pieces, one key after the other; holds one piece."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        for here, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if here == key:
                state.update(b",")
            else:
                if key is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = here, hashlib.sha256()
            state.update(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def parts(turns: DataFrame) -> DataFrame:
    """The nodes each shard finds: ``_PARTS``, a node once for each shard that has it."""
    conv_id = F.col("conv_id").cast("bigint")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = turns.where("conv_id IS NOT NULL").select(
        (conv_id - conv_id % GROUP).alias("base"),
        (conv_id % GROUP != 0).alias("later"),
        conv_id.alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(turn_digest()).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    dealt = narrow.repartitionByRange("base").sortWithinPartitions("base", "later", "conv_id", "turn", "digest")
    return dealt.select("conv_id", "digest", "bytes").mapInArrow(_shards, _PARTS)


def _ancestor(k: int) -> Column:
    return F.substring("ancestors", KEY * k + 1, KEY)


def subtree_sums(shared: DataFrame, levels: int) -> DataFrame:
    """``key, n_leaves, saved_tokens`` over the subtrees of nodes with their own of both.

    ``levels`` is how many ancestors the deepest node names. Every round is stored: it is read
    twice by the next.
    """
    for k in range(levels):
        above = shared.where(F.octet_length("ancestors") > KEY * k)
        below = above.groupBy(_ancestor(k).alias("key")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        added = shared.join(below, "key", "left").select(
            "key", "ancestors",
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
        )
        shared = Stored(added, "trie-sums").df
    return shared.select("key", "n_leaves", "saved_tokens")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, from rows ``conv_id, turn, role, text``.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``, one row per distinct sequence of first turns. Turns are ordered by ``turn``,
    null first, and by the MD5 of role and text where it repeats; repeated rows are turns of
    their own. Rows without ``conv_id`` belong to no conversation; null role and text are empty;
    other columns are ignored. Without conversations there is no node.

    A task holds one shard, or one conversation's digests where that is longer.
    """
    found = Stored(parts(turns), "trie-parts").df
    keys = ["key", "depth", "bytes", "ancestors"]
    nodes = Stored(
        found.groupBy(*keys).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-nodes"
    ).df
    parent = _ancestor(0)
    below = nodes.where("depth > 0").select(parent.alias("key"), "n_convs")
    children = below.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("_single")
    )
    # A child with one member is the top of a chain: one leaf.
    own = nodes.where("n_convs > 1").join(children, "key", "left").select(
        "key", "ancestors",
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("_single")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    shared = Stored(own, "trie-shared").df
    levels = (shared.agg(F.max(F.octet_length("ancestors"))).first()[0] or 0) // KEY
    sums = subtree_sums(shared, levels)
    ends = found.where("ends IS NOT NULL").select("key", "conv_id", "ends").repartition("key")
    # A piece's ids lie after those of the piece before it, and so does its smallest member.
    hashed = ends.withColumn("_first", F.split_part("ends", F.lit(","), F.lit(1)).cast("bigint")).sortWithinPartitions(
        "key", "_first"
    )
    digests = hashed.select("key", "ends").mapInArrow(_hashed, "key binary, ends_sha256 string")
    above = nodes.select(F.col("key").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.withColumn("_parent", F.when(F.col("depth") > 0, parent)).join(above, "_parent", "left")
    return (
        placed.join(children, "key", "left").join(sums, "key", "left").join(digests, "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )

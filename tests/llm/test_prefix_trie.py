"""The prefix trie against a plain trie in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tideline.llm.prefix_trie import Shard, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Nodes by brute force: every prefix of every conversation as a tuple of turns."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    out = set()
    for prefix, ids in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        leaves = [p for p in below if not any(q[:-1] == p and q for q in members)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in ids if made[c] == prefix)
        parent = members[prefix[:-1]][0] if prefix else None
        children = sum(1 for q in members if q and q[:-1] == prefix)
        out.add((ids[0], len(prefix), parent, len(ids), children, len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, schema=SCHEMA):
    df = prefix_trie(spark.createDataFrame(rows, schema))
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def talks():
    """Groups of five with shared starts, copies of whole conversations, and odd ones."""
    rows = []
    for c in range(-12, 60):
        for t in range((c * 7) % 10):
            shared = t < 3 or c % 4 == 0
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if shared else f"{c} says {t} é"))
    rows += [(100, None, None, "first"), (100, 3, "user", None), (100, 1, "", ""), (101, 0, "a", "b:c"), (102, 0, "a:b", "c")]
    rows += [(200, 5, "user", "same")] * 3 + [(201, 5, "user", "same")] * 3  # repeated rows
    rows += [(300, 1, "u", "x"), (300, 1, "a", "y"), (None, 0, "user", "nobody's")]  # ties, no id
    rows += [(c, t, "user", f"deep {t}") for c in (400, 405, 410) for t in range(37 + c // 5 % 3)]
    return rows


def test_against_brute_force(spark):
    assert found(spark, talks()) == plain(talks())


def test_many_small_shards_add_up(spark):
    """Every partition is a shard of its own; the result is the same."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("13", "false")):
        spark.conf.set(name, value)
    try:
        assert found(spark, talks()) == plain(talks())
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_hot_start_and_copies(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 3}") for c in range(0, 3000, 5) for t in range(3)]
    got = found(spark, rows)
    assert got == plain(rows) and (0, 1, 0, 600, 3, 3, 599 * 5 + 3 * 199 * 2, hashlib.sha256(b"").hexdigest()) in got


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == set()
    rows = [(*r, "k", 7, 8) for r in talks()]
    assert found(spark, rows, SCHEMA + ", key string, n long, base long") == plain(talks())


def test_turnless_conversations_are_members_of_the_root(spark):
    lost = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(lost, 0, "user", "gone")]
    assert found(spark, rows) == plain(rows) == {(lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())}


@pytest.mark.parametrize("length", [1, 2, 9, 70])
def test_bitsets_of_one_shard(length):
    digests = [bytes([i]) * 16 for i in range(length)]
    rows = [(c, digests[: length - c % 2], [1] * (length - c % 2)) for c in range(130)]
    nodes = list(Shard(rows).nodes())
    assert [n[2] for n in nodes] == [130] * length + [65]
    assert nodes[-1][6] == ",".join(str(c) for c in range(0, 130, 2))

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import suffix_radix as suffix


def covered(bodies, t):
    counts = Counter(b[i : i + t] for b in bodies for i in range(len(b) - t + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - t + 1):
            if counts[b[i : i + t]] > 1:
                gone[1 + i : 1 + i + t] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        out.append((edges[::2], edges[1::2]))
    return out


def brute(rows, t):
    bodies = [(x or "").encode() for _, x in rows]
    want = []
    for (doc_id, _), b, (s, e) in zip(rows, bodies, covered(bodies, t)):
        kept = hashlib.sha256(suffix.cut_out(b, s, e)).hexdigest()
        want.append((doc_id, len(b), int((e - s).sum()), len(s), kept))
    return sorted(want, key=str)


def got(spark, rows, depth, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in more.items()})
    return sorted(map(tuple, suffix.digests(docs, depth=depth).drop("text").collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5), st.integers(2, 12), st.sampled_from([8, 30, 1000]))
def test_runs_hold_every_suffix_once(texts, t, chunk):
    depth = suffix.Depth(t, chunk=chunk)
    bodies = [x.encode() for x in texts]
    text, first, count, offset, gram, whole = suffix.runs(bodies, depth)
    held = [(i, f + j) for i, f, n in zip(text, first, count) for j in range(n)]
    assert sorted(held) == [(i, j) for i, b in enumerate(bodies) for j in range(len(b) - t + 1)]
    strings = {}
    for i, f, n, o, w, g in zip(text, first, count, offset, whole, gram):
        assert 0 <= o < depth.reach and n <= depth.reach
        key = (bodies[i][f : f + n - 1 + t], o)
        assert strings.setdefault((g, w), key) == key  # equal digits, equal strings
    assert len(strings) == len(set(strings.values()))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=8))
def test_merged_intervals(pairs):
    s, e = suffix.merged(np.array([a for a, _ in pairs], np.int64), np.array([a + n for a, n in pairs], np.int64))
    points = {x for a, n in pairs for x in range(a, a + n)}
    assert {x for a, b in zip(s, e) for x in range(a, b)} == points and all(s[1:] > e[:-1])


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        text[rng.randrange(len(text))] = rng.choice("xyz")
    return "".join(text)


@pytest.mark.parametrize("t, chunk, seed", [(12, 1 << 19, 0), (12, 64, 1), (40, 128, 2), (9, 1 << 19, 3)])
def test_equals_brute_force(spark, t, chunk, seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdeé ") for _ in range(900))
    rows = []
    for i in range(60):
        a = rng.randrange(800)
        part = edited(rng, base[a : a + rng.choice([t - 1, t, t + 3, 90, 400])], rng.choice([0, 1, 2, 5]))
        rows.append((i, "".join(rng.choice("fghij") for _ in range(rng.randrange(40))) + part))
    rows += [(70, "the " * 60), (71, "a" * 200), (72, base), (73, base), (73, base), (74, None), (75, ""), (None, base[:200])]
    rows += [(76, "x" + "the " * 20), (77, "q" * t), (78, "漢字" * 30 + base[5:80])]
    assert got(spark, rows, suffix.Depth(t, 3, chunk), key=1, tag=2, rest="x", body="y") == brute(rows, t)


def test_full_threshold_and_long_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = " ".join(word() for _ in range(70))  # 419 bytes
    long = " ".join(word() for _ in range(120_000))
    rows = [(i, f"{word()} {word()}{shared}{word() * 9}") for i in range(30)] + [(50, long), (51, "z" + long[5000:6000])]
    rows += [(52, shared[:399]), (53, shared[19:] + "!"), (54, long[700_000:700_399])]
    out = {r[0]: r for r in got(spark, rows, suffix.Depth())}
    assert all(419 <= out[i][2] <= 425 and out[i][3] == 1 for i in range(30))  # neighbours may agree by chance
    assert out[50][2:4] == out[51][2:4] == (1000, 1)
    assert out[52][2] == 0 and out[53][2:4] == (400, 1) and out[54][2] == 0


def test_text_results_and_empty_tables(spark):
    rows = [(1, "é" * 30 + "abc", "x"), (2, "zé" + "é" * 30, None), (3, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.rest.doc_id: r for r in suffix.without_repeats(docs, depth=suffix.Depth(41)).collect()}
    assert out[1].kept == "abc" and out[2].kept == "z" and out[3].kept == "" and out[2].rest.lang is None
    assert suffix.digests(docs.limit(0)).collect() == []


def test_characters_cut_in_part_stay():
    data = "aéb".encode()
    assert suffix.cut_text(data, np.array([0]), np.array([2])) == "éb"
    assert suffix.cut_text(data, np.array([2]), np.array([4])) == "aé"
    assert suffix.cut_text(data, np.array([1]), np.array([3])) == "ab"


def test_ten_thousand_identical_rows(spark):
    """What a row says about its runs is kept once for all rows that are the same, whatever the partitions."""
    rng = random.Random(3)
    copied = "".join(rng.choices("abcdefgh ", k=10_000))
    alone = "".join(rng.choices("ijklmnop ", k=5_000))
    few = spark.createDataFrame([(None, copied), (1, alone + copied[200:900]), (2, "short")], "doc_id long, text string")
    many = few.where("doc_id IS NULL").crossJoin(spark.range(10_000).select()).select("doc_id", "text")
    out = suffix.digests(many.unionByName(few.where("doc_id IS NOT NULL")))
    got = {tuple(r[:4]): r[4] for r in out.drop("kept_sha256").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.length("text").alias("left")).distinct().collect()}
    assert out.count() == 10_002
    assert got == {(None, 10_000, 10_000, 1): 0, (1, 5_700, 700, 1): 5_000, (2, 5, 0, 0): 5}


def test_short_runs_of_few_words_stay(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    many, few, long = " ".join(word(3) for _ in range(10)), " ".join(word(12) for _ in range(3)), word(70)
    rows = []
    for i in range(40):
        parts = [many if i % 2 else few, word(40), long if i % 3 else few, word(40)]
        rows.append((i, "|".join(rng.sample(parts, 4))))
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    depth = suffix.Depth(30, words=9)
    out = sorted((r.doc_id, r.n_removed, r.n_spans, r.text) for r in suffix.digests(docs, depth=depth).collect())
    bodies = [t.encode() for _, t in rows + rows[:1]]
    want = []
    for (i, _), b, (s, e) in zip(rows + rows[:1], bodies, covered(bodies, 30)):
        runs = [(x, y) for x, y in zip(s, e) if y - x >= 60 or len(b[x:y].split()) >= 9]
        s, e = np.array([x for x, _ in runs], int), np.array([y for _, y in runs], int)
        want.append((i, int((e - s).sum()), len(runs), suffix.cut_out(b, s, e).decode()))
    assert out == sorted(want)
    texts = {t for _, _, _, t in out}
    assert any(few in t for t in texts) and not any(many in t or long in t for t in texts)


def test_counts_are_not_broadcast(spark, monkeypatch):
    """Counts of buckets grow with the texts and are larger in memory than Spark takes their files for."""
    plans = []

    class Seen(suffix.Stored):
        def __init__(self, df, name):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            super().__init__(df, name)

    monkeypatch.setattr(suffix, "Stored", Seen)
    rows = [(i, "abcdefgh" * (i % 7) + str(i) * 9) for i in range(40)]
    assert got(spark, rows, suffix.Depth(12)) == brute(rows, 12)
    assert {"judged", "told", "pieces", "added"} <= {name for name, _ in plans}
    assert [name for name, plan in plans if name in ("judged", "told", "pieces", "added") and "Broadcast" in plan] == []

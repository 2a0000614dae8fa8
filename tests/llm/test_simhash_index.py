import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import simhash_index as sim
from tideline.llm.components import components


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    ids = {i for i, _ in rows}
    links = [(i, j) for i, p in prints for j, q in prints if (p ^ q).bit_count() <= 2]
    return sorted((i, f"{p:016x}", classes(links, ids)[i]) for i, p in prints)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in more.items():
        docs = docs.withColumn(name, F.lit(value))
    out = sim.near_copies(docs).withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))
    return sorted(map(tuple, out.collect()))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\n\x0b é\x1c", max_size=60))
def test_fingerprint_is_the_brute_force_one(text):
    assert sim.fingerprint(text) % 2**64 == brute_print(text)


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = " ".join(str(i % 977) for i in range(3000))
    monkeypatch.setattr(sim, "CHUNK", 17)
    assert sim.fingerprint(text) % 2**64 == brute_print(text)


def test_hash_is_the_one_spark_has(spark):
    got = spark.sql("select xxhash64('a bé c')").first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest("a bé c".encode(), 42)


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([2, 60, 400]))] for _ in range(12)]
    rows = []
    for i in range(90):
        text = list(rng.choice(base))
        if rng.random() < 0.6:
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - i, " ".join(text)))
    rows += [(5, None), (3, ""), (2000, " \n"), (7, "A b"), (8, "a  B"), (9, "a b"), (9, "a b")]
    assert found(spark, rows, fingerprint="x", component="y", b=1, entry=2) == brute(rows)


def test_all_links_at_two_bits(spark):
    rng = random.Random(1)
    x = rng.getrandbits(64)
    prints = {x, 0, 1, 3, 7} | {x ^ (1 << a) ^ (1 << b) for a, b in ((0, 1), (31, 32), (40, 63), (5, 60), (9, 9))}
    prints |= {x ^ (0b111 << 20), rng.getrandbits(64)}
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    edges = sim.near_fingerprints(spark.createDataFrame(signed, "fingerprint long"))
    assert all((a ^ b).bit_count() <= 2 for a, b in ((r.a % 2**64, r.b % 2**64) for r in edges.collect()))
    got = {r.node: r.component for r in components(edges).collect()}
    values = [p for (p,) in signed]
    links = [(p, q) for p in values for q in values if (p % 2**64 ^ q % 2**64).bit_count() <= 2]
    want = classes(links, values)
    assert {p: got.get(p, p) for p in values} == want


def pairs(prints):
    return {(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= 2}


def test_all_pairs_once_however_small_the_entries_are(spark):
    rng = random.Random(3)
    low, high = rng.getrandbits(32), rng.getrandbits(32) << 32
    prints = {low | rng.getrandbits(12) << 32 for _ in range(150)} | {high | rng.getrandbits(9) for _ in range(150)}
    prints |= {high | low, 0} | {(high | low) ^ (1 << a) ^ (1 << b) for a in range(0, 64, 9) for b in range(0, 64, 7)}
    values = [p - 2**64 if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(v,) for v in values] * 2 + [(None,)], "fingerprint long")
    for work in (sim.WORK, 2000, 0):
        got = [tuple(r) for r in sim.near_fingerprints(table, work).collect()]
        assert len(got) == len(set(got)) and set(got) == pairs(values)


def test_a_segment_that_many_share_is_split(spark):
    rng = random.Random(8)
    shared = sorted({7 | rng.getrandbits(32) << 32 for _ in range(100_000)})
    planted = {7 | 1 << 40: 5 | 1 << 40, 7 | 3 << 50: 7 | 3 << 50 | 1 << 63}
    values = {p - 2**64 if p >> 63 else p for p in [*shared, *planted, *planted.values()]}
    edges = sim.near_fingerprints(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    got = {tuple(r) for r in edges.collect()}

    def near(value):
        flips = [1 << a for a in range(64)] + [0]
        around = {value ^ a ^ b for a in flips for b in flips}
        return {v for v in ((x + 2**63) % 2**64 - 2**63 for x in around) if v in values and v != value}

    some = rng.sample(sorted(values), 100) + [5 | 1 << 40, 7 | 3 << 50]
    for value in some:
        assert near(value) == {b if a == value else a for a, b in got if value in (a, b)}


def test_empty_tables_and_rows_without_id(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, "a b c")]) == [(None, f"{brute_print('a b c'):016x}", None)]


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(101, 100), (100, 101), (7, 7), (200, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_long_tables_are_not_broadcast(spark, monkeypatch):
    """Spark takes the balls around fingerprints for as small as the fingerprints that they are made of."""
    plans = []

    class Seen(sim.Stored):
        def __init__(self, df, name):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            super().__init__(df, name)

    monkeypatch.setattr(sim, "Stored", Seen)
    prints = spark.range(500).select(F.xxhash64("id").alias("fingerprint"))
    sim.near_fingerprints(prints.union(prints.select(F.col("fingerprint").bitwiseXOR(F.lit(1)))))
    assert {"hits", "links"} <= {name for name, _ in plans}
    assert [name for name, plan in plans if "Broadcast" in plan] == []

import random
import statistics
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tideline.operators import rollups
from tideline.sources import json_columns


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice("abbb"), rng.choice(["x", None]), rng.gauss(50, 20) if rng.random() < 0.9 else None, rng.randrange(6000))
        for _ in range(20_000)
    ]
    return rows, spark.createDataFrame(rows, "k string, m string, v double, who long")


def groups(rows, key):
    order = lambda r: tuple(str(x) for x in key(r))
    return {k: list(g) for k, g in groupby(sorted(rows, key=order), key=lambda r: key(r))}


def test_merged_states_agree_with_the_rows(spark, panel, tmp_path):
    rows, df = panel
    rollups.summary_states(df, ["k", "m"], "v", "who").write.parquet(f"{tmp_path}/states")
    states = spark.read.parquet(f"{tmp_path}/states")
    found = rollups.summaries(states, ["k", "m"], [["k", "m"], ["k"], ["m"], []]).collect()
    want = {}
    for level, key in {0: lambda r: (r[0], r[1]), 1: lambda r: (r[0], None), 2: lambda r: (None, r[1]), 3: lambda r: (None, None)}.items():
        want |= {(level, *k): g for k, g in groups(rows, key).items()}
    assert {(r.level, r.k, r.m) for r in found} == set(want) and len(found) == len(want)
    for r in found:
        group = want[r.level, r.k, r.m]
        values = sorted(x[2] for x in group if x[2] is not None)
        assert (r.rows, r.known, r.least, r.most) == (len(group), len(values), values[0], values[-1])
        assert r.mean == pytest.approx(statistics.mean(values))
        rank = sum(v <= r.median for v in values) / len(values)
        assert abs(rank - 0.5) < 0.03
        assert r.entities == pytest.approx(len({x[3] for x in group}), rel=0.03)


def test_groups_without_values_and_empty_panels(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, 1)], "k string, v double, who long")
    states = rollups.summary_states(df, ["k"], "v", "who")
    (row,) = rollups.summaries(states, ["k"], [["k"]]).collect()
    assert (row.rows, row.known, row.total, row.mean, row.median, row.entities) == (2, 0, None, None, None, 1)
    empty = rollups.summary_states(df.limit(0), ["k"], "v", "who")
    assert rollups.summaries(empty, ["k"], [["k"]]).collect() == []


def test_distinct_counts_merge_exactly(spark, panel):
    rows, df = panel
    far = df.withColumn("who", F.when(F.col("who") % 7 == 0, -F.col("who") * 1_000_003).otherwise(F.col("who")))
    states = rollups.distinct_states(far, ["k", "m"], "who")
    got = {r.k: r.entities for r in rollups.merged_distinct(states, ["k"]).collect()}
    assert got == {r.k: r.n for r in far.groupBy("k").agg(F.countDistinct("who").alias("n")).collect()}
    assert rollups.merged_distinct(rollups.distinct_states(df.limit(0), ["k"], "who"), ["k"]).collect() == []


def test_fields_of_json_and_rows_kept_apart(spark):
    usual = [(i, f'{{"n": {i}, "x": {i}.5, "s": "t{i}", "deep": {{"a": 1}}, "mixed": {i if i % 2 else repr("q").replace(chr(39), chr(34))}}}') for i in range(100)]
    odd = [(200, '{"n": "word", "rare": 1}'), (201, "[1]"), (202, '{"n": 1'), (203, None), (204, ""), (205, "{}"), (206, '{"n": 4.5, "it\'s": null}')]
    df = spark.createDataFrame(usual + odd, "id long, props string")
    fields = json_columns.fields_of(df, "props")
    assert fields == {"deep": "variant", "mixed": "string", "n": "bigint", "s": "string", "x": "double"}
    good, bad = json_columns.shredded(df, "props", fields)
    assert sorted(r.id for r in bad.collect()) == [201, 202, 203, 204] and bad.columns == df.columns
    rows = {r.id: (r.n, r.x, r.s, r.mixed) for r in good.select("id", "n", "x", "s", "mixed").collect()}
    assert rows[7] == (7, 7.5, "t7", "7") and rows[8][3] == "q"
    assert rows[200] == (None, None, None, None) and rows[205] == (None, None, None, None)
    assert len(rows) == 103
    assert json_columns.fields_of(df.limit(0), "props") == {}


def test_one_scan_for_all_grouping_sets(spark):
    from tests.conftest import SMALL
    from tideline.plans.queries import QUERIES

    plan = QUERIES["ticks_grouping_sets"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import exclusion


def counted(df):
    rows = {}
    for r in df.collect():
        rows[tuple(r)] = rows.get(tuple(r), 0) + 1
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    one = lambda n: rng.randrange(n) if rng.random() < 0.95 else None
    rows = [(one(3000) if rng.random() < 0.7 else 5, rng.choice(["x", "y", None]), i % 9) for i in range(6000)]
    keys = [(one(3000), rng.choice(["x", "y", None])) for _ in range(700)] + [(5, "x")] * 40
    return rows, keys, spark.createDataFrame(rows, "a long, b string, v int"), spark.createDataFrame(keys, "a long, b string")


@pytest.mark.parametrize("log_places", [15, 20])
@pytest.mark.parametrize("on", [["a"], ["a", "b"]])
def test_rows_with_and_without_keys(tables, on, log_places):
    rows, keys, df, listed = tables
    n = len(on)
    want = {k[:n] for k in keys if None not in k[:n]}
    have, rest = {}, {}
    for r in rows:
        side = have if r[:n] in want else rest
        side[r] = side.get(r, 0) + 1
    assert have and rest
    assert counted(exclusion.with_keys(df, listed, on, log_places)) == have
    assert counted(exclusion.without_keys(df, listed, on, log_places)) == rest


def test_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "a")
    found = exclusion.key_filter(keys, ["a"], 20)
    assert found.count() <= 32 and found.agg(F.max(F.length("bits"))).first()[0] == 4096
    assert exclusion.possible(keys, found, ["a"], 20).count() == 20_000
    others = spark.range(1_000_000, 1_100_000).withColumnRenamed("id", "a")
    passed = exclusion.possible(others, found, ["a"], 20).count()
    # 40,000 of 1,048,576 places are set, so two probes pass about 0.14 % of other keys.
    assert 20 < passed < 400
    assert exclusion.possible(others, found, ["a"], 20, wanted=False).count() == 100_000 - passed


def test_a_full_filter_changes_no_result(spark):
    keys = spark.range(0, 400_000, 2).withColumnRenamed("id", "a")
    rows = spark.range(1000).withColumnRenamed("id", "a")
    assert sorted(r.a for r in exclusion.without_keys(rows, keys, ["a"], 15).collect()) == list(range(1, 1000, 2))
    with pytest.raises(ValueError):
        exclusion.key_filter(keys, ["a"], 14)


def test_empty_tables_and_odd_names(spark):
    rows = spark.createDataFrame([(1, "p", b"q"), (None, "p", b"q")], "`a.b` long, bitmap string, bits binary")
    keys = rows.select("`a.b`")
    none = keys.limit(0)
    assert exclusion.without_keys(rows, none, ["a.b"]).count() == 2
    assert exclusion.with_keys(rows, none, ["a.b"]).collect() == []
    assert [r[0] for r in exclusion.without_keys(rows, keys, ["a.b"]).collect()] == [None]
    assert exclusion.with_keys(rows, keys, ["a.b"]).columns == rows.columns
    assert exclusion.without_keys(rows.limit(0), keys, ["a.b"]).collect() == []


def test_the_filter_stands_before_the_shuffle(spark, tmp_path):
    spark.range(100_000).select(F.col("id").alias("a"), F.lit("v").alias("v")).write.parquet(f"{tmp_path}/rows")
    spark.range(0, 100_000, 1000).select(F.col("id").alias("a")).write.parquet(f"{tmp_path}/keys")
    rows, keys = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/keys")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = exclusion.without_keys(rows, keys, ["a"])
        assert out.count() == 99_900
        out.collect()
        plan = out._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = text.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final and "Python" not in final
    exchanged = exchanged_rows(plan)
    assert 100 <= min(n for n in exchanged if n >= 100) <= 200 and max(exchanged) < 5000


def exchanged_rows(plan):
    """Rows that each hash exchange of an executed adaptive plan wrote."""
    out, todo = [], [plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
    while todo:
        node = todo.pop()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName() == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out

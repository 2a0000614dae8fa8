import math
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import rule_quality as quality

DATA = SMALL.replace("0.001", "0.1")


@settings(max_examples=100, deadline=None)
@given(st.none() | st.text(max_size=80))
def test_statistics_are_finite(text):
    got = quality.statistics(text)
    assert len(got) == len(quality.STATISTICS) and all(map(math.isfinite, got))


def test_rules_are_found_and_few():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    model = quality.fit_rules(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    assert 0 < len(model.rules) <= 300
    assert all(0 <= f < len(quality.STATISTICS) for rule in model.rules for f, _, _ in rule)


def test_constant_models():
    x = np.zeros((50, len(quality.STATISTICS)))
    for rows, y in ((x[:0], np.array([])), (x, np.ones(50)), (x, np.tile([0.0, 1.0], 25))):
        model = quality.fit_rules(x[: len(rows)], y)
        assert model.rules == () and 0 < model.score(x)[0] < 1


def test_held_out_quality_and_columns(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels, sample=2000)
    rows = {r.doc_id: r for r in quality.scores(docs, model).collect()}
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.limit(300).collect()}
    for doc_id, text in texts.items():
        row = rows[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert abs(row.score - model.score(np.array([quality.statistics(text)]))[0]) < 1e-9
        assert row.predicted == (row.score >= 0.3)
    held = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert np.mean([row.predicted == label for row, label in held]) > 0.97
    assert np.mean([row.predicted for row, label in held if label == 1]) > 0.99


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality._fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs, turned)


def test_edges(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (None, "The The " * 40_000), (1, "a b c"), (1, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "_id": F.lit(1)})
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        got = quality.scores(docs, quality.train(docs, some)).collect()
        assert len(got) == 6 and all(0 < r.score < 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert quality.scores(docs.limit(0), quality.train(docs.limit(0), labels)).collect() == []

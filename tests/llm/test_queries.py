"""The registered corpus queries: all there, their columns, and those with SQL against it."""

import os
import re
import sys

import pytest

from tests.conftest import SMALL
from tideline.llm.queries import QUERIES, SQL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "checks"))
from compare import connect, differences  # noqa: E402

COLUMNS = {
    1: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    2: ["vec_id", "n_links", "component_id", "kept"],
    3: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    4: ["doc_id", "fingerprint", "component_id"],
    5: ["page_id", "warc_type", "record_id", "refers_to", "block_digest", "source_digest"],
    6: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    7: ["doc_id", "held_out", "score", "predicted"],
    8: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    9: ["query_id", "rank", "vec_id", "score"],
    10: ["page_id", "url", "text", "n_chars"],
    11: ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    12: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    13: ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    number = int(re.match(r"op(\d+)_", name)[1])
    assert set(COLUMNS[number]) <= set(df.columns)
    table = {2: "embeddings", 9: None, 5: None, 10: "pages", 6: None, 11: None, 13: None}.get(number, "documents")
    rows = df.count()
    assert rows > 0 and (table is None or rows == spark.read.parquet(f"{SMALL}/{table}.parquet").count())


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_against_sql(spark, name, folder):
    assert differences(QUERIES[name](spark, folder), connect(folder), SQL[name]) == ""

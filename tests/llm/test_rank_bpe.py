import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import rank_bpe

TEXTS = st.text(alphabet=st.sampled_from("ab1 \n\t'sé²№.-  漢😀 re"), max_size=200)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_cuts_are_safe(text, size):
    cut = list(rank_bpe.pieces(text, size))
    assert "".join(cut) == text
    one = rank_bpe.encoding().encode_ordinary
    assert [i for piece in cut for i in one(piece)] == one(text)


@pytest.mark.parametrize("text", ["ab " * 40_000, "x" * 70_000 + "1" * 70_000 + " y", "\n" * 70_000, "a1" * 50_000])
def test_long_texts(text):
    assert rank_bpe.encode(text) == rank_bpe.encoding().encode_ordinary(text)
    assert rank_bpe.decode(rank_bpe.encode(text)) == text.encode()


def test_columns(spark):
    rows = [(1, "It's 12 <|endoftext|>\n"), (2, None), (3, ""), (None, "é漢"), (1, "It's 12 <|endoftext|>\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    full = rank_bpe.with_bytes(rank_bpe.with_ids(docs)).collect()
    assert [bytes(r.decoded).decode() for r in full] == [t or "" for _, t in rows]
    got = rank_bpe.digests(docs).collect()
    for row, (doc_id, text) in zip(got, rows):
        ids = rank_bpe.encoding().encode_ordinary(text or "")
        assert row.asDict() == {
            "doc_id": doc_id,
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest(),
        }
    assert rank_bpe.digests(docs.limit(0)).collect() == []

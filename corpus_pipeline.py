"""Cleans a corpus and packs it into token sequences, stage by stage.

Each stage takes the documents that its predecessor kept and returns what is left of them, with
the columns of ``documents``; the last one returns the packed pieces. Between stages the rows are
stored in the shared folder, so a lost executor costs no more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import personal_data, rule_quality, simhash_index, suffix_radix, token_packing
from tideline.llm.tables import Stored, load, row_key


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text is now, in the type it had; tables without it stay without."""
    kinds = dict(docs.dtypes)
    if "n_chars" not in kinds:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the model of the labels in ``sf_dir`` scores below the threshold.

    The model learns from labelled rows of ``docs`` outside the held-out fold. Null texts are
    judged as empty ones; rows that are the same are judged alike.
    """
    model = rule_quality.train(docs, load(spark, sf_dir, "labels"))
    plain = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    scored = rule_quality.score(plain.select("_row", "text"), model)
    return scored.where("predicted = 1").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id.

    Of several rows of a group with that id the first by content stays, once, even if the rows are
    the same. Rows of one id in different groups are told apart. Rows without id stay: they can be
    told from no other.
    """
    classes = simhash_index.near_copies(docs, keyed=True).where("doc_id IS NOT NULL")
    first = classes.groupBy("component").agg(F.min(F.struct("doc_id", "row_a", "row_b")).alias("first"))
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keys = [key.alias(name) for key, name in zip(row_key("doc_id", "text"), ("row_a", "row_b"))]
    named = docs.where("doc_id IS NOT NULL").select(rows.alias("_row"), *keys)
    kept = named.join(first.select("first.row_a", "first.row_b"), ["row_a", "row_b"])
    one = kept.groupBy("row_a", "row_b").agg(F.first("_row").alias("_row")).select("_row.*")
    return one.unionByName(docs.where("doc_id IS NULL"))


#: Bytes that 50 words have in nearly all places, and the words of a run that goes under 400 bytes.
PASSAGE = suffix_radix.Depth(threshold=200, words=50)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages that stand elsewhere too: of 50 words and 200 bytes, or of 400 bytes.

    All copies go, the first included, as in the operator; texts may become empty. 50 words of the
    given texts have 300 bytes at the median and 200 or more in 99 of 100 places.
    """
    out = suffix_radix.without_repeats(docs, depth=PASSAGE)
    cleaned = out.select("rest.*", F.col("kept").alias("text")).select(*[f"`{c}`" for c in docs.columns])
    return _with_length(cleaned)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind, as ``<EMAIL>``; null texts stay null."""
    return _with_length(personal_data.redact(docs, personal_data.train(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and the sequences they are packed into."""
    return token_packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", repeats),
    ("PII", private),
    ("best-fit packing", packing),
]

#: SQL expresses neither the fitted models nor the packing; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir), name.split()[0].lower()).df
    return STAGES[-1][1](spark, docs, sf_dir)

"""Row keys and stored intermediate tables shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.session import discard, scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two 64-bit numbers that name a row by its id and its content.

    Equal rows share them, and nothing else does for practical purposes; neither is null, so
    joins on them keep rows without an id.
    """
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return (
        F.xxhash64(F.col(doc_id).cast("string"), F.lit(1), content),
        F.xxhash64(F.lit(2), content, F.col(doc_id).cast("string")),
    )


def hashed_sample(df: DataFrame, rows: int, by: list[str], parts: int = 64) -> DataFrame:
    """At most ``rows`` rows, the first of each of ``parts`` parts by a hash of ``by``.

    The same rows whatever the partitions; as each part is cut on its own, and before the shuffle,
    no task and no driver sees more than its share. A table of fewer rows can lose some of them
    where its hashes are uneven.
    """
    order = Window.partitionBy(F.pmod(F.xxhash64(*by, F.lit(17)), F.lit(parts))).orderBy(F.xxhash64(*by), *by)
    return df.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= max(1, rows // parts)).drop("_nth")


class Stored:
    """A table written to the shared folder, which can be removed once it has been used."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        discard(self.spark, self.path)

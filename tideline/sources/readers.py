"""Scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.runs import STEP_COLUMNS

# The fields of a run record.
RUN_SCHEMA = (
    "exp_id string, desc string, master string, steps string, start_utc string, end_utc string, "
    "run_id string, timings_path string, pyspark_submit_args string, wall_seconds double, "
    "max_rss_bytes double, mean_cpu_percent double, "
    + ", ".join(f"{c} double" for c in STEP_COLUMNS)
    + ", steps_sum_s double, return_code int, run_idx int, scale_factor int, num_samples int, "
    "have_psutil boolean, using_scaled boolean, spark_conf map<string,string>, "
    "env map<string,string>"
)


def read_raw_bars(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV file below ``path``, all columns as text, plus the file each row came from."""
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    return raw.withColumn("file_name", F.col("_metadata.file_path"))


def read_panel(spark: SparkSession, path: str, text: Sequence[str] = ("symbol",)) -> DataFrame:
    """Parquet table; partition columns are recovered from the folder names, those in ``text`` as
    they are written there, also where they look like numbers or dates."""
    found = spark.read.parquet(path).schema
    as_text = [
        T.StructField(f.name, T.StringType(), f.nullable) if f.name in text else f for f in found
    ]
    return spark.read.schema(T.StructType(as_text)).parquet(path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A saved result: its Parquet form if there is one, else its CSV form."""
    try:
        return spark.read.parquet(f"{base}/{name}")
    except AnalysisException:
        return (
            spark.read.option("header", True)
            .option("inferSchema", True)
            .csv(f"{base}/{name}_csv")
        )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    """Run records under ``base``: JSON lines if any parse, else a CSV summary.

    Lines that do not parse are dropped.
    """
    lines = f"{base}/summary.jsonl"
    if _exists(spark, lines):
        runs = spark.read.schema(RUN_SCHEMA).option("mode", "DROPMALFORMED").json(lines)
        if not runs.isEmpty():
            return runs
    # Maps have no CSV form.
    flat = ", ".join(f for f in RUN_SCHEMA.split(", ") if " map<" not in f)
    kinds = dict(f.strip().split(" ", 1) for f in flat.split(", "))
    for name in ("summary.csv", "summary_agg.csv"):
        path = f"{base}/{name}"
        if _exists(spark, path):
            # Aggregated summaries have columns of their own, whose types are inferred.
            scan = spark.read.option("header", True).option("inferSchema", True)
            rows = scan.option("mode", "DROPMALFORMED").csv(path)
            return rows.withColumns(
                {c: F.expr(f"try_cast(`{c}` AS {kinds[c]})") for c in rows.columns if c in kinds}
            )
    raise FileNotFoundError(f"no run summary in {base}")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

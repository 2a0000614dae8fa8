"""Panels, raw text, labels and run records made by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.features import bar_features, model_features
from tideline.operators.clusters import label_clusters
from tideline.operators.layout import Axis
from tideline.settings import BLOWOFF, BULL, CALM, CHOPPY, SELLOFF

# Daily bars are grouped by (symbol, Date): at most one row per symbol and calendar day.
DAILY = Axis().bounded()
# Five event types share all ticks, so each is hot; small blocks cut even the small tables.
TICKS = Axis(entity="event_type", time="ts", min_block_rows=256)
LEAD = "S1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of unit prices per supplier; Close is the mean price weighted by quantity."""
    cents = F.rint(F.col("l_extendedprice") * 100)
    price = F.rint(cents / F.col("l_quantity"))
    symbol = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    return _bars(
        table(spark, sf_dir, "lineitem").select(
            F.to_date("l_shipdate").alias("Date"),
            symbol.alias("symbol"),
            price.alias("price"),
            cents.alias("cents"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order prices per priority: five symbols that share the whole table."""
    cents = F.rint(F.col("o_totalprice") * 100)
    return _bars(
        table(spark, sf_dir, "orders").select(
            F.to_date("o_orderdate").alias("Date"),
            F.col("o_orderpriority").alias("symbol"),
            cents.alias("price"),
            cents.alias("cents"),
            F.lit(1.0).alias("quantity"),
        )
    )


def _bars(trades: DataFrame) -> DataFrame:
    """Bars in whole cents, so that no value depends on the order of summation."""
    grouped = trades.groupBy("Date", "symbol").agg(
        F.max("price").alias("High"),
        F.min("price").alias("Low"),
        F.rint(F.sum("cents") / F.sum("quantity")).alias("Close"),
        F.sum("quantity").alias("Volume"),
    )
    return grouped.select(
        "Date",
        "symbol",
        ((F.col("High") + F.col("Low")) / 2).alias("Open"),
        "High",
        "Low",
        "Close",
        "Volume",
        (F.col("Close") * F.col("Volume")).alias("Marketcap"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "ts", "value")


def ship_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_features(ship_bars(spark, sf_dir), DAILY)


def ship_model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_features(ship_features(spark, sf_dir), DAILY)


def rule_cluster() -> Column:
    """Stand-in for a fitted cluster that plain SQL can follow as well."""
    return (
        F.when((F.col("zscore_7") >= 1.25) & (F.col("ma_gap_30") > 0), 0)
        .when(F.col("zscore_7") <= -1.25, 2)
        .when(F.col("ma_gap_7") >= 0.6, 4)
        .when(F.col("ret_std_30") <= 1.6, 1)
        .otherwise(3)
    )


RULE_NAMES = {0: BLOWOFF, 1: CALM, 2: SELLOFF, 3: CHOPPY, 4: BULL}


def with_rule_labels(features: DataFrame) -> DataFrame:
    clustered = features.withColumn("cluster", rule_cluster())
    return clustered.withColumn("regime", label_clusters(clustered, RULE_NAMES))


def rule_labels(features: DataFrame, axis: Axis = DAILY) -> DataFrame:
    """Predictions in the form that K-Means labelling writes, from the rule."""
    return with_rule_labels(features).select(axis.time, axis.entity, "cluster", "regime")


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as untidy text rows in the form of a raw bar file."""
    money = F.format_number("l_extendedprice", 2)
    quantity = F.col("l_quantity")
    key = F.col("l_suppkey").cast("string")
    untold = F.col("l_linenumber") == 1
    file_name = F.when(untold & (F.col("l_tax") == 0.0), F.lit("data/readme.csv")).otherwise(
        F.concat(F.lit("data/in/coin_s"), key, F.lit(".csv"))
    )
    close = (
        F.when(quantity == 13, F.lit("n/a"))
        .when(quantity == 14, F.lit("1-2"))
        .otherwise(F.concat(F.lit("$"), money))
    )
    day = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 23:59:59"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("SNo"),
        F.lit("supplier").alias("Name"),
        F.when(~untold, F.concat(F.lit("s"), key)).alias("Symbol"),
        F.when(F.col("l_discount") == 0.05, F.lit("n/a")).otherwise(day).alias("Date"),
        F.concat(money, F.lit(" USD")).alias("High"),
        F.when(quantity == 15, F.lit("")).otherwise(money).alias("Low"),
        money.alias("Open"),
        close.alias("Close"),
        F.concat(F.format_number(quantity, 0), F.lit(" units")).alias("Volume"),
        F.concat(F.lit("-"), money).alias("Marketcap"),
        file_name.alias("file_name"),
    )


# Event types stand for experiments, users for repeated runs of them.
EXPERIMENT_OF = {"click": "B0", "view": "S1", "purchase": "A1", "signup": "J1", "error": "Z9"}


def run_records(spark: SparkSession, sf_dir: str, with_baseline: bool = True) -> DataFrame:
    """One run per (event type, user): its times are sums of event values in whole cents."""
    named = {**EXPERIMENT_OF, **({} if with_baseline else {"click": "C1"})}
    names = F.create_map(*[F.lit(v) for pair in named.items() for v in pair])
    step = F.col("event_id") % 7 + 1
    cents = F.round(F.col("value") * 100).cast("bigint")

    def seconds(of: Column) -> Column:
        return F.sum(of).cast("double") / 100

    return (
        table(spark, sf_dir, "events")
        .groupBy(names[F.col("event_type")].alias("exp_id"), F.col("user_id"))
        .agg(
            seconds(cents).alias("wall_seconds"),
            F.max(cents).cast("double").alias("max_rss_bytes"),
            (F.min(cents).cast("double") / 100).alias("mean_cpu_percent"),
            F.min("event_id").cast("string").alias("_first_event"),
            *[seconds(F.when(step == s, cents)).alias(f"step{s}_s") for s in range(1, 8)],
        )
        .select(
            "exp_id",
            F.concat(F.lit("run of "), "exp_id").alias("desc"),
            F.concat("exp_id", F.lit("_r"), F.col("user_id").cast("string")).alias("run_id"),
            F.col("user_id").cast("int").alias("run_idx"),
            F.lpad("_first_event", 20, "0").alias("start_utc"),
            "wall_seconds",
            "max_rss_bytes",
            "mean_cpu_percent",
            *[f"step{s}_s" for s in range(1, 8)],
        )
    )


def timing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of step timings in several forms, some of them broken."""
    run = F.concat(F.lit("user_"), (F.col("user_id") % 3).cast("string"))
    step = (F.col("event_id") % 7 + 1).cast("int")
    whole = F.round(F.col("value") * 100).cast("bigint")
    kind = F.col("event_type")
    by_number = F.to_json(F.struct(run.alias("run_id"), step.alias("step"), whole.alias("wall_s")))
    by_name = F.to_json(
        F.struct(
            run.alias("run_id"),
            F.concat(F.lit("STEP "), step.cast("string"), F.lit(": done")).alias("msg"),
            (whole * 1000).alias("duration_ms"),
        )
    )
    as_text = F.to_json(
        F.struct(run.alias("run_id"), step.alias("step"), whole.cast("string").alias("wall_s"))
    )
    line = (
        F.when(kind == "error", F.lit('{"run_id": broken'))
        .when(kind == "view", by_name)
        .when(kind == "signup", as_text)
        .otherwise(by_number)
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))

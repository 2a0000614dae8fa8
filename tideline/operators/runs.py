"""Statistics of benchmark runs: per experiment, against a baseline, and per step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import safe_ratio
from tideline.settings import EXPERIMENT_ORDER, STEPS

BASELINE = "B0"
STEP_COLUMNS = tuple(f"step{s}_s" for s in STEPS)

# Fields of a timing record and the form of a step's name.
SECONDS_FIELDS = ("wall_s", "elapsed_s", "duration_s", "seconds")
NAME_FIELDS = ("name", "title", "label", "msg", "message")
STEP_NAME = r"(?i)Step\s*(\d+)"


def _one_row(table: DataFrame) -> Column:
    """The only row of ``table`` as a struct, looked up once for the whole query."""
    return table.select(F.struct("*")).scalar()


def _preferred(column: str, fallback: Column) -> Column:
    """Name of the baseline: ``B0`` if it is there, else ``fallback`` (an aggregate)."""
    return F.coalesce(F.max(F.when(F.col(column) == BASELINE, F.lit(BASELINE))), fallback)


def benchmark_summary(runs: DataFrame) -> DataFrame:
    """Wall time, memory, CPU and step times per experiment, with speedups over the baseline.

    Deviations are those of the population. Without ``B0`` the experiment that started
    first is the baseline.
    """
    megabyte = 1024 * 1024
    stats = runs.groupBy("exp_id").agg(
        F.min_by("desc", "run_idx").alias("desc"),
        F.count(F.lit(1)).alias("n_runs"),
        F.avg("wall_seconds").alias("mean_wall_s"),
        F.stddev_pop("wall_seconds").alias("std_wall_s"),
        F.min("wall_seconds").alias("min_wall_s"),
        F.max("wall_seconds").alias("max_wall_s"),
        F.avg(F.coalesce("max_rss_bytes", F.lit(0.0)) / megabyte).alias("mean_max_rss_mb"),
        F.avg(F.coalesce("mean_cpu_percent", F.lit(0.0))).alias("mean_cpu_percent"),
        F.min("start_utc").alias("_started"),
        *[F.avg(f"step{s}_s").alias(f"step{s}_mean_s") for s in STEPS],
    )
    means = ["mean_wall_s", *[f"step{s}_mean_s" for s in STEPS]]
    name = stats.agg(_preferred("exp_id", F.min_by("exp_id", "_started"))).scalar()
    baseline = _one_row(stats.where(F.col("exp_id") == name).select("exp_id", *means))

    def speedup(mean: str, base_may_be_zero: bool = False) -> Column:
        base = F.col("_base")[mean]
        usable = (F.col(mean) > 0) & (F.lit(base_may_be_zero) | (base > 0))
        return F.when(usable, base / F.col(mean))

    return stats.withColumn("_base", baseline).select(
        *[c for c in stats.columns if c not in ("_started", *means[1:])],
        speedup("mean_wall_s", base_may_be_zero=True).alias("speedup"),
        F.col("_base")["exp_id"].alias("baseline"),
        *means[1:],
        *[speedup(f"step{s}_mean_s").alias(f"step{s}_speedup") for s in STEPS],
    ).orderBy("exp_id")


def wall_times(runs: DataFrame) -> DataFrame:
    """Mean and sample deviation of wall time per experiment, fastest first."""
    return (
        runs.groupBy("exp_id")
        .agg(F.avg("wall_seconds").alias("mean"), F.stddev_samp("wall_seconds").alias("std"))
        .where(F.col("mean").isNotNull())
        .orderBy("mean", "exp_id")
    )


def wall_speedups(runs: DataFrame) -> DataFrame:
    """Speedup over ``B0``, or over the fastest experiment without it, largest first."""
    means = runs.groupBy("exp_id").agg(F.avg("wall_seconds").alias("mean"))
    given = F.max(F.when(F.col("exp_id") == BASELINE, F.col("mean")))
    base = means.agg(F.coalesce(given, F.min("mean"))).scalar()
    return (
        means.withColumn("speedup", safe_ratio(base, F.col("mean")))
        .where(F.col("speedup").isNotNull())
        .orderBy(F.desc("speedup"), "exp_id")
    )


def step_speedups(
    runs: DataFrame, order: Sequence[str] = EXPERIMENT_ORDER, steps: Sequence[str] = STEP_COLUMNS
) -> DataFrame:
    """Speedup of each step over the baseline's mean; the baseline is ``B0``, or the experiment
    with the least total time. Listed experiments come first, in list order."""
    means = runs.groupBy("exp_id").agg(*[F.avg(s).alias(s) for s in steps])
    total = F.lit(0.0)
    for s in steps:
        total = total + F.coalesce(F.col(s), F.lit(0.0))
    totals = means.withColumn("_total", total)
    fastest = F.min_by("exp_id", F.struct("_total", "exp_id"))
    name = totals.agg(_preferred("exp_id", fastest)).scalar()
    baseline = _one_row(means.where(F.col("exp_id") == name).select(*steps))
    place = F.array_position(F.array(*[F.lit(e) for e in order]), F.col("exp_id"))
    return (
        means.withColumn("_base", baseline)
        .orderBy(F.when(place > 0, place).otherwise(len(order) + 1), "exp_id")
        .select("exp_id", *[safe_ratio(F.col("_base")[s], F.col(s)).alias(s) for s in steps])
    )


def step_seconds(lines: DataFrame, run_id: str | None = None, column: str = "value") -> DataFrame:
    """Seconds per step from JSON lines of timings.

    Lines that do not parse, or name no step or no duration, are skipped. The step is the
    whole-number field ``step``, else the number in the first name that mentions one; the
    duration is the first numeric seconds field, else milliseconds. A number written as text
    does not count as one. Give ``run_id`` whenever several runs share the lines.
    """
    fields = ["run_id string", "step bigint", *[f"{f} string" for f in NAME_FIELDS]]
    fields += [f"{f} double" for f in (*SECONDS_FIELDS, "duration_ms")]
    # A field of another type is read as NULL; the rest of its record is kept.
    records = lines.select(F.from_json(column, ", ".join(fields)).alias("r")).select("r.*")
    if run_id is not None:
        records = records.where(F.col("run_id") == run_id)
    named = [F.regexp_extract(f, STEP_NAME, 1).try_cast("bigint") for f in NAME_FIELDS]
    step = F.coalesce("step", *named)
    seconds = F.coalesce(*SECONDS_FIELDS, F.col("duration_ms") / F.lit(1000.0))
    return (
        records.select(step.alias("step"), seconds.alias("seconds"))
        .dropna()
        .groupBy("step")
        .agg(F.sum("seconds").alias("seconds"))
        .orderBy("step")
    )

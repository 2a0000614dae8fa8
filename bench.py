"""Times the headline queries and the seven analysis steps; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query starts from the given tables and is read to its last row. Cleaning starts from
stored CSV files, and the seven steps from stored labels and features, as they do in use;
``store_tables`` is the time to make the latter.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.operators import cleaning  # noqa: E402
from tideline.plans import panels, queries, stages  # noqa: E402
from tideline.session import get_session, scratch_path  # noqa: E402
from tideline.sources import readers, writers  # noqa: E402

HEADLINE = (
    "features_full",
    "features_model",
    "ticks_features",
    "anomaly_counts_by_symbol",
    "top_moves_up",
    "volatility_summary",
    "transition_probabilities",
    "run_lengths",
    "dwell_by_symbol",
    "returns_by_symbol",
    "returns_fwd1_by_symbol",
    "transitions_fwd1_by_symbol",
    "breadth_daily",
    "breadth_lead_correlations",
    "cluster_centroids",
    "score_threshold_sweep",
    "kmeans_centroids",
    "gauge_coefficients",
    "run_summary",
)


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    panels.ship_bars(spark, sf_dir).count()  # starts the engine

    def read_all(name: str) -> None:
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: timed(lambda name=name: read_all(name)) for name in HEADLINE}

    root = scratch_path(spark, "bench")
    panels.raw_bars(spark, sf_dir).drop("file_name").write.option("header", True).csv(f"{root}/raw")

    def clean() -> None:
        cleaned = cleaning.clean_bars(readers.read_raw_bars(spark, f"{root}/raw"))
        cleaned.write.format("noop").mode("overwrite").save()

    times["clean_csv"] = timed(clean)

    def store() -> None:
        writers.write_panel(panels.ship_model_features(spark, sf_dir), f"{root}/features")
        rows = spark.read.parquet(f"{root}/features")
        writers.write_panel(panels.rule_labels(rows), f"{root}/labels")

    times["store_tables"] = timed(store)
    rows = spark.read.parquet(f"{root}/labels").count()
    times["seven_steps"] = timed(
        lambda: stages.run_analysis(
            spark, f"{root}/labels", f"{root}/features", f"{root}/out", lead=panels.LEAD
        )
    )
    print(
        json.dumps(
            {
                "metric": "headline queries and seven analysis steps, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "seven_steps_rows": rows,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

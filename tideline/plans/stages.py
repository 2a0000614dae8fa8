"""The stages end to end: each reads tables, writes tables, and returns what it wrote."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tideline.operators import (
    breadth, cleaning, clusters, diagnostics, features, gauge, returns, transitions,
)
from tideline.operators.layout import Axis
from tideline.settings import (
    EXCLUDED_SYMBOLS, FEATURES, LEAD_SYMBOL, SEED, FeatureSettings,
)
from tideline.sources import readers, writers

ALL_STEPS = (1, 2, 3, 4, 5, 6, 7)
# Folders per symbol suit a few hundred symbols; pass () for panels with many more.
BY_SYMBOL = ("symbol",)


def run_ingest(
    spark: SparkSession,
    source: str,
    out: str,
    exclude: Iterable[str] = EXCLUDED_SYMBOLS,
    partition_by: Sequence[str] = BY_SYMBOL,
) -> DataFrame:
    """Raw CSV files to the clean panel."""
    raw = readers.read_raw_bars(spark, source)
    writers.write_panel(cleaning.clean_bars(raw, exclude), out, partition_by)
    return readers.read_panel(spark, out).select(*cleaning.PANEL_COLUMNS)


def run_features(
    spark: SparkSession,
    cleaned: str,
    full_out: str,
    model_out: str,
    settings: FeatureSettings = FeatureSettings(),
    partition_by: Sequence[str] = BY_SYMBOL,
) -> DataFrame:
    """Clean panel to all features, and from those to the rows and columns models use."""
    bars = readers.read_panel(spark, cleaned).select(*cleaning.PANEL_COLUMNS)
    axis = Axis().measured(bars)
    derived = features.bar_features(bars, axis, settings=settings)
    writers.write_panel(derived, full_out, partition_by)
    full = readers.read_panel(spark, full_out)
    writers.write_panel(features.model_features(full, axis), model_out, partition_by)
    return readers.read_panel(spark, model_out)


def run_diagnostics(
    spark: SparkSession,
    model_features: str,
    out: str,
    event_day: str | datetime.date | None = None,
) -> dict[str, DataFrame]:
    """Anomalies, volatility, percentiles, and the widespread days; one day in detail if given."""
    rows = readers.read_panel(spark, model_features)

    def save(name: str, result: DataFrame) -> DataFrame:
        writers.write_panel(result, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    saved = {
        "anomaly_counts_by_coin": save("anomaly_counts_by_coin", diagnostics.anomalies_by_entity(rows)),
        "anomaly_counts_by_date": save("anomaly_counts_by_date", diagnostics.anomalies_by_date(rows)),
        "vol30_summary": save("vol30_summary", diagnostics.volatility_summary(rows)),
        "feature_percentiles": save("feature_percentiles", diagnostics.feature_percentiles(rows)),
    }
    # The daily counts as saved; the panel is not read again.
    by_date = saved["anomaly_counts_by_date"]
    saved["widespread_down_days"] = save("widespread_down_days", diagnostics.widespread_down_days(by_date))
    if event_day is not None:
        saved["event_day"] = save("event_day", by_date.where(F.col("Date") == F.lit(event_day)))
    return saved


def run_regimes(
    spark: SparkSession,
    model_features: str,
    out: str,
    ks: Sequence[int] = range(3, 9),
    seed: int = SEED,
    standardize: bool = True,
    partition_by: Sequence[str] = BY_SYMBOL,
) -> DataFrame:
    """K-Means sweep, best model, named centroids, labelled rows and a metrics record."""
    rows = readers.read_panel(spark, model_features)
    vectors = clusters.assemble(rows)
    scaler = clusters.fit_scaler(vectors) if standardize else None
    column = clusters.SCALED if standardize else clusters.RAW
    if scaler is not None:
        vectors = scaler.transform(vectors)
    fits = clusters.fit_sweep(vectors, ks, column, seed)
    best = clusters.best_fit(fits)
    centres = [clusters.unscaled(c, scaler) for c in best.model.clusterCenters()]
    names = clusters.name_regimes(dict(enumerate(centres)))

    model_dir = f"{out}/models/k{best.k}"
    writers.save_model(best.model, model_dir)
    writers.save_csv(
        clusters.centroid_table(spark, best, scaler, names), f"{out}/centroids.csv"
    )
    predicted = best.model.transform(vectors)
    labelled = predicted.withColumn("regime", clusters.label_clusters(predicted, names))
    path = f"{out}/predictions.parquet"
    written = labelled.select("Date", "symbol", "cluster", "regime")
    writers.write_panel(written, path, partition_by)
    writers.save_json(
        _regime_metrics(spark, fits, best, names, model_dir, seed, standardize),
        f"{out}/metrics.json",
    )
    return readers.read_panel(spark, path).select("Date", "symbol", "cluster", "regime")


def _regime_metrics(spark, fits, best, names, model_dir, seed, standardize) -> DataFrame:
    sizes = "map<string,bigint>"
    schema = (
        f"kmin int, kmax int, seed int, standardize boolean, "
        f"results array<struct<k:int,silhouette:double,sizes:{sizes}>>, "
        f"best struct<k:int,silhouette:double,sizes:{sizes},"
        f"label_map:map<string,string>,model_dir:string>, feature_cols array<string>"
    )

    def record(fit):
        return (fit.k, fit.silhouette, {f"c{c}": n for c, n in fit.sizes.items()})

    labels = {str(c): name for c, name in names.items()}
    row = (
        min(f.k for f in fits), max(f.k for f in fits), seed, standardize,
        [record(f) for f in fits], (*record(best), labels, model_dir), list(FEATURES),
    )
    return spark.createDataFrame([row], schema)


def run_analysis(
    spark: SparkSession,
    predictions: str,
    model_features: str | None,
    out: str,
    steps: Sequence[int] | str = ALL_STEPS,
    split_mode: str = "random",
    test_share: float = 0.2,
    split_date: str | datetime.date | None = None,
    balance_classes: bool = False,
    lead: str = LEAD_SYMBOL,
    cache: bool = True,
    event_day: str | datetime.date | None = None,
) -> dict[str, DataFrame]:
    """Steps 1-7 on labelled rows; every result is saved under ``out`` and returned as saved.

    Labels and features are joined once, and the join's forward returns are taken once, for
    all the steps that need them. Both tables are kept while the steps run if ``cache``.
    """
    steps = ALL_STEPS if steps == "all" else tuple(steps)
    if model_features is None and set(steps) & {3, 4, 5, 6, 7}:
        raise ValueError("steps 3 to 7 need model features")
    labels = readers.read_panel(spark, predictions).select(
        F.to_date("Date").alias("Date"), "symbol", "cluster", "regime"
    )
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        if cache:
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    results = writers.Results(out)
    try:
        axis = Axis().measured(keep(labels))
        if 1 in steps:
            results.save("symbols", cleaning.distinct_entities(labels), short=False)
            manifest = _manifest(labels).withColumn("symbols_table", F.lit("symbols"))
            writers.save_json(manifest, f"{out}/manifest.json")
            if event_day is not None:
                results.save("regime_counts_event_day", transitions.label_counts_on(labels, event_day, axis))
            results.save("regime_counts", transitions.label_counts(labels))
            results.save("top_regimes", transitions.top_labels(labels, axis), short=False)
        if 2 in steps:
            _transition_step(
                labels, keep(transitions.with_run_ids(labels, axis)), axis, results
            )
        if set(steps) & {3, 4, 5, 6, 7}:
            features_table = readers.read_panel(spark, model_features)
            joined = keep(returns.join_features(labels, features_table, axis))
        if set(steps) & {3, 4, 7}:
            forward = keep(returns.with_forward_returns(joined, axis))
        if 3 in steps:
            _return_step(joined, forward, results)
        if 4 in steps:
            _change_step(forward, results)
        if 5 in steps:
            daily = results.save_now(
                "breadth_daily", breadth.breadth_daily(labels, axis), short=False
            )
            results.save("breadth_conservation", breadth.breadth_conservation(daily))
            with_lead = breadth.breadth_with_lead(daily, joined, axis, lead)
            found = results.save_now("breadth_lead_corr", breadth.lead_correlations(with_lead))
            by_share = F.map_from_entries(F.collect_list(F.struct("share", "corr")))
            writers.save_json(
                found.agg(by_share.alias("corr_frac_vs_lead_fwd1"), _now()),
                f"{out}/breadth_lead_corr.json",
            )
        results.flush()
        if 6 in steps:
            _cluster_step(spark, joined, results)
        if 7 in steps:
            labelled = gauge.direction_labels(forward, axis)
            if split_mode == "chron":
                split = gauge.chronological_split(labelled, test_share, split_date, axis)
            else:
                split = gauge.random_split(labelled, test_share, axis)
            _gauge_step(spark, *split, balance_classes, keep, results)
        results.flush()
    finally:
        for df in kept:
            df.unpersist()
    return {name: results.read(name, spark) for name in results.names}


def _now():
    return F.current_timestamp().alias("generated_at")


def _manifest(labels: DataFrame) -> DataFrame:
    return cleaning.panel_summary(labels).select("*", _now())


def _transition_step(
    labels: DataFrame, rows: DataFrame, axis: Axis, results: writers.Results
) -> None:
    counts = transitions.transition_counts(rows)
    # The few count rows feed the tables below as saved.
    saved = results.save_now(
        "transitions_counts", counts.orderBy(F.desc("count"), "regime", "regime_next")
    )
    probabilities = transitions.transition_probabilities(saved)
    results.save("transitions_prob", probabilities.orderBy("regime", "regime_next"))
    for name, value in (("matrix_counts", "count"), ("matrix_prob", "prob")):
        matrix = transitions.transition_matrix(probabilities, value)
        results.save(name, matrix.orderBy("regime"))
        results.save(f"{name}_row_sums", transitions.matrix_row_sums(matrix).orderBy("regime"))
    stay = transitions.stay_probabilities(probabilities)
    results.save("stay_prob", stay.orderBy("regime"))
    runs = transitions.run_lengths(rows, axis)
    results.save("dwell_overall", transitions.dwell_overall(runs))
    results.save("dwell_by_symbol", transitions.dwell_by_entity(runs, axis), short=False)
    # Every labelled row is in exactly one run.
    labelled = labels.agg(F.count(F.lit(1))).scalar()
    whole = transitions.dwell_conservation(runs).select(
        (F.col("total_run_len") == labelled).alias("ok"), _now()
    )
    writers.save_json(whole, f"{results.out}/step2_manifest.json")


def _return_step(joined: DataFrame, forward: DataFrame, results: writers.Results) -> None:
    by_symbol = ["symbol", "regime"]
    results.save("returns_overall", returns.returns_by(joined, ["regime"]))
    results.save("returns_by_symbol", returns.returns_by(joined, by_symbol), short=False)
    results.save("returns_fwd1_overall", returns.forward_returns_by(forward, ["regime"]))
    results.save(
        "returns_fwd1_by_symbol", returns.forward_returns_by(forward, by_symbol), short=False
    )


def _change_step(forward: DataFrame, results: writers.Results) -> None:
    results.save("transitions_fwd1_overall", returns.change_returns(forward))
    results.save(
        "transitions_fwd1_by_symbol",
        returns.change_returns(forward, ["symbol", "transition"]),
        short=False,
    )
    results.save("transitions_fwd1_stay_vs_change", returns.stay_or_change_returns(forward))
    results.save("change_tallies", returns.change_tallies(forward))
    results.save("change_counts", returns.change_counts(forward))


def _cluster_step(spark: SparkSession, joined: DataFrame, results: writers.Results) -> None:
    columns = cleaning.present_columns(joined, FEATURES)
    results.save("step6_cluster_centroids", clusters.centroid_means(joined, "cluster", columns))
    results.save("step6_regime_centroids", clusters.centroid_means(joined, "regime", columns))
    vectors = clusters.assemble(joined.select(*columns), columns)
    fit = clusters.fit_kmeans(vectors, 5, prediction="kpred")
    centres = [[float(v) for v in c] for c in fit.model.clusterCenters()]
    results.save("step6_kmeans_centroids", clusters.plain_centroid_table(spark, centres, columns))
    results.save(
        "step6_per_cluster_silhouette",
        clusters.silhouette_by_cluster(fit.model.transform(vectors), centres, columns=columns),
    )
    summary = spark.createDataFrame(
        [(len(columns), columns, fit.k, fit.silhouette)],
        "num_features int, features array<string>, kmeans_k int, silhouette_overall double",
    )
    writers.save_json(summary.select("*", _now()), f"{results.out}/step6_manifest.json")


def _gauge_step(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    balance_classes: bool,
    keep,
    results: writers.Results,
) -> None:
    columns = cleaning.present_columns(train, FEATURES)
    weight = "w" if balance_classes else None
    weighted = gauge.add_class_weights(train, weight) if weight else train
    model = gauge.fit_gauge(weighted, columns, weight)
    scored = keep(gauge.score(model, test, columns))
    cells = results.save_now("gauge_confusion_default", gauge.confusion(scored))
    sweep = results.save_now("gauge_threshold_sweep", gauge.threshold_sweep(scored))
    results.save("gauge_confusion_best", gauge.confusion_of(gauge.best_threshold(sweep)))
    coefficients = gauge.coefficient_table(spark, model, columns)
    results.save("gauge_coefficients", coefficients)
    areas = gauge.areas(scored)
    writers.save_json(
        gauge_metrics(train, scored, cells, sweep, coefficients, areas, columns),
        f"{results.out}/gauge_metrics.json",
    )


def gauge_metrics(
    train: DataFrame,
    scored: DataFrame,
    cells: DataFrame,
    sweep: DataFrame,
    coefficients: DataFrame,
    areas: tuple[float, float],
    columns: Sequence[str],
) -> DataFrame:
    """One row with everything measured about a fitted gauge."""
    best = gauge.best_threshold(sweep)
    best_names = ("threshold", "f1", "precision", "recall", "accuracy")
    summary = gauge.score_summary(scored)
    at_default = gauge.default_metrics(cells).withColumnRenamed("accuracy", "acc")
    parts = [
        train.agg(F.count(F.lit(1)).alias("train_rows")),
        summary.select(
            "test_rows",
            "test_positive_rate",
            F.struct(*gauge.BASELINES).alias("baselines"),
            "brier",
            F.struct(*gauge.PROBABILITY_QUANTILES).alias("prob_quantiles"),
        ),
        at_default.select(
            *[F.col(c).alias(f"{c}_at_default") for c in ("acc", "precision", "recall", "f1")]
        ),
        best.select(
            *[F.col(c).alias(f"best_{c}") for c in best_names],
            F.struct(*gauge.COUNTS).alias("best_confusion"),
        ),
        _as_list(sweep, "threshold_sweep"),
        _as_list(coefficients, "coefficients"),
    ]
    # Each part is a single row, looked up as such.
    row = parts[0]
    for part in parts[1:]:
        found = row.withColumn("_part", part.select(F.struct("*")).scalar())
        row = found.select("*", "_part.*").drop("_part")
    return row.withColumns(
        {
            "num_features": F.lit(len(columns)),
            "features": F.array(*[F.lit(c) for c in columns]),
            "roc_auc": F.lit(areas[0]),
            "pr_auc": F.lit(areas[1]),
            "default_threshold": F.lit(0.5),
            "generated_at": F.current_timestamp(),
        }
    )


def _as_list(short: DataFrame, name: str) -> DataFrame:
    """A table of a few rows as one row with a list of records, in order of its columns."""
    return short.agg(F.sort_array(F.collect_list(F.struct("*"))).alias(name))

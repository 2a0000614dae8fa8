"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import positive_probability
from tideline.operators import (
    asof, breadth, calendar, cleaning, clusters, diagnostics, exclusion, features, gauge, intervals, ranking, reshape, returns,
    rollups, runs, transitions,
)
from tideline.operators.layout import Axis
from tideline.plans import panels, stages
from tideline.plans.panels import DAILY, LEAD, TICKS
from tideline.session import materialise, scratch_path, stored
from tideline.settings import FEATURES, REGIMES
from tideline.sources import json_columns, readers, writers
from tideline.streaming import run_ids as streamed_runs
from tideline.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(make: Query) -> Query:
    """Registers a query under its name; its floating-point columns are rounded."""

    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = make(spark, sf_dir)
        doubles = [f.name for f in result.schema.fields if isinstance(f.dataType, T.DoubleType)]
        unit = 10.0**DIGITS
        return result.withColumns({c: F.rint(F.col(f"`{c}`") * unit) / unit for c in doubles})

    QUERIES[make.__name__] = rounded
    return make


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.rule_labels(panels.ship_model_features(spark, sf_dir))


def joined_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with their labels; made on the same row, they need no join here."""
    return panels.with_rule_labels(panels.ship_model_features(spark, sf_dir))


def forward_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.with_forward_returns(joined_of(spark, sf_dir), DAILY)


# --- sources, cleaning --------------------------------------------------------------------


@query
def clean_bars(spark, sf_dir):
    return cleaning.clean_bars(panels.raw_bars(spark, sf_dir), exclude=["s7", "S8"])


@query
def csv_ingest(spark, sf_dir):
    """Raw text written as CSV files in nested folders, scanned back and cleaned."""
    path = scratch_path(spark, "raw")
    raw = panels.raw_bars(spark, sf_dir).drop("file_name")
    for folder, told in (("a", F.col("Symbol").isNotNull()), ("b/c", F.col("Symbol").isNull())):
        raw.where(told).write.option("header", True).csv(f"{path}/{folder}")
    scanned = readers.read_raw_bars(spark, path)
    return cleaning.clean_bars(scanned, exclude=["s7", "S8"])


@query
def csv_files_seen(spark, sf_dir):
    """Rows per kind of file name recorded by the scan."""
    path = scratch_path(spark, "raw")
    panels.raw_bars(spark, sf_dir).drop("file_name").write.option("header", True).csv(f"{path}/x")
    name = F.regexp_extract("file_name", r"/x/part-.*\.(csv)$", 1)
    scanned = readers.read_raw_bars(spark, path)
    return scanned.groupBy(name.alias("kind")).agg(F.count(F.lit(1)).alias("rows"))


@query
def panel_roundtrip(spark, sf_dir):
    """The bars through the partitioned sink and back; symbols come from the folder names."""
    path = scratch_path(spark, "panel")
    writers.write_panel(panels.ship_bars(spark, sf_dir), path, ["symbol"])
    return readers.read_panel(spark, path).select(*cleaning.PANEL_COLUMNS)


@query
def panel_roundtrip_numeric_symbols(spark, sf_dir):
    """Symbols that look like numbers, with and without leading zeros, keep their text."""
    path = scratch_path(spark, "panel")
    number = F.substring("symbol", 2, 20)
    padded = F.when(F.dayofmonth("Date") % 2 == 0, F.lpad(number, 5, "0")).otherwise(number)
    bars = panels.ship_bars(spark, sf_dir).withColumn("symbol", padded)
    writers.write_panel(bars, path, ["symbol"])
    return readers.read_panel(spark, path).select(*cleaning.PANEL_COLUMNS)


@query
def result_roundtrip(spark, sf_dir):
    """Both forms of a saved result, read back through the result scan."""
    base = scratch_path(spark, "results")
    counts = transitions.label_counts(labels_of(spark, sf_dir))
    writers.save_result(counts, f"{base}/both")
    writers.save_csv(spark.read.parquet(f"{base}/both"), f"{base}/text_csv")
    read = [
        readers.read_table(spark, base, name).select(
            F.lit(form).alias("form"), "regime", F.col("count").cast("bigint").alias("count")
        )
        for form, name in (("parquet", "both"), ("csv", "text"))
    ]
    return read[0].unionByName(read[1])


@query
def summary_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "summary")
    writers.save_json(cleaning.panel_summary(panels.ship_bars(spark, sf_dir)), path)
    schema = "rows bigint, symbols bigint, min_date date, max_date date"
    return spark.read.schema(schema).json(path)


@query
def dataset_summary(spark, sf_dir):
    return cleaning.panel_summary(panels.ship_bars(spark, sf_dir))


@query
def distinct_symbols(spark, sf_dir):
    return cleaning.distinct_entities(panels.ship_bars(spark, sf_dir))


@query
def feature_retention(spark, sf_dir):
    return cleaning.retention(panels.ship_features(spark, sf_dir), FEATURES)


@query
def optional_columns(spark, sf_dir):
    """Join on a feature table that lacks some of the optional columns."""
    rows = panels.ship_model_features(spark, sf_dir)
    return returns.join_features(
        panels.rule_labels(rows), rows.drop("zscore_7", "ma_gap_7"), DAILY
    )


# --- features -----------------------------------------------------------------------------


@query
def features_full(spark, sf_dir):
    return panels.ship_features(spark, sf_dir)


@query
def features_model(spark, sf_dir):
    return panels.ship_model_features(spark, sf_dir)


@query
def features_orders(spark, sf_dir):
    """Features of five symbols that share a whole table."""
    return features.bar_features(panels.order_bars(spark, sf_dir), DAILY)


@query
def features_simple_returns(spark, sf_dir):
    settings = features.FeatureSettings(log_returns=False)
    full = features.bar_features(panels.ship_bars(spark, sf_dir), DAILY, settings=settings)
    return full.select("Date", "symbol", "ret_1d", "ret_pct", "ret_1d_w")


def _tick_features(spark, sf_dir) -> tuple[DataFrame, Axis]:
    rows = panels.ticks(spark, sf_dir)
    axis = TICKS.measured(rows)
    return features.bar_features(rows, axis, price="value"), axis


def _moment(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


@query
def ticks_features(spark, sf_dir):
    """Features of event types, each far too large for one window, cut into blocks."""
    full, _ = _tick_features(spark, sf_dir)
    return full.select("event_type", _moment("ts"), "value", *features.DERIVED)


# --- diagnostics --------------------------------------------------------------------------


@query
def feature_percentiles(spark, sf_dir):
    rows = panels.ship_model_features(spark, sf_dir)
    return diagnostics.feature_percentiles(rows, exact=True)


@query
def feature_percentiles_sketch(spark, sf_dir):
    """The one-pass form; its values may differ from the exact ones in the last ranks."""
    return diagnostics.feature_percentiles(panels.ship_model_features(spark, sf_dir))


@query
def anomaly_counts(spark, sf_dir):
    return diagnostics.anomaly_counts(panels.ship_features(spark, sf_dir), DAILY)


@query
def anomaly_counts_by_symbol(spark, sf_dir):
    return diagnostics.anomalies_by_entity(panels.ship_model_features(spark, sf_dir), DAILY)


@query
def anomaly_counts_by_date(spark, sf_dir):
    return diagnostics.anomalies_by_date(panels.ship_model_features(spark, sf_dir), DAILY)


@query
def event_day(spark, sf_dir):
    rows = panels.ship_model_features(spark, sf_dir)
    return diagnostics.anomalies_on(rows, "1998-03-12", DAILY, limit=1.0)


@query
def widespread_down_days(spark, sf_dir):
    rows = panels.ship_model_features(spark, sf_dir)
    by_date = diagnostics.anomalies_by_date(rows, DAILY, limit=1.5)
    return diagnostics.widespread_down_days(by_date)


@query
def volatility_summary(spark, sf_dir):
    return diagnostics.volatility_summary(panels.ship_model_features(spark, sf_dir), DAILY)


@query
def top_moves_up(spark, sf_dir):
    return diagnostics.top_moves(panels.ship_features(spark, sf_dir), True, DAILY)


@query
def top_moves_down(spark, sf_dir):
    return diagnostics.top_moves(panels.ship_features(spark, sf_dir), False, DAILY)


@query
def top_zscores(spark, sf_dir):
    return diagnostics.top_zscores(panels.ship_features(spark, sf_dir), DAILY)


@query
def volatility_head(spark, sf_dir):
    return diagnostics.volatility_series(
        panels.ship_features(spark, sf_dir), LEAD, DAILY, first=20
    )


@query
def volatility_series(spark, sf_dir):
    return diagnostics.volatility_series(panels.ship_model_features(spark, sf_dir), LEAD, DAILY)


# --- labels, transitions, runs ------------------------------------------------------------


@query
def rule_labels(spark, sf_dir):
    return labels_of(spark, sf_dir)


@query
def labels_with_features(spark, sf_dir):
    """Labels joined with features as two tables."""
    rows = panels.ship_model_features(spark, sf_dir)
    return returns.join_features(panels.rule_labels(rows), rows, DAILY)


@query
def regime_counts(spark, sf_dir):
    return transitions.label_counts(labels_of(spark, sf_dir))


@query
def regime_counts_by_symbol(spark, sf_dir):
    return transitions.label_counts(labels_of(spark, sf_dir), ["symbol"])


@query
def regime_counts_on_date(spark, sf_dir):
    return transitions.label_counts_on(labels_of(spark, sf_dir), "1998-03-12", DAILY)


@query
def top_regimes_by_symbol(spark, sf_dir):
    return transitions.top_labels(labels_of(spark, sf_dir), DAILY)


@query
def neighbours(spark, sf_dir):
    return transitions.with_neighbours(labels_of(spark, sf_dir), DAILY)


def counts_of(spark, sf_dir, strict: bool = False) -> DataFrame:
    rows = transitions.with_neighbours(labels_of(spark, sf_dir), DAILY)
    return transitions.transition_counts(rows, strict)


def probabilities_of(spark, sf_dir) -> DataFrame:
    return transitions.transition_probabilities(counts_of(spark, sf_dir))


@query
def transition_counts(spark, sf_dir):
    return counts_of(spark, sf_dir)


@query
def transition_counts_strict(spark, sf_dir):
    return counts_of(spark, sf_dir, strict=True)


@query
def transition_probabilities(spark, sf_dir):
    return probabilities_of(spark, sf_dir)


@query
def matrix_counts(spark, sf_dir):
    return transitions.transition_matrix(counts_of(spark, sf_dir), "count")


@query
def matrix_probabilities(spark, sf_dir):
    return transitions.transition_matrix(probabilities_of(spark, sf_dir), "prob")


@query
def matrix_row_sums(spark, sf_dir):
    matrix = transitions.transition_matrix(probabilities_of(spark, sf_dir), "prob")
    return transitions.matrix_row_sums(matrix)


@query
def matrix_dense(spark, sf_dir):
    """The matrix over one label more than the data have, in full."""
    matrix = transitions.transition_matrix(probabilities_of(spark, sf_dir), "prob")
    return reshape.dense_matrix(matrix, [*REGIMES, "Unknown"])


@query
def stay_probabilities(spark, sf_dir):
    return transitions.stay_probabilities(probabilities_of(spark, sf_dir))


def run_rows_of(spark, sf_dir) -> DataFrame:
    return transitions.with_run_ids(labels_of(spark, sf_dir), DAILY)


def lengths_of(spark, sf_dir) -> DataFrame:
    return transitions.run_lengths(run_rows_of(spark, sf_dir), DAILY)


@query
def run_ids(spark, sf_dir):
    return run_rows_of(spark, sf_dir)


@query
def run_lengths(spark, sf_dir):
    return lengths_of(spark, sf_dir)


@query
def dwell_overall(spark, sf_dir):
    return transitions.dwell_overall(lengths_of(spark, sf_dir), exact=True)


@query
def dwell_by_symbol(spark, sf_dir):
    return transitions.dwell_by_entity(lengths_of(spark, sf_dir), DAILY)


@query
def dwell_conservation(spark, sf_dir):
    return transitions.dwell_conservation(lengths_of(spark, sf_dir))


@query
def dwell_in_label_order(spark, sf_dir):
    """Dwell statistics in list order, with NULLs for a label that the data lack."""
    dwell = transitions.dwell_overall(lengths_of(spark, sf_dir), exact=True)
    return reshape.in_label_order(dwell, ["Unknown", *REGIMES])


def _tick_labels(spark, sf_dir) -> tuple[DataFrame, Axis]:
    rows = panels.ticks(spark, sf_dir)
    regime = F.when(F.col("value") < 20, REGIMES[0]).when(F.col("value") < 60, REGIMES[1])
    labelled = rows.select(
        "event_type", "ts", "value", regime.otherwise(REGIMES[2]).alias("regime")
    )
    return labelled, TICKS.measured(rows)


@query
def ticks_run_ids(spark, sf_dir):
    """Run ids that carry on across the blocks of a hot entity."""
    labels, axis = _tick_labels(spark, sf_dir)
    rows = transitions.with_run_ids(labels, axis)
    return rows.withColumn("ts", _moment("ts"))


@query
def ticks_run_lengths(spark, sf_dir):
    labels, axis = _tick_labels(spark, sf_dir)
    return transitions.run_lengths(transitions.with_run_ids(labels, axis), axis)


@query
def ticks_transition_counts(spark, sf_dir):
    labels, axis = _tick_labels(spark, sf_dir)
    return transitions.transition_counts(transitions.with_neighbours(labels, axis))


@query
def ticks_forward_returns(spark, sf_dir):
    labels, axis = _tick_labels(spark, sf_dir)
    forward = returns.with_forward_returns(labels, axis, value="value")
    return returns.forward_returns_by(forward.where("has_prev"), ["regime"], exact_median=True)


@query
def ticks_null_returns(spark, sf_dir):
    """Forward rows where some returns are missing: the row before is one that was kept."""
    rows = panels.table(spark, sf_dir, "events")
    regime = F.when(F.col("value") < 20, REGIMES[0]).when(F.col("value") < 60, REGIMES[1])
    labels = rows.select(
        "event_id", "event_type", "ts", regime.otherwise(REGIMES[2]).alias("regime"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )
    forward = returns.with_forward_returns(labels, TICKS.measured(labels), value="value")
    return forward.select("event_id", "regime", "regime_prev", "ret_fwd1", "has_prev", "is_transition")


@query
def ticks_null_times(spark, sf_dir):
    """Run ids where each type's first event has no time and a third of the events no type."""
    rows = panels.table(spark, sf_dir, "events")
    kind = F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type")
    regime = F.when(F.col("value") < 20, REGIMES[0]).otherwise(REGIMES[1]).alias("regime")
    known = rows.select("event_id", kind, "ts", regime)
    first = known.groupBy(F.col("event_type").alias("of")).agg(F.min("event_id").alias("first"))
    holed = known.join(first, F.col("event_type").eqNullSafe(F.col("of"))).select(
        "event_id", "event_type", "regime", F.when(F.col("event_id") != F.col("first"), F.col("ts")).alias("ts")
    )
    found = transitions.with_run_ids(holed, TICKS.measured(holed))
    return found.select("event_id", "regime", "regime_next", "regime_prev", "regime_group_id")


@query
def ticks_rolling_correlation(spark, sf_dir):
    """Rolling correlation along the whole event stream, one series cut into blocks."""
    rows = panels.table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", F.when(F.col("event_id") % 101 != 0, F.col("user_id")).alias("u")
    )
    rows = rows.withColumn("u", F.col("u").cast("double"))
    size = {"min_block_rows": 256}
    found = breadth.rolling_correlation(rows, "value", "u", time="ts", **size)
    return found.select("event_id", "corr30")


# --- returns ------------------------------------------------------------------------------


@query
def returns_overall(spark, sf_dir):
    return returns.returns_by(joined_of(spark, sf_dir), ["regime"], exact_median=True)


@query
def returns_by_symbol(spark, sf_dir):
    return returns.returns_by(joined_of(spark, sf_dir), ["symbol", "regime"])


@query
def forward_rows(spark, sf_dir):
    return forward_of(spark, sf_dir).select(
        "Date", "symbol", "regime", "ret_fwd1", "regime_prev", "has_prev", "is_transition",
        "transition",
    )


@query
def returns_fwd1_overall(spark, sf_dir):
    return returns.forward_returns_by(forward_of(spark, sf_dir), ["regime"], exact_median=True)


@query
def returns_fwd1_by_symbol(spark, sf_dir):
    return returns.forward_returns_by(forward_of(spark, sf_dir), ["symbol", "regime"])


@query
def transitions_fwd1_overall(spark, sf_dir):
    return returns.change_returns(forward_of(spark, sf_dir), exact_median=True)


@query
def transitions_fwd1_by_symbol(spark, sf_dir):
    return returns.change_returns(forward_of(spark, sf_dir), ["symbol", "transition"])


@query
def transitions_fwd1_stay_vs_change(spark, sf_dir):
    return returns.stay_or_change_returns(forward_of(spark, sf_dir), exact_median=True)


@query
def change_tallies(spark, sf_dir):
    return returns.change_tallies(forward_of(spark, sf_dir))


@query
def change_counts(spark, sf_dir):
    return returns.change_counts(forward_of(spark, sf_dir))


@query
def top_changes(spark, sf_dir):
    changes = returns.change_returns(forward_of(spark, sf_dir), exact_median=True)
    return returns.top_changes(changes, 8)


@query
def returns_in_label_order(spark, sf_dir):
    stats = returns.returns_by(joined_of(spark, sf_dir), ["regime"], exact_median=True)
    return reshape.in_label_order(stats, ["Unknown", *REGIMES])


# --- breadth ------------------------------------------------------------------------------


@query
def breadth_daily(spark, sf_dir):
    return breadth.breadth_daily(labels_of(spark, sf_dir), DAILY)


def with_lead_of(spark, sf_dir, keep_last: bool = False) -> DataFrame:
    joined = joined_of(spark, sf_dir)
    daily = breadth.breadth_daily(joined, DAILY)
    return breadth.breadth_with_lead(daily, joined, DAILY, LEAD, keep_last)


@query
def breadth_with_lead(spark, sf_dir):
    return with_lead_of(spark, sf_dir).select("Date", "total_syms", "frac_bull", "lead_fwd1")


@query
def breadth_conservation(spark, sf_dir):
    """On all dates, not only those of the lead."""
    return breadth.breadth_conservation(breadth.breadth_daily(labels_of(spark, sf_dir), DAILY))


@query
def breadth_lead_correlations(spark, sf_dir):
    return breadth.lead_correlations(with_lead_of(spark, sf_dir))


@query
def breadth_rolling_correlation(spark, sf_dir):
    with_lead = with_lead_of(spark, sf_dir, keep_last=True)
    found = breadth.rolling_correlation(with_lead, "frac_bull", "lead_fwd1")
    return found.select("Date", "frac_bull", "lead_fwd1", "corr30")


@query
def lead_forward_series(spark, sf_dir):
    return returns.forward_series(panels.ship_model_features(spark, sf_dir), LEAD, DAILY)


# --- clusters -----------------------------------------------------------------------------


@query
def cluster_centroids(spark, sf_dir):
    return clusters.centroid_means(joined_of(spark, sf_dir), "cluster")


@query
def regime_centroids(spark, sf_dir):
    return clusters.centroid_means(joined_of(spark, sf_dir), "regime")


@query
def centroids_long(spark, sf_dir):
    return reshape.long_centroids(clusters.centroid_means(joined_of(spark, sf_dir), "cluster"))


def _scaled(rows: DataFrame):
    vectors = clusters.assemble(rows)
    scaler = clusters.fit_scaler(vectors)
    return scaler.transform(vectors), scaler


@query
def scaled_features(spark, sf_dir):
    scaled, _ = _scaled(materialise(joined_of(spark, sf_dir), "joined"))
    return scaled.select("Date", "symbol", *clusters.scaled_columns(scaled))


def _unscaled_means(spark, sf_dir, cluster: Column) -> dict[int, list[float]]:
    """Mean scaled vector per cluster back in feature units, a row each."""
    names = [f"scaled_{c}" for c in FEATURES]
    with stored(joined_of(spark, sf_dir), "joined") as rows:
        scaled, scaler = _scaled(rows)
        grouped = scaled.select(cluster.alias("cluster"), *clusters.scaled_columns(scaled)).groupBy("cluster")
        means = sorted(grouped.agg(*[F.avg(n).alias(n) for n in names]).collect())
    return {r["cluster"]: clusters.unscaled(r[1:], scaler) for r in means}


@query
def unscaled_centres(spark, sf_dir):
    """Centres of scaled groups put back into feature units."""
    centres = _unscaled_means(spark, sf_dir, F.col("cluster"))
    return clusters.plain_centroid_table(spark, list(centres.values()))


@query
def regime_names(spark, sf_dir):
    """Names that the rules give to the rule clusters from their centres."""
    centres = _unscaled_means(spark, sf_dir, F.col("cluster"))
    rows = sorted(clusters.name_regimes(centres).items())
    return spark.createDataFrame(rows, "cluster int, regime string")


@query
def regime_names_three(spark, sf_dir):
    """The same for three clusters of all rows, where fewer than five names are given."""
    centres = _unscaled_means(spark, sf_dir, F.col("cluster") % 3)
    rows = sorted(clusters.name_regimes(centres).items())
    return spark.createDataFrame(rows, "cluster int, regime string")


@query
def centre_silhouettes(spark, sf_dir):
    """Silhouettes of the rule clusters against their own mean vectors."""
    rows = materialise(joined_of(spark, sf_dir), "joined")
    means = clusters.centroid_means(rows, "cluster").collect()
    centres = [[r[f"avg_{c}"] for c in FEATURES] for r in means]
    return clusters.silhouette_by_cluster(rows, centres, prediction="cluster")


def _model_rows(spark, sf_dir) -> DataFrame:
    return materialise(panels.ship_model_features(spark, sf_dir), "features")


def _regime_fit(spark, sf_dir, ks: Sequence[int]):
    vectors = clusters.assemble(_model_rows(spark, sf_dir))
    scaler = clusters.fit_scaler(vectors)
    scaled = scaler.transform(vectors)
    fits = clusters.fit_sweep(scaled, ks, clusters.SCALED)
    return scaled, scaler, fits


@query
def kmeans_sweep(spark, sf_dir):
    _, _, fits = _regime_fit(spark, sf_dir, range(3, 9))
    return clusters.sweep_table(spark, fits)


@query
def kmeans_centroids(spark, sf_dir):
    _, scaler, fits = _regime_fit(spark, sf_dir, [5])
    centres = fits[0].model.clusterCenters()
    names = clusters.name_regimes({i: clusters.unscaled(c, scaler) for i, c in enumerate(centres)})
    return clusters.centroid_table(spark, fits[0], scaler, names)


@query
def kmeans_predictions(spark, sf_dir):
    scaled, scaler, fits = _regime_fit(spark, sf_dir, [5])
    model = fits[0].model
    centres = {i: clusters.unscaled(c, scaler) for i, c in enumerate(model.clusterCenters())}
    predicted = model.transform(scaled)
    regime = clusters.label_clusters(predicted, clusters.name_regimes(centres))
    return predicted.select("Date", "symbol", "cluster", regime.alias("regime"))


@query
def kmeans_saved_model(spark, sf_dir):
    """Cluster sizes of a model that was saved and loaded again."""
    scaled, _, fits = _regime_fit(spark, sf_dir, [4])
    path = scratch_path(spark, "model")
    writers.save_model(fits[0].model, path)
    predicted = KMeansModel.load(path).transform(scaled)
    return predicted.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def _plain_fit(spark, sf_dir):
    vectors = clusters.assemble(_model_rows(spark, sf_dir))
    fit = clusters.fit_kmeans(vectors, 5, prediction="kpred")
    return vectors, fit, [list(c) for c in fit.model.clusterCenters()]


def _nearest(column: str, centres) -> Column:
    """Number of the nearest centre, the first of equal ones.

    The vector becomes an array once a row and each distance is taken once: bound in a lambda,
    neither is repeated in the plan for every centre and component.
    """
    points = F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in centres])

    def distances(values: Column) -> Column:
        return F.transform(
            points,
            lambda centre: F.aggregate(
                F.zip_with(values, centre, lambda x, c: (x - c) ** 2), F.lit(0.0), lambda total, d: total + d
            ),
        )

    def first_least(apart: Column) -> Column:
        return F.array_position(apart, F.array_min(apart))

    nearest = F.transform(F.array(vector_to_array(F.col(column))), lambda values: distances(values))
    return F.transform(nearest, first_least)[0].cast("int") - 1


@query
def kmeans_sweep_laws(spark, sf_dir):
    """Per k: the sizes add up to all rows, and no row is nearer to another centre."""
    scaled, _, fits = _regime_fit(spark, sf_dir, range(3, 9))
    found = []
    for fit in fits:
        strays = fit.model.transform(scaled).where(
            F.col("cluster") != _nearest(clusters.SCALED, fit.model.clusterCenters())
        )
        rows = F.lit(sum(fit.sizes.values())).cast("bigint").alias("rows")
        between = F.lit(-1 <= fit.silhouette <= 1).alias("silhouette_in_range")
        found.append(strays.agg(F.lit(fit.k).alias("k"), rows, F.count("*").alias("strays"), between))
    return reduce(DataFrame.unionByName, found)


@query
def kmeans_saved_laws(spark, sf_dir):
    """A model that was saved and loaded again puts no row in another cluster."""
    scaled, _, fits = _regime_fit(spark, sf_dir, [4])
    path = scratch_path(spark, "model")
    writers.save_model(fits[0].model, path)
    loaded = KMeansModel.load(path).setPredictionCol("again")
    both = loaded.transform(fits[0].model.transform(scaled))
    return both.agg(
        F.count("*").alias("rows"), F.count_if(F.col("cluster") != F.col("again")).alias("moved")
    )


@query
def kmeans_label_laws(spark, sf_dir):
    """Every row is labelled, by one name per cluster."""
    named = kmeans_predictions(spark, sf_dir).groupBy("cluster", "regime").agg(F.count("*").alias("n"))
    return named.agg(
        F.sum("n").alias("rows"), F.count_distinct("cluster").alias("clusters"),
        F.count("*").alias("pairs"), F.count_if(F.col("regime") == "Unknown").alias("unnamed"),
    )


@query
def kmeans_unscaled_laws(spark, sf_dir):
    vectors, fit, centres = _plain_fit(spark, sf_dir)
    strays = F.col("kpred") != _nearest(clusters.RAW, centres)
    return fit.model.transform(vectors).agg(F.count("*").alias("rows"), F.count_if(strays).alias("strays"))


@query
def centroid_csv_roundtrip(spark, sf_dir):
    """A centroid table as one CSV file, read back."""
    path = scratch_path(spark, "centroids")
    writers.save_csv(clusters.centroid_means(joined_of(spark, sf_dir), "cluster"), path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


@query
def kmeans_unscaled_centroids(spark, sf_dir):
    _, _, centres = _plain_fit(spark, sf_dir)
    return clusters.plain_centroid_table(spark, centres)


@query
def kmeans_silhouettes(spark, sf_dir):
    vectors, fit, centres = _plain_fit(spark, sf_dir)
    return clusters.silhouette_by_cluster(fit.model.transform(vectors), centres)


# --- gauge --------------------------------------------------------------------------------


def labelled_of(spark, sf_dir) -> DataFrame:
    return gauge.direction_labels(forward_of(spark, sf_dir), DAILY)


@query
def direction_labels(spark, sf_dir):
    return labelled_of(spark, sf_dir)


def _sides(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query
def split_random(spark, sf_dir):
    sides = _sides(*gauge.random_split(labelled_of(spark, sf_dir), axis=DAILY))
    return sides.select("Date", "symbol", "side")


@query
def split_chronological(spark, sf_dir):
    sides = _sides(
        *gauge.chronological_split(labelled_of(spark, sf_dir), axis=DAILY, exact=True)
    )
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("Date").alias("first"), F.max("Date").alias("last")
    )


@query
def split_on_date(spark, sf_dir):
    sides = _sides(
        *gauge.chronological_split(labelled_of(spark, sf_dir), cut_date="1999-12-31", axis=DAILY)
    )
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query
def class_weights(spark, sf_dir):
    train, _ = gauge.random_split(labelled_of(spark, sf_dir), axis=DAILY)
    return gauge.class_weights(train)


@query
def weighted_rows(spark, sf_dir):
    train, _ = gauge.random_split(labelled_of(spark, sf_dir), axis=DAILY)
    weighted = gauge.add_class_weights(train)
    return weighted.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w"))


def rule_scores(spark, sf_dir) -> DataFrame:
    """Labelled rows with a fixed logistic score in place of a fitted one."""
    z = 0.4 * F.col("zscore_7") - 0.6 * F.col("ret_1d_w") + 0.05
    # Rounded so that both engines see the same scores, and with them the same ties.
    proba = F.rint(10.0**DIGITS / (1 + F.exp(-z))) / 10.0**DIGITS
    scored = labelled_of(spark, sf_dir).select("Date", "symbol", "label", proba.alias("proba1"))
    return scored.withColumn("prediction", (F.col("proba1") > 0.5).cast("double"))


@query
def score_confusion(spark, sf_dir):
    return gauge.confusion(rule_scores(spark, sf_dir))


@query
def score_point_metrics(spark, sf_dir):
    return gauge.default_metrics(gauge.confusion(rule_scores(spark, sf_dir)))


@query
def score_threshold_sweep(spark, sf_dir):
    return gauge.threshold_sweep(rule_scores(spark, sf_dir))


@query
def score_best_threshold(spark, sf_dir):
    return gauge.best_threshold(gauge.threshold_sweep(rule_scores(spark, sf_dir)))


@query
def score_best_confusion(spark, sf_dir):
    sweep = gauge.threshold_sweep(rule_scores(spark, sf_dir))
    return gauge.confusion_of(gauge.best_threshold(sweep))


@query
def score_brier(spark, sf_dir):
    return gauge.brier(rule_scores(spark, sf_dir))


@query
def score_quantiles(spark, sf_dir):
    return gauge.probability_quantiles(rule_scores(spark, sf_dir), exact=True)


@query
def score_baselines(spark, sf_dir):
    return gauge.trivial_baselines(rule_scores(spark, sf_dir))


@query
def score_areas(spark, sf_dir):
    roc, pr = gauge.areas(rule_scores(spark, sf_dir), raw="proba1", bins=0)
    return gauge.area_table(spark, roc, pr)


def _gauge_fit(spark, sf_dir, balanced: bool = False):
    labelled = materialise(labelled_of(spark, sf_dir), "labelled")
    train, test = gauge.random_split(labelled, axis=DAILY)
    weighted = gauge.add_class_weights(train) if balanced else train
    model = gauge.fit_gauge(weighted, weight="w" if balanced else None)
    return model, train, gauge.score(model, test)


@query
def gauge_laws(spark, sf_dir):
    """A fit without penalty has no gradient left: predictions and labels agree on average, also
    when weighed by any feature. Averages are rounded to what the optimiser promises."""
    model, train, _ = _gauge_fit(spark, sf_dir)
    error = F.col("proba1") - F.col("label")
    gaps = [error, *[error * F.col(c) for c in FEATURES]]
    worst = F.greatest(*[F.abs(F.avg(gap)) for gap in gaps])
    return gauge.score(model, train).agg(
        F.count("*").alias("train_rows"), (worst < 1e-3).alias("no_gradient"),
        F.lit(len(model.coefficients)).alias("weights"),
    )


@query
def gauge_closed_form_weights(spark, sf_dir):
    """Weights of a fit on two of the event types, where they are differences of log odds."""
    is_type = {f"is_{t}": (F.col("event_type") == t).cast("double") for t in ("error", "click")}
    rows = panels.table(spark, sf_dir, "events").select(
        (F.col("value") >= 20).cast("double").alias("label"), *[c.alias(n) for n, c in is_type.items()]
    )
    rows = rows.where("label IS NOT NULL AND is_error IS NOT NULL")
    model = gauge.fit_gauge(rows, list(is_type))
    return gauge.coefficient_table(spark, model, list(is_type)).withColumn("weight", F.round("weight", 3))


@query
def positive_probabilities(spark, sf_dir):
    """The positive element of probability vectors made from the rule scores."""
    rows = rule_scores(spark, sf_dir)
    vector = array_to_vector(F.array(1 - F.col("proba1"), F.col("proba1")))
    return rows.select("Date", "symbol", positive_probability(vector).alias("proba1"))


@query
def strongest_weights(spark, sf_dir):
    """The three strongest of a coefficient table whose weights are feature means."""
    means = joined_of(spark, sf_dir).agg(*[F.avg(c).alias(c) for c in FEATURES])
    return gauge.by_strength(means.unpivot([], list(FEATURES), "feature", "weight")).limit(3)


@query
def gauge_coefficients(spark, sf_dir):
    model, _, _ = _gauge_fit(spark, sf_dir)
    return gauge.by_strength(gauge.coefficient_table(spark, model))


@query
def gauge_coefficients_balanced(spark, sf_dir):
    model, _, _ = _gauge_fit(spark, sf_dir, balanced=True)
    return gauge.by_strength(gauge.coefficient_table(spark, model), strongest_first=False)


@query
def gauge_confusion_default(spark, sf_dir):
    _, _, scored = _gauge_fit(spark, sf_dir)
    return gauge.confusion(scored)


@query
def gauge_threshold_sweep(spark, sf_dir):
    _, _, scored = _gauge_fit(spark, sf_dir)
    return gauge.threshold_sweep(scored)


@query
def gauge_metrics(spark, sf_dir):
    model, train, scored = _gauge_fit(spark, sf_dir)
    row = stages.gauge_metrics(
        train, scored, gauge.confusion(scored), gauge.threshold_sweep(scored),
        gauge.coefficient_table(spark, model), gauge.areas(scored), FEATURES,
    )
    plain = ["train_rows", "test_rows", "test_positive_rate", "brier", "roc_auc", "pr_auc"]
    plain += [c for c in row.columns if c.endswith("_at_default") or c.startswith("best_")]
    return row.select(*[c for c in plain if c != "best_confusion"])


@query
def analysis_results(spark, sf_dir):
    """All seven steps on stored tables; rows of each result they save."""
    root = scratch_path(spark, "analysis")
    rows = _model_rows(spark, sf_dir)
    writers.write_panel(rows, f"{root}/features", ["symbol"])
    writers.write_panel(panels.rule_labels(rows), f"{root}/predictions", ["symbol"])
    saved = stages.run_analysis(
        spark, f"{root}/predictions", f"{root}/features", f"{root}/out", lead=LEAD
    )
    counted = [
        df.agg(F.lit(name).alias("result"), F.count(F.lit(1)).alias("rows"))
        for name, df in saved.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


# --- replicated panels, benchmark runs ----------------------------------------------------


@query
def replicated_panel(spark, sf_dir):
    """Rows and closes per symbol of the bars five times over."""
    scaled = reshape.replicate_entities(panels.ship_bars(spark, sf_dir), 5)
    return scaled.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.max("Close").alias("close")
    )


@query
def run_summary(spark, sf_dir):
    return runs.benchmark_summary(panels.run_records(spark, sf_dir))


@query
def run_summary_without_baseline(spark, sf_dir):
    return runs.benchmark_summary(panels.run_records(spark, sf_dir, with_baseline=False))


@query
def run_wall_times(spark, sf_dir):
    return runs.wall_times(panels.run_records(spark, sf_dir))


@query
def run_speedups(spark, sf_dir):
    return runs.wall_speedups(panels.run_records(spark, sf_dir))


@query
def run_step_speedups(spark, sf_dir):
    return runs.step_speedups(panels.run_records(spark, sf_dir))


@query
def run_step_seconds(spark, sf_dir):
    return runs.step_seconds(panels.timing_lines(spark, sf_dir), "user_1")


@query
def run_records_roundtrip(spark, sf_dir):
    """Run records through JSON lines, among them lines that do not parse."""
    base = scratch_path(spark, "runs")
    lines = panels.run_records(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    broken = panels.timing_lines(spark, sf_dir).where(F.col("value").endswith("broken"))
    lines.unionByName(broken).write.text(f"{base}/summary.jsonl")
    return readers.read_runs(spark, base).select(
        "exp_id", "run_id", "run_idx", "wall_seconds", "step3_s"
    )


# --- as-of joins, spans of time, intervals, global ranks, streams -------------------------


def _daily_regimes(spark, sf_dir) -> DataFrame:
    """A regime per event type and day, from its mean value; known from the next midnight on."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    daily = panels.table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        (F.sum(cents) / F.count(cents)).alias("mean")
    )
    regime = F.when(F.col("mean") < 1900, REGIMES[0]).when(F.col("mean") < 2100, REGIMES[1]).otherwise(REGIMES[2])
    return daily.select("event_type", F.date_add("day", 1).alias("known_time"), regime.alias("regime"))


@query
def ticks_asof_regime(spark, sf_dir):
    """Each event with the last daily regime of its type that was known by then."""
    rows = panels.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    known = _daily_regimes(spark, sf_dir)
    joined = asof.asof_join(rows, known, TICKS.measured(rows))
    return joined.select("event_id", F.to_date("known_time").alias("known_day"), "regime")


@query
def ticks_asof_next_purchase(spark, sf_dir):
    """Each event with the next one of its user that is a purchase, within two days."""
    rows = panels.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    bought = panels.table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy("user_id", "ts").agg(
        F.max("event_id").alias("purchase")
    )
    axis = Axis(entity="user_id", time="ts")
    found = asof.asof_join(
        rows, bought.withColumnRenamed("ts", "bought_at"), axis, "bought_at", "forward", exact=False,
        within=datetime.timedelta(days=2),
    )
    return found.select("event_id", "purchase")


@query
def calendar_features(spark, sf_dir):
    """Averages and z-scores of supplier bars over calendar days; most days are missing."""
    return calendar.calendar_features(panels.ship_bars(spark, sf_dir), DAILY)


@query
def ticks_calendar_statistics(spark, sf_dir):
    """Cents of an event type over the last six hours and the last day, cut into blocks by time."""
    cents = F.round(F.col("value") * 100).alias("value")
    rows = panels.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", cents)
    spans = {"6h": datetime.timedelta(hours=6), "24h": datetime.timedelta(hours=24)}
    found = calendar.span_statistics(rows, TICKS.measured(rows), "value", spans, "value")
    return found.drop("event_type", "ts", "value")


@query
def overlapping_runs(spark, sf_dir):
    """Runs of the same regime of the lead symbol and of others that share a day."""
    rows = transitions.with_run_ids(labels_of(spark, sf_dir), DAILY)
    spans = rows.groupBy("symbol", "regime", "regime_group_id").agg(
        F.min("Date").alias("first_day"), F.max("Date").alias("last_day")
    )
    lead, others = spans.where(F.col("symbol") == LEAD), spans.where(F.col("symbol") != LEAD)
    pairs = intervals.overlap_join(lead, others, "first_day", "last_day", ["regime"])
    return pairs.select(
        "a.regime", F.col("a.regime_group_id").alias("lead_run"), F.col("b.symbol").alias("symbol"),
        F.col("b.regime_group_id").alias("run"),
        F.greatest("a.first_day", "b.first_day").alias("from_day"), F.least("a.last_day", "b.last_day").alias("to_day"),
    )


@query
def global_value_ranks(spark, sf_dir):
    """Rank of every event's value among all events."""
    rows = panels.table(spark, sf_dir, "events").select("event_id", "value")
    return ranking.global_ranks(rows, "value").drop("value")


@query
def global_value_tiles(spark, sf_dir):
    """Place of every line item by quantity, which only fifty values share out, and its percentile."""
    rows = panels.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), "l_quantity"
    )
    return ranking.global_positions(rows, "l_quantity", "line", tiles=100).drop("l_quantity")


@query
def score_area_by_ranks(spark, sf_dir):
    return ranking.roc_area(rule_scores(spark, sf_dir), "proba1")


def _streamed(spark, sf_dir, of) -> DataFrame:
    """What a stream over the events, a file for each ten days, has written when it has read all."""
    base = scratch_path(spark, "stream")
    rows = panels.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "user_id", _tick_regime())
    # Files are read in the order they were written.
    for low, high in ((1, 10), (11, 20), (21, 31)):
        part = rows.where(F.dayofmonth("ts").between(low, high))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    before = {k: spark.conf.get(k, None) for k in streamed_runs.STATE_STORE}
    for k, v in streamed_runs.STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        windows.bring_in(of(feed), f"{base}/out", f"{base}/checkpoint")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(f"{base}/out")


def _tick_regime() -> Column:
    return F.when(F.col("value") < 20, REGIMES[0]).otherwise(REGIMES[1]).alias("regime")


@query
def ticks_streamed_run_ids(spark, sf_dir):
    """Run ids of event types from a stream of three micro-batches."""
    found = _streamed(spark, sf_dir, lambda feed: streamed_runs.stream_run_ids(feed, "event_type", "ts"))
    return found.select("event_id", "regime_prev", "is_transition", "regime_group_id", "late")


@query
def ticks_streamed_breadth(spark, sf_dir):
    """Users per day and regime from a stream; the windows that the watermark has passed."""
    found = _streamed(
        spark, sf_dir, lambda feed: windows.breadth_per_window(feed, "1 day", None, "1 hour", "user_id", "ts")
    )
    return found.select(F.to_date("window_start").alias("day"), "regime", "entities", "rows")


@query
def ticks_grouping_sets(spark, sf_dir):
    """Cents by event type, regime and month, and by coarser groups merged from the same states."""
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    month = F.to_date(F.date_trunc("month", "ts")).alias("month")
    rows = panels.table(spark, sf_dir, "events").select("event_type", _tick_regime(), month, cents, "user_id")
    keys = ["event_type", "regime", "month"]
    states = rollups.summary_states(rows, keys, "cents", "user_id")
    found = rollups.summaries(states, keys, [keys, keys[:2], keys[1:], []])
    return found.drop("median", "entities")


@query
def weekly_users_from_daily(spark, sf_dir):
    """Distinct users by week and regime, from bitmaps of each day."""
    rows = panels.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), _tick_regime(), "user_id")
    states = rollups.distinct_states(rows, ["day", "regime"], "user_id")
    weekly = states.withColumn("week", F.to_date(F.date_trunc("week", "day")))
    return rollups.merged_distinct(weekly, ["week", "regime"])


@query
def event_props(spark, sf_dir):
    """Properties of events as typed columns; some are made odd, and rows that are not JSON stay apart."""
    odd = F.expr("""CASE WHEN event_id % 97 = 0 THEN substr(props, 1, length(props) - 1)
        WHEN event_id % 89 = 1 THEN '{"k": "many"}'
        WHEN event_id % 83 = 2 THEN concat('{"k": 5, "seen_', event_id, '": true}') ELSE props END""")
    rows = panels.table(spark, sf_dir, "events").select("event_id", odd.alias("props"))
    good, bad = json_columns.shredded(rows, "props", json_columns.fields_of(rows, "props"))
    apart = bad.select("event_id", F.col("props").alias("malformed"))
    return good.drop("props").unionByName(apart, allowMissingColumns=True)


@query
def trades_without_listed_days(spark, sf_dir):
    """Trades of suppliers but on days that are listed for them: those with a large return."""
    symbol = F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol")
    day = [symbol, F.to_date("l_shipdate").alias("Date")]
    lines = panels.table(spark, sf_dir, "lineitem")
    listed = lines.where("l_returnflag = 'R' AND l_quantity >= 25").select(*day)
    trades = lines.select("l_orderkey", "l_linenumber", *day)
    return exclusion.without_keys(trades, listed, ["symbol", "Date"])


@query
def ticks_of_listed_users(spark, sf_dir):
    """Events of users that are customers in debt."""
    listed = panels.table(spark, sf_dir, "customer").where("c_acctbal < 0")
    rows = panels.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return exclusion.with_keys(rows, listed.select(F.col("c_custkey").alias("user_id")), ["user_id"])

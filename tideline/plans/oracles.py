"""The named queries in plain SQL, written from their definitions."""

from __future__ import annotations

from tideline.settings import BREADTH_COLUMNS, FEATURES, REGIMES, THRESHOLDS

DIGITS = 6
SQL: dict[str, str] = {}


def r(expression: str, name: str | None = None) -> str:
    """Rounded column; adding zero turns a negative zero into a positive one."""
    unit = f"CAST(1e{DIGITS} AS DOUBLE)"
    return f"round_even(({expression}) * {unit}, 0) / {unit} + 0.0 AS {name or expression}"


def rounded(*names: str) -> str:
    return ", ".join(r(n) for n in names)


BARS = """
bars AS (
  SELECT CAST(l_shipdate AS DATE) AS "Date", 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
         max(round_even(round(l_extendedprice * 100) / l_quantity, 0)) AS "High",
         min(round_even(round(l_extendedprice * 100) / l_quantity, 0)) AS "Low",
         round_even(sum(round(l_extendedprice * 100)) / sum(l_quantity), 0) AS "Close",
         sum(l_quantity) AS "Volume"
  FROM lineitem GROUP BY 1, 2
)"""

ORDER_BARS = """
bars AS (
  SELECT CAST(o_orderdate AS DATE) AS "Date", o_orderpriority AS symbol,
         max(round(o_totalprice * 100)) AS "High", min(round(o_totalprice * 100)) AS "Low",
         round_even(sum(round(o_totalprice * 100)) / count(*), 0) AS "Close",
         CAST(count(*) AS DOUBLE) AS "Volume"
  FROM orders GROUP BY 1, 2
)"""

BAR_COLUMNS = (
    '"Date", symbol, ' + r('("High" + "Low") / 2', '"Open"') + ", "
    + ", ".join(r(f'"{c}"') for c in ("High", "Low", "Close", "Volume"))
    + ", " + r('"Close" * "Volume"', '"Marketcap"')
)

FEATURE_STEPS = """
priced AS (
  SELECT *, lag(px) OVER w AS px_before, CAST(row_number() OVER w AS INTEGER) AS rn,
         avg(px) OVER (PARTITION BY ent ORDER BY tm ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_close_7,
         avg(px) OVER (PARTITION BY ent ORDER BY tm ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma_close_30
  FROM keyed WINDOW w AS (PARTITION BY ent ORDER BY tm)
),
returned AS (
  SELECT *, {ret} AS ret_1d, px / nullif(px_before, 0) - 1 AS ret_pct FROM priced
),
ranked AS (
  SELECT ent, ret_1d, row_number() OVER (PARTITION BY ent ORDER BY ret_1d) AS place,
         count(*) OVER (PARTITION BY ent) AS n
  FROM returned WHERE ret_1d IS NOT NULL
),
bounds AS (
  SELECT ent, min(ret_1d) FILTER (WHERE place >= ceil(CAST(0.025 AS DOUBLE) * n)) AS q_lo,
         min(ret_1d) FILTER (WHERE place >= ceil(CAST(0.975 AS DOUBLE) * n)) AS q_hi
  FROM ranked GROUP BY ent
),
clamped AS (
  SELECT returned.*, q_lo, q_hi,
         CASE WHEN ret_1d < q_lo THEN q_lo WHEN ret_1d > q_hi THEN q_hi ELSE ret_1d END AS ret_1d_w
  FROM returned LEFT JOIN bounds USING (ent)
),
rolled AS (
  SELECT *, avg(ret_1d_w) OVER s AS ret_mean_7, stddev_samp(ret_1d_w) OVER s AS ret_std_7,
         count(ret_1d_w) OVER s AS cnt_7, avg(ret_1d_w) OVER l AS ret_mean_30,
         stddev_samp(ret_1d_w) OVER l AS ret_std_30, count(ret_1d_w) OVER l AS cnt_30
  FROM clamped
  WINDOW s AS (PARTITION BY ent ORDER BY tm ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         l AS (PARTITION BY ent ORDER BY tm ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
),
feats AS (
  SELECT *,
         CASE WHEN cnt_7 >= 5 AND ret_std_7 >= 0.0001 AND rn >= 14
              THEN (ret_1d_w - ret_mean_7) / ret_std_7 END AS zscore_7,
         CASE WHEN cnt_30 >= 10 AND ret_std_30 >= 0.0001 AND rn >= 14
              THEN (ret_1d_w - ret_mean_30) / ret_std_30 END AS zscore_30,
         px / nullif(ma_close_7, 0) - 1 AS ma_gap_7, px / nullif(ma_close_30, 0) - 1 AS ma_gap_30
  FROM rolled
)"""
LOG_RETURN = "CASE WHEN px > 0 AND px_before > 0 THEN ln(px) - ln(px_before) END"
SIMPLE_RETURN = "px / nullif(px_before, 0) - 1"
KEYED = 'keyed AS (SELECT *, symbol AS ent, "Date" AS tm, "Close" AS px FROM bars)'
KEYED_TICKS = "keyed AS (SELECT event_type, ts, value, event_type AS ent, ts AS tm, value AS px FROM events)"


def features_cte(source: str = BARS + ",\n" + KEYED, ret: str = LOG_RETURN) -> str:
    return "WITH " + source + "," + FEATURE_STEPS.format(ret=ret)


DERIVED_COLUMNS = (
    rounded("ma_close_7", "ma_close_30", "ret_1d", "ret_pct", "q_lo", "q_hi", "ret_1d_w",
            "ret_mean_7", "ret_std_7", "ret_mean_30", "ret_std_30", "zscore_7", "zscore_30",
            "ma_gap_7", "ma_gap_30")
    + ", cnt_7, cnt_30, rn"
)

FEATS = features_cte()
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
MODEL = FEATS + f""",
ml AS (SELECT "Date", symbol, {", ".join(FEATURES)} FROM feats WHERE {COMPLETE})"""
CASES = " ".join(
    f"WHEN {c} THEN '{name}'"
    for c, name in ((0, REGIMES[3]), (1, REGIMES[0]), (2, REGIMES[2]), (3, REGIMES[1]), (4, REGIMES[4]))
)
LABELS = MODEL + f""",
clustered AS (
  SELECT *, CASE WHEN zscore_7 >= 1.25 AND ma_gap_30 > 0 THEN 0 WHEN zscore_7 <= -1.25 THEN 2
                 WHEN ma_gap_7 >= 0.6 THEN 4 WHEN ret_std_30 <= 1.6 THEN 1 ELSE 3 END AS cluster
  FROM ml
),
joined AS (SELECT *, CASE cluster {CASES} END AS regime FROM clustered)"""
CHANGED = "regime_prev IS NOT NULL AND regime_prev <> regime"
NAMED = "concat_ws(' → ', regime_prev, regime)"
NEXT = LABELS + f""",
near AS (
  SELECT "Date", symbol, cluster, regime,
         lead(regime) OVER w AS regime_next, lag(regime) OVER w AS regime_prev
  FROM joined WINDOW w AS (PARTITION BY symbol ORDER BY "Date")
),
flagged AS (SELECT *, {CHANGED} AS is_transition, {NAMED} AS transition FROM near),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN is_transition THEN 1 ELSE 0 END)
                 OVER (PARTITION BY symbol ORDER BY "Date" ROWS UNBOUNDED PRECEDING) AS BIGINT) AS regime_group_id
  FROM flagged
),
runs AS (
  SELECT symbol, regime, regime_group_id, count(*) AS run_len FROM numbered GROUP BY ALL
),
counts AS (
  SELECT regime, regime_next, count(*) AS "count" FROM flagged
  WHERE regime_prev IS NOT NULL GROUP BY ALL
),
totals AS (SELECT regime, CAST(sum("count") AS BIGINT) AS row_count FROM counts GROUP BY regime),
probs AS (
  SELECT regime, regime_next, "count", row_count, "count" / CAST(row_count AS DOUBLE) AS prob
  FROM counts JOIN totals USING (regime)
)"""
FORWARD = LABELS + f""",
ahead AS (
  SELECT *, lead(ret_1d_w) OVER (PARTITION BY symbol ORDER BY "Date") AS ret_fwd1 FROM joined
),
paired AS (
  SELECT *, lag(regime) OVER (PARTITION BY symbol ORDER BY "Date") AS regime_prev
  FROM ahead WHERE ret_fwd1 IS NOT NULL
),
fwd AS (
  SELECT *, regime_prev IS NOT NULL AS has_prev, {CHANGED} AS is_transition, {NAMED} AS transition
  FROM paired
)"""


def sql(name: str, with_: str, body: str) -> None:
    SQL[name] = f"{with_}\n{body}"


def percentile(source: str, by: str, value: str, probs: dict[str, float]) -> str:
    """Subquery: smallest value whose place in its group reaches the share asked for."""
    picks = ", ".join(
        f"min(v) FILTER (WHERE place >= ceil(CAST({p} AS DOUBLE) * n)) AS {name}"
        for name, p in probs.items()
    )
    over = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return (
        f"(SELECT {keys}{picks} FROM (SELECT {keys}{value} AS v, "
        f"row_number() OVER ({over} ORDER BY {value}) AS place, count(*) OVER ({over}) AS n "
        f"FROM {source} WHERE {value} IS NOT NULL) {'GROUP BY ' + by if by else ''})"
    )


# --- sources, cleaning --------------------------------------------------------------------

CLEAN = """
SELECT CAST(l_shipdate AS DATE) AS "Date", 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       {money} AS "Open", {money} AS "High",
       CASE WHEN l_quantity = 15 THEN NULL ELSE {money} END AS "Low", {money} AS "Close",
       l_quantity AS "Volume", -1 * {money} AS "Marketcap"
FROM lineitem
WHERE l_discount <> 0.05 AND l_quantity NOT IN (13, 14) AND l_suppkey NOT IN (7, 8) AND {kept}
"""
MONEY = "round(l_extendedprice, 2)"
SQL["clean_bars"] = CLEAN.format(money=MONEY, kept="NOT (l_linenumber = 1 AND l_tax = 0.0)")
SQL["csv_ingest"] = CLEAN.format(money=MONEY, kept="l_linenumber <> 1")
SQL["csv_files_seen"] = "SELECT 'csv' AS kind, count(*) AS rows FROM lineitem"
sql("panel_roundtrip", "WITH " + BARS, f"SELECT {BAR_COLUMNS} FROM bars")
sql(
    "panel_roundtrip_numeric_symbols",
    "WITH " + BARS,
    f"""SELECT * REPLACE (CASE WHEN day("Date") % 2 = 0 THEN lpad(substr(symbol, 2), 5, '0')
      ELSE substr(symbol, 2) END AS symbol) FROM (SELECT {BAR_COLUMNS} FROM bars)""",
)
SUMMARY = """SELECT count(*) AS rows, count(DISTINCT symbol) AS symbols, min("Date") AS min_date,
max("Date") AS max_date FROM bars"""
sql("dataset_summary", "WITH " + BARS, SUMMARY)
sql("summary_json_roundtrip", "WITH " + BARS, SUMMARY)
sql("distinct_symbols", "WITH " + BARS, "SELECT DISTINCT symbol FROM bars")
sql(
    "result_roundtrip",
    LABELS,
    """SELECT form, regime, count(*) AS "count"
    FROM joined CROSS JOIN (VALUES ('parquet'), ('csv')) AS forms(form) GROUP BY ALL""",
)
sql(
    "feature_retention",
    FEATS,
    f"SELECT count(*) AS rows_before, count(*) FILTER (WHERE {COMPLETE}) AS rows_after, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}" for c in FEATURES)
    + ", "
    + r(f"count(*) FILTER (WHERE {COMPLETE}) / CAST(count(*) AS DOUBLE)", "retained")
    + " FROM feats",
)
FOUR = ("ret_1d_w", "ret_std_7", "ret_std_30", "ma_gap_30")
sql(
    "optional_columns",
    LABELS,
    f'SELECT "Date", symbol, cluster, regime, {rounded(*FOUR)} FROM joined',
)

# --- features -----------------------------------------------------------------------------

sql("features_full", FEATS, f"SELECT {BAR_COLUMNS}, {DERIVED_COLUMNS} FROM feats")
sql("features_model", MODEL, f'SELECT "Date", symbol, {rounded(*FEATURES)} FROM ml')
sql(
    "features_orders",
    features_cte(ORDER_BARS + ",\n" + KEYED),
    f"SELECT {BAR_COLUMNS}, {DERIVED_COLUMNS} FROM feats",
)
sql(
    "features_simple_returns",
    features_cte(ret=SIMPLE_RETURN),
    f'SELECT "Date", symbol, {rounded("ret_1d", "ret_pct", "ret_1d_w")} FROM feats',
)
MOMENT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
sql(
    "ticks_features",
    features_cte(KEYED_TICKS),
    f"SELECT event_type, {MOMENT}, {r('value')}, {DERIVED_COLUMNS} FROM feats",
)

# --- diagnostics --------------------------------------------------------------------------

sql(
    "feature_percentiles",
    MODEL + ", long AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS v0 FROM ml" for c in FEATURES
    ) + ")",
    f"SELECT feature, {rounded('p01', 'p50', 'p99')} FROM "
    + percentile("long", "feature", "v0", {"p01": 0.01, "p50": 0.5, "p99": 0.99}),
)
sql(
    "anomaly_counts",
    FEATS,
    """SELECT symbol, count(*) FILTER (WHERE abs(zscore_7) >= 3) AS anom_7_count
    FROM feats GROUP BY symbol""",
)


def signed(limit: float) -> str:
    return (
        f"count(*) FILTER (WHERE zscore_7 >= {limit}) AS up_3p, "
        f"count(*) FILTER (WHERE zscore_7 <= -{limit}) AS dn_3p"
    )


sql("anomaly_counts_by_symbol", MODEL, f"SELECT symbol, {signed(3)} FROM ml GROUP BY symbol")
sql("anomaly_counts_by_date", MODEL, f'SELECT "Date", {signed(3)} FROM ml GROUP BY "Date"')
sql(
    "event_day",
    MODEL,
    f"""SELECT "Date", {signed(1)} FROM ml WHERE "Date" = DATE '1998-03-12' GROUP BY "Date" """,
)
sql(
    "widespread_down_days",
    MODEL,
    f'SELECT * FROM (SELECT "Date", {signed(1.5)} FROM ml GROUP BY "Date") WHERE dn_3p >= 5',
)
sql(
    "volatility_summary",
    MODEL,
    f"SELECT symbol, {rounded('vol30_med', 'vol30_max')} FROM "
    + percentile("ml", "symbol", "ret_std_30", {"vol30_med": 0.5})
    + " JOIN (SELECT symbol, max(ret_std_30) AS vol30_max FROM ml GROUP BY symbol) USING (symbol)",
)
for _name, _way in (("top_moves_up", "DESC"), ("top_moves_down", "ASC")):
    sql(
        _name,
        FEATS,
        f"""SELECT symbol, "Date", {rounded('ret_pct', 'zscore_7')} FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ret_pct {_way}, "Date") AS place
          FROM feats WHERE ret_pct IS NOT NULL) WHERE place <= 5""",
    )
_TOP = ("ret_1d", "ret_1d_w", "ret_mean_7", "ret_std_7", "zscore_7")
sql(
    "top_zscores",
    FEATS,
    f"""SELECT "Date", symbol, {r('"Close"')}, {rounded(*_TOP)} FROM (
      SELECT * FROM feats WHERE zscore_7 IS NOT NULL
      ORDER BY abs(zscore_7) DESC, symbol, "Date" LIMIT 10)""",
)
sql(
    "volatility_head",
    FEATS,
    f"""SELECT "Date", symbol, {r('ret_std_30')} FROM (
      SELECT * FROM feats WHERE symbol = 'S1' ORDER BY "Date" LIMIT 20)""",
)
sql(
    "volatility_series",
    MODEL,
    f"""SELECT "Date", symbol, {r('ret_std_30')} FROM ml WHERE symbol = 'S1'""",
)

# --- labels, transitions, runs ------------------------------------------------------------

sql("rule_labels", LABELS, 'SELECT "Date", symbol, cluster, regime FROM joined')
sql(
    "labels_with_features",
    LABELS,
    f'SELECT "Date", symbol, cluster, regime, {rounded(*FEATURES)} FROM joined',
)
sql("regime_counts", LABELS, 'SELECT regime, count(*) AS "count" FROM joined GROUP BY regime')
sql(
    "regime_counts_by_symbol",
    LABELS,
    'SELECT symbol, regime, count(*) AS "count" FROM joined GROUP BY ALL',
)
sql(
    "regime_counts_on_date",
    LABELS,
    """SELECT regime, count(*) AS "count" FROM joined WHERE "Date" = DATE '1998-03-12' GROUP BY ALL""",
)
sql(
    "top_regimes_by_symbol",
    LABELS,
    """SELECT symbol, regime, "count" FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "count" DESC, regime) AS place
      FROM (SELECT symbol, regime, count(*) AS "count" FROM joined GROUP BY ALL)) WHERE place <= 3""",
)
sql("neighbours", NEXT, "SELECT * FROM flagged")
sql("transition_counts", NEXT, "SELECT * FROM counts")
sql(
    "transition_counts_strict",
    NEXT,
    """SELECT regime, regime_next, count(*) AS "count" FROM flagged
    WHERE regime_next IS NOT NULL GROUP BY ALL""",
)
PROBS = f'SELECT regime, regime_next, "count", row_count, {r("prob")} FROM probs'
sql("transition_probabilities", NEXT, PROBS)


def matrix(table: str, value: str, kind: str) -> str:
    cells = ", ".join(
        f"coalesce(max({value}) FILTER (WHERE regime_next = '{g}'), 0)::{kind} AS \"{g}\""
        for g in REGIMES
    )
    return f"(SELECT regime, {cells} FROM {table} GROUP BY regime)"


CELLS = ", ".join(r(f'"{g}"') for g in REGIMES)
sql("matrix_counts", NEXT, "SELECT * FROM " + matrix("counts", '"count"', "BIGINT"))
sql("matrix_probabilities", NEXT, f"SELECT regime, {CELLS} FROM " + matrix("probs", "prob", "DOUBLE"))
sql(
    "matrix_row_sums",
    NEXT,
    f"SELECT regime, {r('sum(prob)', 'row_sum')} FROM probs WHERE regime_next IS NOT NULL GROUP BY regime",
)
_DENSE = ", ".join(r(f'coalesce("{g}", 0)', f'"{g}"') for g in REGIMES)
LISTED = ", ".join(f"('{g}')" for g in (*REGIMES, "Unknown"))
sql(
    "matrix_dense",
    NEXT,
    f"""SELECT regime, {_DENSE}, CAST(0 AS DOUBLE) AS "Unknown" FROM (VALUES {LISTED}) AS listed(regime)
    LEFT JOIN (SELECT * FROM """ + matrix("probs", "prob", "DOUBLE") + ") USING (regime)",
)
sql(
    "stay_probabilities",
    NEXT,
    f"SELECT regime, {r('prob', 'stay_prob')} FROM probs WHERE regime = regime_next",
)
sql("run_ids", NEXT, "SELECT * FROM numbered")
sql("run_lengths", NEXT, "SELECT * FROM runs")


def dwell(by: str, low: bool) -> str:
    least = "min(run_len) AS min_len, " if low else ""
    return (
        f"SELECT {by}, num_runs, {r('mean_len')}, p50_len, p90_len, "
        f"{'min_len, ' if low else ''}max_len FROM (SELECT {by}, count(*) AS num_runs, "
        f"avg(run_len) AS mean_len, {least}max(run_len) AS max_len FROM runs GROUP BY {by}) JOIN "
        + percentile("runs", by, "run_len", {"p50_len": 0.5, "p90_len": 0.9})
        + f" USING ({by})"
    )


sql("dwell_overall", NEXT, dwell("regime", True))
sql("dwell_by_symbol", NEXT, dwell("symbol, regime", False))
sql("dwell_conservation", NEXT, "SELECT count(*) AS total_run_len FROM joined")
sql(
    "dwell_in_label_order",
    NEXT,
    f"""SELECT regime, num_runs, mean_len, p50_len, p90_len, min_len, max_len
    FROM (VALUES {LISTED}) AS listed(regime) LEFT JOIN (
      SELECT * FROM ({dwell("regime", True)})) USING (regime)""",
)
TICK_LABELS = f"""WITH labelled AS (
  SELECT event_type, ts, value, CASE WHEN value < 20 THEN '{REGIMES[0]}'
    WHEN value < 60 THEN '{REGIMES[1]}' ELSE '{REGIMES[2]}' END AS regime FROM events
),
near AS (
  SELECT *, lead(regime) OVER w AS regime_next, lag(regime) OVER w AS regime_prev,
         lead(value) OVER w AS ret_fwd1
  FROM labelled WINDOW w AS (PARTITION BY event_type ORDER BY ts)
),
flagged AS (SELECT *, {CHANGED} AS is_transition, {NAMED} AS transition FROM near),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN is_transition THEN 1 ELSE 0 END)
                 OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS regime_group_id
  FROM flagged
),
fwd AS (SELECT * FROM flagged WHERE ret_fwd1 IS NOT NULL AND regime_prev IS NOT NULL)"""
sql(
    "ticks_run_ids",
    TICK_LABELS,
    f"SELECT * EXCLUDE (ts, ret_fwd1, value), {MOMENT}, {r('value')} FROM numbered",
)
sql(
    "ticks_run_lengths",
    TICK_LABELS,
    "SELECT event_type, regime, regime_group_id, count(*) AS run_len FROM numbered GROUP BY ALL",
)
sql(
    "ticks_transition_counts",
    TICK_LABELS,
    """SELECT regime, regime_next, count(*) AS "count" FROM flagged
    WHERE regime_prev IS NOT NULL GROUP BY ALL""",
)
sql(
    "ticks_null_returns",
    f"""WITH held AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS ret,
      CASE WHEN value < 20 THEN '{REGIMES[0]}' WHEN value < 60 THEN '{REGIMES[1]}'
           ELSE '{REGIMES[2]}' END AS regime FROM events),
    ahead AS (SELECT *, lead(ret) OVER (PARTITION BY event_type ORDER BY ts) AS ret_fwd1 FROM held),
    paired AS (SELECT *, lag(regime) OVER (PARTITION BY event_type ORDER BY ts) AS regime_prev
               FROM ahead WHERE ret_fwd1 IS NOT NULL)""",
    f"""SELECT event_id, regime, regime_prev, {r('ret_fwd1')}, regime_prev IS NOT NULL AS has_prev,
    {CHANGED} AS is_transition FROM paired""",
)
sql(
    "ticks_null_times",
    f"""WITH known AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, ts,
      CASE WHEN value < 20 THEN '{REGIMES[0]}' ELSE '{REGIMES[1]}' END AS regime FROM events),
    held AS (SELECT * REPLACE (CASE WHEN event_id <> min(event_id) OVER (PARTITION BY kind) THEN ts END AS ts)
             FROM known),
    near AS (SELECT *, lead(regime) OVER w AS regime_next, lag(regime) OVER w AS regime_prev
             FROM held WINDOW w AS (PARTITION BY kind ORDER BY ts NULLS FIRST)),
    flagged AS (SELECT *, {CHANGED} AS is_transition FROM near)""",
    """SELECT event_id, regime, regime_next, regime_prev,
    CAST(sum(CASE WHEN is_transition THEN 1 ELSE 0 END) OVER (
      PARTITION BY kind ORDER BY ts NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS regime_group_id
    FROM flagged""",
)
sql(
    "ticks_rolling_correlation",
    """WITH pts AS (SELECT event_id, ts, value AS x,
      CASE WHEN event_id % 101 <> 0 THEN CAST(user_id AS DOUBLE) END AS y FROM events),
    rolled AS (
      SELECT event_id, count(y) OVER f AS n, covar_samp(x, y) OVER f AS c,
             stddev_samp(x) OVER f AS sx, stddev_samp(y) OVER f AS sy
      FROM pts WINDOW f AS (ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
    f"SELECT event_id, {r('CASE WHEN n = 30 THEN c / nullif(sx * sy, 0) END', 'corr30')} FROM rolled",
)

# --- returns ------------------------------------------------------------------------------


def stats(source: str, value: str, by: str, suffix: str = "") -> str:
    names = [f"{n}{suffix}" for n in ("mean_ret", "median_ret", "std_ret", "hit_rate", "sharpe_d")]
    mean, median, std, hit, sharpe = names
    return (
        f"SELECT {by}, n, {rounded(mean, median, std, hit)}, "
        f"{r(f'CASE WHEN {std} > 0 THEN {mean} / {std} END', sharpe)} FROM ("
        f"SELECT {by}, count(*) AS n, avg({value}) AS {mean}, stddev_samp({value}) AS {std}, "
        f"avg(CASE WHEN {value} > 0 THEN 1.0 ELSE 0.0 END) AS {hit} FROM {source} GROUP BY {by}) "
        f"JOIN " + percentile(source, by, value, {median: 0.5}) + f" USING ({by})"
    )


sql("returns_overall", LABELS, stats("joined", "ret_1d_w", "regime"))
sql("returns_by_symbol", LABELS, stats("joined", "ret_1d_w", "symbol, regime"))
sql(
    "forward_rows",
    FORWARD,
    f"""SELECT "Date", symbol, regime, {r('ret_fwd1')}, regime_prev, has_prev, is_transition,
    transition FROM fwd""",
)
CHANGES = FORWARD + ",\nchanges AS (SELECT * FROM fwd WHERE is_transition)"
WITH_PREV = FORWARD + ",\nwith_prev AS (SELECT * FROM fwd WHERE has_prev)"
sql("returns_fwd1_overall", FORWARD, stats("fwd", "ret_fwd1", "regime", "_fwd1"))
sql("returns_fwd1_by_symbol", FORWARD, stats("fwd", "ret_fwd1", "symbol, regime", "_fwd1"))
sql("transitions_fwd1_overall", CHANGES, stats("changes", "ret_fwd1", "transition", "_fwd1"))
sql(
    "transitions_fwd1_by_symbol",
    CHANGES,
    stats("changes", "ret_fwd1", "symbol, transition", "_fwd1"),
)
sql(
    "transitions_fwd1_stay_vs_change",
    WITH_PREV,
    stats("with_prev", "ret_fwd1", "is_transition", "_fwd1"),
)
sql(
    "change_tallies",
    FORWARD,
    """SELECT count(*) FILTER (WHERE has_prev) AS rows_with_prev,
    count(*) FILTER (WHERE is_transition) AS transitions,
    count(*) FILTER (WHERE has_prev AND NOT is_transition) AS stays FROM fwd""",
)
sql(
    "change_counts",
    CHANGES,
    'SELECT transition, count(*) AS "count" FROM changes GROUP BY transition',
)
sql(
    "top_changes",
    CHANGES,
    f"""SELECT * FROM ({stats("changes", "ret_fwd1", "transition", "_fwd1")})
    ORDER BY abs(mean_ret_fwd1) DESC, transition LIMIT 8""",
)
sql(
    "returns_in_label_order",
    LABELS,
    f"""SELECT regime, n, mean_ret, median_ret, std_ret, hit_rate, sharpe_d
    FROM (VALUES {LISTED}) AS listed(regime) LEFT JOIN (
      SELECT * FROM ({stats("joined", "ret_1d_w", "regime")}))
    USING (regime)""",
)
sql("ticks_forward_returns", TICK_LABELS, stats("fwd", "ret_fwd1", "regime", "_fwd1"))

# --- breadth ------------------------------------------------------------------------------

DAILY = LABELS + """,
daily AS (
  SELECT "Date", {counted}, count(DISTINCT symbol) AS total_syms FROM joined GROUP BY "Date"
),
shares AS (SELECT *, {shares} FROM daily),
lead_rows AS (
  SELECT "Date", lead(ret_1d_w) OVER (ORDER BY "Date") AS lead_fwd1 FROM joined WHERE symbol = 'S1'
),
kept AS (SELECT * FROM shares JOIN lead_rows USING ("Date")),
both_set AS (SELECT * FROM kept WHERE lead_fwd1 IS NOT NULL)""".format(
    counted=", ".join(
        f"count(DISTINCT symbol) FILTER (WHERE regime = '{g}') AS \"{g}\"" for g in REGIMES
    ),
    shares=", ".join(f'"{g}" / CAST(total_syms AS DOUBLE) AS {s}' for g, s in BREADTH_COLUMNS.items()),
)
SHARES = sorted(BREADTH_COLUMNS.values())
sql(
    "breadth_daily",
    DAILY,
    'SELECT "Date", total_syms, ' + ", ".join(f'"{g}"' for g in REGIMES)
    + f", {rounded(*SHARES)} FROM shares",
)
sql(
    "breadth_with_lead",
    DAILY,
    f'SELECT "Date", total_syms, {rounded("frac_bull", "lead_fwd1")} FROM both_set',
)
ADDED = " + ".join(f'"{g}"' for g in REGIMES)
sql(
    "breadth_conservation",
    DAILY,
    f"SELECT count(*) AS dates, count(*) FILTER (WHERE {ADDED} <> total_syms) AS bad_dates FROM shares",
)
sql(
    "breadth_lead_correlations",
    DAILY,
    " UNION ALL ".join(
        f"SELECT '{s}' AS share, {r(f'corr({s}, lead_fwd1)', 'corr')} FROM both_set" for s in SHARES
    ),
)
sql(
    "breadth_rolling_correlation",
    DAILY + """, framed AS (
      SELECT "Date", frac_bull, lead_fwd1, count(lead_fwd1) OVER f AS n,
             covar_samp(frac_bull, lead_fwd1) OVER f AS c,
             stddev_samp(frac_bull) OVER f AS sx, stddev_samp(lead_fwd1) OVER f AS sy
      FROM kept WINDOW f AS (ORDER BY "Date" ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
    f"""SELECT "Date", {rounded('frac_bull', 'lead_fwd1')},
    {r('CASE WHEN n = 30 THEN c / nullif(sx * sy, 0) END', 'corr30')} FROM framed""",
)
sql(
    "lead_forward_series",
    MODEL,
    f"""SELECT "Date", symbol, {r('lead(ret_1d_w) OVER (ORDER BY "Date")', 'ret_fwd1')}
    FROM ml WHERE symbol = 'S1'""",
)

# --- clusters -----------------------------------------------------------------------------

MEANS = ", ".join(f"avg({c}) AS avg_{c}" for c in FEATURES)
AVERAGES = [f"avg_{c}" for c in FEATURES]


def centroids(by: str) -> str:
    return (
        f"SELECT {by}, {rounded(*AVERAGES)}, n FROM "
        f"(SELECT {by}, {MEANS}, count(*) AS n FROM joined GROUP BY {by})"
    )


sql("cluster_centroids", LABELS, centroids("cluster"))
sql("regime_centroids", LABELS, centroids("regime"))
sql(
    "centroids_long",
    LABELS,
    " UNION ALL ".join(
        f"SELECT cluster, '{c}' AS feat, {r(f'avg({c})', 'value')} FROM joined GROUP BY cluster"
        for c in FEATURES
    ),
)
SCALED = ", ".join(
    r(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()", f"scaled_{c}") for c in FEATURES
)
sql("scaled_features", LABELS, f'SELECT "Date", symbol, {SCALED} FROM joined')
sql(
    "unscaled_centres",
    LABELS,
    "SELECT CAST(row_number() OVER (ORDER BY cluster) - 1 AS INTEGER) AS k, "
    + ", ".join(r(f"avg({c})", c) for c in FEATURES)
    + " FROM joined GROUP BY cluster",
)
CENTRES = LABELS + """,
c AS (SELECT cluster, avg(zscore_7) AS z, avg(ret_std_30) AS vol, avg(ma_gap_30) AS gap
      FROM joined {kept} GROUP BY cluster),
blow AS (SELECT cluster FROM c ORDER BY {hot} DESC, cluster LIMIT 1),
cold AS (SELECT cluster FROM c ORDER BY gap + 0.75 * z, cluster LIMIT 1),
sell AS (SELECT CASE WHEN (SELECT cluster FROM cold) = (SELECT cluster FROM blow)
                     THEN (SELECT cluster FROM c ORDER BY z, cluster LIMIT 1)
                     ELSE (SELECT cluster FROM cold) END AS cluster),
bull AS (SELECT cluster FROM c WHERE cluster NOT IN (SELECT cluster FROM blow)
         AND cluster NOT IN (SELECT cluster FROM sell) ORDER BY z + 0.5 * gap DESC, cluster LIMIT 1),
calm AS (SELECT cluster FROM c WHERE cluster NOT IN (SELECT cluster FROM blow)
         AND cluster NOT IN (SELECT cluster FROM sell) AND cluster NOT IN (SELECT cluster FROM bull)
         ORDER BY vol, cluster LIMIT 1)"""
CHOSEN = f"""SELECT cluster, CASE WHEN cluster IN (SELECT cluster FROM sell) THEN '{REGIMES[2]}'
  WHEN cluster IN (SELECT cluster FROM blow) THEN '{REGIMES[3]}'
  WHEN cluster IN (SELECT cluster FROM bull) THEN '{REGIMES[4]}'
  WHEN cluster IN (SELECT cluster FROM calm) THEN '{REGIMES[0]}'
  ELSE '{REGIMES[1]}' END AS regime FROM c"""
sql("regime_names", CENTRES.format(kept="", hot="gap + 0.75 * z"), CHOSEN)
THREE = CENTRES.replace("FROM joined {kept}", "FROM (SELECT * REPLACE (cluster % 3 AS cluster) FROM joined) {kept}")
sql("regime_names_three", THREE.format(kept="", hot="gap"), CHOSEN)
sql(
    "centroid_csv_roundtrip",
    LABELS,
    "SELECT cluster, CAST(count(*) AS INTEGER) AS n, "
    + ", ".join(r(f"avg({c})", f"avg_{c}") for c in FEATURES)
    + " FROM joined GROUP BY cluster",
)
# The laws of a fit: all rows are counted, and none breaks them.
sql(
    "kmeans_sweep_laws",
    MODEL,
    """SELECT k, n AS rows, CAST(0 AS BIGINT) AS strays, true AS silhouette_in_range
    FROM (VALUES (3), (4), (5), (6), (7), (8)) AS ks(k) CROSS JOIN (SELECT count(*) AS n FROM ml)""",
)
sql("kmeans_saved_laws", MODEL, "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS moved FROM ml")
sql("kmeans_unscaled_laws", MODEL, "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS strays FROM ml")
sql(
    "kmeans_label_laws",
    MODEL,
    """SELECT count(*) AS rows, CAST(5 AS BIGINT) AS clusters, CAST(5 AS BIGINT) AS pairs,
    CAST(0 AS BIGINT) AS unnamed FROM ml""",
)
DISTANCE = "sqrt(" + " + ".join(f"pow(j.{c} - m.avg_{c}, 2)" for c in FEATURES) + ")"
sql(
    "centre_silhouettes",
    LABELS + f""",
means AS (SELECT cluster, {MEANS} FROM joined GROUP BY cluster),
apart AS (SELECT j.symbol, j."Date", j.cluster, m.cluster AS other, {DISTANCE} AS d
          FROM joined j CROSS JOIN means m),
ab AS (SELECT symbol, "Date", cluster, max(d) FILTER (WHERE other = cluster) AS a,
              min(d) FILTER (WHERE other <> cluster) AS b FROM apart GROUP BY ALL)""",
    f"""SELECT cluster, count(*) AS n, {r('avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END)', 'mean_silhouette')}
    FROM ab GROUP BY cluster""",
)

# --- gauge --------------------------------------------------------------------------------

LABELLED = FORWARD + f""",
labelled AS (
  SELECT "Date", symbol, CASE WHEN ret_fwd1 > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
         {", ".join(FEATURES)},
         CAST('0x' || substr(md5(concat_ws('|', symbol, CAST("Date" AS VARCHAR))), 1, 8) AS BIGINT)
           % 10000 < 2000 AS is_test
  FROM fwd
)"""
sql("direction_labels", LABELLED, f'SELECT "Date", symbol, label, {rounded(*FEATURES)} FROM labelled')
sql(
    "split_random",
    LABELLED,
    """SELECT "Date", symbol, CASE WHEN is_test THEN 'test' ELSE 'train' END AS side FROM labelled""",
)
sql(
    "split_chronological",
    LABELLED + ", cut AS (SELECT * FROM "
    + percentile("labelled", "", '"Date"', {"cut_date": 0.8}) + ")",
    """SELECT CASE WHEN "Date" <= (SELECT cut_date FROM cut) THEN 'train' ELSE 'test' END AS side,
    count(*) AS n, min("Date") AS first, max("Date") AS last FROM labelled GROUP BY 1""",
)
sql(
    "split_on_date",
    LABELLED,
    """SELECT CASE WHEN "Date" <= DATE '1999-12-31' THEN 'train' ELSE 'test' END AS side,
    count(*) AS n FROM labelled GROUP BY 1""",
)
sql(
    "gauge_laws",
    LABELLED,
    "SELECT count(*) AS train_rows, true AS no_gradient, 6 AS weights FROM labelled WHERE NOT is_test",
)
sql(
    "strongest_weights",
    LABELS,
    f"""SELECT feature, {r('weight')} FROM (UNPIVOT (
      SELECT {", ".join(f"avg({c}) AS {c}" for c in FEATURES)} FROM joined)
      ON {", ".join(FEATURES)} INTO NAME feature VALUE weight)
    ORDER BY abs(weight) DESC, feature LIMIT 3""",
)
WEIGHTS = LABELLED + """,
share AS (SELECT avg(label) AS p FROM labelled WHERE NOT is_test)"""
sql(
    "class_weights",
    WEIGHTS,
    f"""SELECT {r('p', 'positive_share')}, {r('0.5 / p', 'w_pos')}, {r('0.5 / (1 - p)', 'w_neg')}
    FROM share""",
)
sql(
    "weighted_rows",
    WEIGHTS,
    f"""SELECT label, count(*) AS n, {r('max(CASE WHEN label = 1 THEN 0.5 / p ELSE 0.5 / (1 - p) END)', 'w')}
    FROM labelled CROSS JOIN share WHERE NOT is_test GROUP BY label""",
)
SCORED = LABELLED + f""",
scored AS (
  SELECT "Date", symbol, label, round_even(CAST(1e{DIGITS} AS DOUBLE) / (1 + exp(-(CAST(0.4 AS DOUBLE) * zscore_7
    - CAST(0.6 AS DOUBLE) * ret_1d_w + CAST(0.05 AS DOUBLE)))), 0) / CAST(1e{DIGITS} AS DOUBLE) AS proba1 FROM labelled
),
decided AS (
  SELECT *, CASE WHEN proba1 > CAST(0.5 AS DOUBLE) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
  FROM scored
)"""
sql("positive_probabilities", SCORED, 'SELECT "Date", symbol, proba1 FROM scored')
COUNTED = """count(*) FILTER (WHERE label = 1 AND {yes}) AS "TP",
  count(*) FILTER (WHERE label = 0 AND {yes}) AS "FP",
  count(*) FILTER (WHERE label = 0 AND NOT {yes}) AS "TN",
  count(*) FILTER (WHERE label = 1 AND NOT {yes}) AS "FN" """
RATES = """rates AS (
  SELECT *, CASE WHEN "TP" + "FP" > 0 THEN "TP" / CAST("TP" + "FP" AS DOUBLE) ELSE 0 END AS precision_,
         CASE WHEN "TP" + "FN" > 0 THEN "TP" / CAST("TP" + "FN" AS DOUBLE) ELSE 0 END AS recall_,
         ("TP" + "TN") / CAST("TP" + "FP" + "TN" + "FN" AS DOUBLE) AS accuracy_ FROM counted
),
measured AS (
  SELECT *, CASE WHEN precision_ + recall_ > 0 THEN 2 * precision_ * recall_ / (precision_ + recall_)
            ELSE 0 END AS f1_ FROM rates
)"""
MEASURES = (
    '"TP", "FP", "TN", "FN", ' + r("precision_", "precision") + ", " + r("recall_", "recall") + ", "
    + r("f1_", "f1") + ", " + r("accuracy_", "accuracy")
)
sql(
    "score_confusion",
    SCORED,
    'SELECT label, prediction, count(*) AS "count" FROM decided GROUP BY ALL',
)
sql(
    "score_point_metrics",
    SCORED + f", counted AS (SELECT {COUNTED.format(yes='prediction = 1')} FROM decided), {RATES}",
    f"SELECT {MEASURES} FROM measured",
)
SWEEP = (
    SCORED
    + ", counted AS (SELECT t AS threshold, "
    + COUNTED.format(yes="(proba1 >= t)")
    + " FROM scored CROSS JOIN (VALUES "
    + ", ".join(f"(CAST({t} AS DOUBLE))" for t in THRESHOLDS)
    + f") AS cuts(t) GROUP BY t), {RATES}, best AS "
    "(SELECT * FROM measured ORDER BY f1_ DESC, threshold LIMIT 1)"
)
sql("score_threshold_sweep", SWEEP, f"SELECT threshold, {MEASURES} FROM measured")
sql("score_best_threshold", SWEEP, f"SELECT threshold, {MEASURES} FROM best")
sql(
    "score_best_confusion",
    SWEEP,
    " UNION ALL ".join(
        f'SELECT {y} AS label, {p} AS prediction, "{c}" AS "count" FROM best'
        for y, p, c in ((0, 0, "TN"), (0, 1, "FP"), (1, 0, "FN"), (1, 1, "TP"))
    ),
)
sql("score_brier", SCORED, f"SELECT {r('avg(pow(proba1 - label, 2))', 'brier')} FROM scored")
sql(
    "score_quantiles",
    SCORED,
    f"SELECT {rounded('q10', 'q50', 'q90')} FROM "
    + percentile("scored", "", "proba1", {"q10": 0.1, "q50": 0.5, "q90": 0.9}),
)
sql(
    "score_baselines",
    SCORED + ", p AS (SELECT avg(label) AS p FROM scored)",
    f"""SELECT {r('p', 'test_positive_rate')}, {r('greatest(p, 1 - p)', 'acc_majority')},
    {r('2 * p / (1 + p)', 'f1_always_positive')}, CAST(0 AS DOUBLE) AS f1_always_negative,
    {r('2 * p / (1 + p)', 'f1_trivial_best')} FROM p""",
)
sql(
    "score_areas",
    SCORED + """,
cells AS (
  SELECT proba1, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY proba1
),
curve AS (
  SELECT proba1, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM cells WINDOW w AS (ORDER BY proba1 DESC ROWS UNBOUNDED PRECEDING)
),
points AS (
  SELECT proba1, tp / p AS recall, fp / n AS fpr, tp / (tp + fp) AS prec FROM curve
),
steps AS (
  SELECT *, lag(recall, 1, 0) OVER w AS recall0, lag(fpr, 1, 0) OVER w AS fpr0,
         lag(prec, 1, prec) OVER w AS prec0
  FROM points WINDOW w AS (ORDER BY proba1 DESC)
)""",
    f"""SELECT {r('sum((fpr - fpr0) * (recall + recall0) / 2)', 'roc_auc')},
    {r('sum((recall - recall0) * (prec + prec0) / 2)', 'pr_auc')} FROM steps""",
)

# --- replicated panels, benchmark runs ----------------------------------------------------

sql(
    "replicated_panel",
    "WITH " + BARS,
    f"""SELECT CASE WHEN i = 0 THEN symbol ELSE symbol || '_x' || CAST(i AS VARCHAR) END AS symbol,
    count(*) AS rows, {r('max("Close")', '"close"')}
    FROM bars CROSS JOIN range(5) AS copies(i) GROUP BY 1""",
)


def run_records(click: str = "B0") -> str:
    steps = ", ".join(
        f"CAST(sum(cents) FILTER (WHERE step = {s}) AS DOUBLE) / 100 AS step{s}_s" for s in range(1, 8)
    )
    return f"""WITH cents AS (
  SELECT CASE event_type WHEN 'click' THEN '{click}' WHEN 'view' THEN 'S1' WHEN 'purchase' THEN 'A1'
         WHEN 'signup' THEN 'J1' WHEN 'error' THEN 'Z9' END AS exp_id, user_id, event_id,
         event_id % 7 + 1 AS step, CAST(round(value * 100) AS BIGINT) AS cents FROM events
),
runs AS (
  SELECT exp_id, user_id, min(event_id) AS started, CAST(sum(cents) AS DOUBLE) / 100 AS wall_seconds,
         CAST(max(cents) AS DOUBLE) AS max_rss_bytes, CAST(min(cents) AS DOUBLE) / 100 AS mean_cpu_percent, {steps}
  FROM cents GROUP BY exp_id, user_id
)"""


STEPS = [f"step{s}_s" for s in range(1, 8)]


def summary(click: str, baseline: str) -> str:
    means = ", ".join(f"avg({s}) AS {s[:-2]}_mean_s" for s in STEPS)
    speedups = ", ".join(
        r(f"b.{s[:-2]}_mean_s / g.{s[:-2]}_mean_s", f"{s[:-2]}_speedup") for s in STEPS
    )
    shown = ("mean_wall_s", "std_wall_s", "min_wall_s", "max_wall_s", "mean_max_rss_mb",
             "mean_cpu_percent", *[f"{s[:-2]}_mean_s" for s in STEPS])
    return f"""{run_records(click)},
g AS (
  SELECT exp_id, count(*) AS n_runs, avg(wall_seconds) AS mean_wall_s,
         stddev_pop(wall_seconds) AS std_wall_s, min(wall_seconds) AS min_wall_s,
         max(wall_seconds) AS max_wall_s, avg(max_rss_bytes / 1048576) AS mean_max_rss_mb,
         avg(mean_cpu_percent) AS mean_cpu_percent, min(started) AS started, {means}
  FROM runs GROUP BY exp_id
)
SELECT g.exp_id, 'run of ' || g.exp_id AS "desc", g.n_runs, {", ".join(r(f"g.{c}", c) for c in shown)},
  {r('b.mean_wall_s / g.mean_wall_s', 'speedup')}, b.exp_id AS baseline, {speedups}
FROM g JOIN g b ON b.exp_id = {baseline}"""


SQL["run_summary"] = summary("B0", "'B0'")
SQL["run_summary_without_baseline"] = summary("C1", "(SELECT exp_id FROM g ORDER BY started LIMIT 1)")
sql(
    "run_wall_times",
    run_records(),
    f"""SELECT exp_id, {r('avg(wall_seconds)', 'mean')}, {r('stddev_samp(wall_seconds)', 'std')}
    FROM runs GROUP BY exp_id""",
)
sql(
    "run_speedups",
    run_records() + ", g AS (SELECT exp_id, avg(wall_seconds) AS mean FROM runs GROUP BY exp_id)",
    f"""SELECT exp_id, {r('mean')},
    {r("(SELECT mean FROM g WHERE exp_id = 'B0') / mean", 'speedup')} FROM g""",
)
sql(
    "run_step_speedups",
    run_records()
    + ", g AS (SELECT exp_id, "
    + ", ".join(f"avg({s}) AS {s}" for s in STEPS)
    + " FROM runs GROUP BY exp_id)",
    "SELECT g.exp_id, "
    + ", ".join(r(f"b.{s} / nullif(g.{s}, 0)", s) for s in STEPS)
    + " FROM g JOIN g b ON b.exp_id = 'B0'",
)
SQL["run_step_seconds"] = f"""SELECT event_id % 7 + 1 AS step,
  {r("CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE)", "seconds")}
FROM events WHERE event_type IN ('click', 'purchase', 'view') AND user_id % 3 = 1 GROUP BY 1"""
sql(
    "run_records_roundtrip",
    run_records(),
    f"""SELECT exp_id, exp_id || '_r' || CAST(user_id AS VARCHAR) AS run_id,
    CAST(user_id AS INTEGER) AS run_idx, {rounded('wall_seconds', 'step3_s')} FROM runs""",
)

# --- as-of joins, spans of time, intervals, global ranks, streams -------------------------

sql(
    "ticks_asof_regime",
    f"""WITH daily AS (
  SELECT event_type, CAST(ts AS DATE) + 1 AS known_day, sum(round(value * 100)) / count(*) AS mean FROM events GROUP BY 1, 2
),
known AS (
  SELECT event_type, known_day, CASE WHEN mean < 1900 THEN '{REGIMES[0]}' WHEN mean < 2100 THEN '{REGIMES[1]}'
         ELSE '{REGIMES[2]}' END AS regime FROM daily
)""",
    """SELECT event_id, CAST(known_day AS DATE) AS known_day, regime FROM events e ASOF LEFT JOIN known k
    ON e.event_type = k.event_type AND e.ts >= k.known_day""",
)
sql(
    "ticks_asof_next_purchase",
    """WITH bought AS (
  SELECT user_id, ts, max(event_id) AS purchase FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
)""",
    """SELECT event_id, CASE WHEN b.ts <= e.ts + INTERVAL 2 DAYS THEN purchase END AS purchase
    FROM events e ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts < b.ts""",
)
_SPANS = {"7d": (6, 7, 5), "30d": (29, 30, 10)}
_CALENDAR = ", ".join(
    f"""avg(px) OVER p{tag} AS price_mean_{tag}, stddev_samp(px) OVER p{tag} AS price_std_{tag},
    count(px) OVER p{tag} AS price_count_{tag}, avg(ret_1d) OVER r{tag} AS ret_mean_{tag},
    stddev_samp(ret_1d) OVER r{tag} AS ret_std_{tag}, count(ret_1d) OVER r{tag} AS ret_count_{tag}"""
    for tag in _SPANS
)
_FRAMES = ", ".join(
    f"""p{tag} AS (PARTITION BY ent ORDER BY tm RANGE BETWEEN INTERVAL {now} DAYS PRECEDING AND CURRENT ROW),
    r{tag} AS (PARTITION BY ent ORDER BY tm RANGE BETWEEN INTERVAL {back} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"""
    for tag, (now, back, _) in _SPANS.items()
)
sql(
    "calendar_features",
    "WITH " + BARS + ",\n" + KEYED + f""",
before AS (SELECT *, lag(px) OVER (PARTITION BY ent ORDER BY tm) AS px_before FROM keyed),
returned AS (SELECT *, {LOG_RETURN} AS ret_1d FROM before),
rolled AS (SELECT *, {_CALENDAR} FROM returned WINDOW {_FRAMES}),
scored AS (SELECT *, """ + ", ".join(
        f"""CASE WHEN ret_count_{tag} >= {least} AND ret_std_{tag} >= 0.0001
        THEN (ret_1d - ret_mean_{tag}) / ret_std_{tag} END AS zscore_{tag}""" for tag, (_, _, least) in _SPANS.items()
    ) + " FROM rolled)",
    f"SELECT {BAR_COLUMNS}, {rounded('ret_1d')}, " + ", ".join(
        f"""{rounded(*[f'{p}_{s}_{tag}' for p in ('price', 'ret') for s in ('mean', 'std')], f'zscore_{tag}')},
        price_count_{tag}, ret_count_{tag}""" for tag in _SPANS
    ) + " FROM scored",
)
_HOURS = {"6h": 6, "24h": 24}
sql(
    "ticks_calendar_statistics",
    "WITH rolled AS (SELECT event_id, " + ", ".join(
        f"""avg(value) OVER w{tag} AS value_mean_{tag}, stddev_samp(value) OVER w{tag} AS value_std_{tag},
        count(value) OVER w{tag} AS value_count_{tag}""" for tag in _HOURS
    ) + " FROM (SELECT * REPLACE (round(value * 100) AS value) FROM events) WINDOW " + ", ".join(
        f"""w{tag} AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN
        INTERVAL {n * 3_600_000_000 - 1} MICROSECONDS PRECEDING AND CURRENT ROW)""" for tag, n in _HOURS.items()
    ) + ")",
    "SELECT event_id, " + ", ".join(
        f"{rounded(f'value_mean_{tag}', f'value_std_{tag}')}, value_count_{tag}" for tag in _HOURS
    ) + " FROM rolled",
)
sql(
    "overlapping_runs",
    NEXT + """,
spans AS (
  SELECT symbol, regime, regime_group_id AS run, min("Date") AS first_day, max("Date") AS last_day
  FROM numbered GROUP BY ALL
)""",
    """SELECT a.regime, a.run AS lead_run, b.symbol, b.run, greatest(a.first_day, b.first_day) AS from_day,
    least(a.last_day, b.last_day) AS to_day FROM spans a JOIN spans b ON a.regime = b.regime
    AND a.first_day <= b.last_day AND b.first_day <= a.last_day WHERE a.symbol = 'S1' AND b.symbol <> 'S1'""",
)
sql(
    "global_value_ranks",
    """WITH ranked AS (SELECT event_id, rank() OVER w AS rank, percent_rank() OVER w AS percent_rank,
  cume_dist() OVER w AS cume_dist, count(*) OVER (PARTITION BY value) AS ties FROM events WINDOW w AS (ORDER BY value NULLS FIRST))""",
    f"SELECT event_id, rank, ties, {rounded('percent_rank', 'cume_dist')} FROM ranked",
)
sql(
    "global_value_tiles",
    "WITH lines AS (SELECT l_orderkey * 8 + l_linenumber AS line, l_quantity FROM lineitem)",
    """SELECT line, row_number() OVER w AS position, ntile(100) OVER w AS ntile
    FROM lines WINDOW w AS (ORDER BY l_quantity NULLS FIRST, line)""",
)
sql(
    "score_area_by_ranks",
    SCORED + """,
placed AS (SELECT label, rank() OVER (ORDER BY proba1) + (count(*) OVER (PARTITION BY proba1) - 1) / 2 AS middle FROM scored),
sums AS (
  SELECT sum(middle) FILTER (WHERE label > 0) AS s, count(*) FILTER (WHERE label > 0) AS p,
         count(*) FILTER (WHERE label = 0) AS n FROM placed
)""",
    f"SELECT {r('(s - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * n)', 'roc_auc')}, p AS positives, n AS negatives FROM sums",
)
_STREAMED = f"""WITH told AS (
  SELECT *, CASE WHEN value < 20 THEN '{REGIMES[0]}' ELSE '{REGIMES[1]}' END AS regime FROM events
)"""
sql(
    "ticks_streamed_run_ids",
    _STREAMED + f""",
paired AS (SELECT *, lag(regime) OVER (PARTITION BY event_type ORDER BY ts) AS regime_prev FROM told),
changed AS (SELECT *, {CHANGED} AS is_transition FROM paired)""",
    """SELECT event_id, regime_prev, is_transition, false AS late, CAST(sum(CASE WHEN is_transition THEN 1 ELSE 0 END)
    OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS regime_group_id FROM changed""",
)
sql(
    "ticks_streamed_breadth",
    _STREAMED,
    """SELECT CAST(ts AS DATE) AS day, regime, count(DISTINCT user_id) AS entities, CAST(count(*) AS BIGINT) AS rows
    FROM told GROUP BY 1, 2 HAVING max(CAST(ts AS DATE)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
sql(
    "ticks_grouping_sets",
    _STREAMED + """,
cents AS (
  SELECT event_type, regime, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(round(value * 100) AS BIGINT) AS cents FROM told
),
grouped AS (
  SELECT event_type, regime, month, CAST(grouping(event_type, regime, month) AS BIGINT) AS level, count(*) AS rows,
    count(cents) AS known, CAST(sum(cents) AS BIGINT) AS total, min(cents) AS least, max(cents) AS most, avg(cents) AS mean
  FROM cents GROUP BY GROUPING SETS ((event_type, regime, month), (event_type, regime), (regime, month), ())
)""",
    f"SELECT event_type, regime, month, level, rows, known, total, least, most, {rounded('mean')} FROM grouped",
)
sql(
    "weekly_users_from_daily",
    _STREAMED,
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, regime, count(DISTINCT user_id) AS entities
    FROM told GROUP BY ALL""",
)
sql(
    "event_props",
    "",
    """SELECT event_id, CASE WHEN event_id % 97 = 0 THEN props[:-2] END AS malformed,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 1 THEN NULL WHEN event_id % 83 = 2 THEN 5
    ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k FROM events""",
)
sql(
    "gauge_closed_form_weights",
    """WITH odds AS (
  SELECT event_type AS t, event_type NOT IN ('error', 'click') AS other,
    CAST(value >= 20 AS INTEGER) AS label FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL
),
logits AS (
  SELECT ln(sum(label) FILTER (WHERE t = 'error') / sum(1 - label) FILTER (WHERE t = 'error')) AS error,
    ln(sum(label) FILTER (WHERE t = 'click') / sum(1 - label) FILTER (WHERE t = 'click')) AS click,
    ln(sum(label) FILTER (WHERE other) / sum(1 - label) FILTER (WHERE other)) AS rest FROM odds
)""",
    """SELECT 'is_error' AS feature, round(error - rest, 3) AS weight FROM logits
    UNION ALL SELECT 'is_click', round(click - rest, 3) FROM logits""",
)
sql(
    "trades_without_listed_days",
    """WITH trades AS (
  SELECT l_orderkey, l_linenumber, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS "Date",
    l_returnflag = 'R' AND l_quantity >= 25 AS listed FROM lineitem
)""",
    """SELECT l_orderkey, l_linenumber, symbol, "Date" FROM trades t WHERE NOT EXISTS (
    SELECT 1 FROM trades x WHERE x.listed AND x.symbol = t.symbol AND x."Date" = t."Date")""",
)
sql(
    "ticks_of_listed_users",
    "",
    """SELECT event_id, event_type, user_id FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)

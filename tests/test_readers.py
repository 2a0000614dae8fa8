"""Scans keep what was written."""

import datetime

from tideline.sources import readers, writers


def test_symbols_that_look_like_numbers_or_dates_keep_their_text(spark, tmp_path):
    symbols = ["007", "7", "0700", "2024-01-02", "1e3", "x y", None]
    rows = [(datetime.date(2024, 1, 1), s, 1.0) for s in symbols]
    writers.write_panel(spark.createDataFrame(rows, "Date date, symbol string, Close double"), f"{tmp_path}/p", ["symbol"])
    back = readers.read_panel(spark, f"{tmp_path}/p")
    assert dict(back.dtypes)["symbol"] == "string"
    assert {r.symbol for r in back.collect()} == set(symbols)


def test_run_summaries_have_the_types_of_run_records(spark, tmp_path):
    (tmp_path / "summary.csv").write_text("exp_id,run_id,wall_seconds,run_idx\n7,001,3,2\n")
    row = readers.read_runs(spark, str(tmp_path)).first()
    assert (row.exp_id, row.wall_seconds, row.run_idx) == ("7", 3.0, 2)

import datetime

import pytest

from tideline.operators import cleaning

RAW = "SNo string, Name string, Symbol string, Date string, High string, Low string, Open string, Close string, Volume string, Marketcap string, file_name string"


def raw(spark, *rows):
    """Rows of (Symbol, Date, Close, file name); the other measures repeat Close."""
    return spark.createDataFrame(
        [("1", "x", s, d, c, c, c, c, c, c, f) for s, d, c, f in rows], RAW
    )


def test_symbol_comes_from_the_row_then_from_the_file(spark):
    df = raw(
        spark,
        ("btc", "2020-01-01", "1", "file:/d/coin_ETH.csv"),
        (None, "2020-01-01", "1", "file:/d/coin_eth.csv"),
        (None, "2020-01-01", "1", "file:/coin_no.csv/other.csv"),
        (None, "2020-01-01", "1", "C:\\d\\coin_ltc.csv"),
    )
    assert [r["symbol"] for r in cleaning.name_symbols(df).collect()] == ["BTC", "ETH", None, "LTC"]
    assert "name" in cleaning.name_symbols(df).columns and "sno" in cleaning.name_symbols(df).columns


@pytest.mark.parametrize(
    "text,number",
    [("$1,234.50", 1234.5), ("-3 USD", -3.0), ("", None), ("n/a", None), ("1-2", None),
     ("1e5", 15.0), (None, None), (".", None)],
)
def test_numbers(spark, text, number):
    df = raw(spark, ("a", "2020-01-01", text, "f"))
    assert cleaning.type_measures(df).first()["Close"] == number


@pytest.mark.parametrize(
    "text,day",
    [("2020-02-29 23:59:59", datetime.date(2020, 2, 29)), ("2020-02-30", None), ("n/a", None), (None, None)],
)
def test_dates(spark, text, day):
    assert cleaning.type_dates(raw(spark, ("a", text, "1", "f"))).first()["Date"] == day


def test_clean_drops_incomplete_and_excluded_rows(spark):
    df = raw(
        spark,
        ("usdt", "2020-01-01", "1", "f"),
        ("Btc", "2020-01-01", "1", "f"),
        ("Btc", "bad", "1", "f"),
        ("Btc", "2020-01-01", "n/a", "f"),
        (None, "2020-01-01", "1", "readme.csv"),
    )
    clean = cleaning.clean_bars(df)
    assert clean.columns == list(cleaning.PANEL_COLUMNS)
    assert [(r["symbol"], r["Close"]) for r in clean.collect()] == [("BTC", 1.0)]


def test_cleaning_is_one_map_over_the_scan(spark):
    plan = cleaning.clean_bars(raw(spark, ("a", "b", "c", "d")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert cleaning.present_columns(df, ["a", "x", "b", "a"]) == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        cleaning.present_columns(df, ["a"], required=["x"])
    with pytest.raises(ValueError, match="none of"):
        cleaning.present_columns(df, ["x"])


def test_summary_and_retention(spark, bars):
    panel = bars({"a": [1.0, None, 3.0], "b": [4.0]})
    summary = cleaning.panel_summary(panel).first()
    assert (summary["rows"], summary["symbols"]) == (4, 2)
    assert summary["max_date"] == datetime.date(2020, 1, 3)
    kept = cleaning.retention(panel, ["Close"]).first()
    assert (kept["rows_before"], kept["rows_after"], kept["nulls_Close"]) == (4, 3, 1)
    assert kept["retained"] == 0.75
    nothing = cleaning.retention(panel.limit(0), ["Close"]).first()
    assert nothing["retained"] is None
    assert cleaning.panel_summary(panel.limit(0)).first()["rows"] == 0
    assert [r[0] for r in cleaning.distinct_entities(panel).collect()] == ["a", "b"]

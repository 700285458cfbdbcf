import datetime as dtm

import pytest
from pyspark.sql import functions as F

from barline import sources
from tests.conftest import day


def test_vendor_headers_from_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "Date,Adj Close,High,Low,Close,Open,Volume\n2020-01-02,1.5,3,1,2,NaN,30000000000\n"
    )
    schema = "Date date, `Adj Close` double, High double, Low double, Close double, Open double, Volume bigint"
    got = sources.read_bars(spark, str(tmp_path), "csv", schema, ticker="X", header="true")
    assert got.columns == ["ticker", "dt", "open", "high", "low", "close", "adj_close", "volume"]
    assert tuple(got.first()) == ("X", dtm.date(2020, 1, 2), None, 3.0, 1.0, 2.0, 1.5, 30_000_000_000)
    with pytest.raises(ValueError, match="schema"):
        sources.read_bars(spark, str(tmp_path), "csv")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_bar_files_round_trip(spark, make_bars, tmp_path, fmt):
    bars = make_bars([("A", 0, 1, 2, 0.5, 1.5, 10), ("B", 1, 2, 3, 1.0, 2.5, 20)])
    path = str(tmp_path / fmt)
    sources.replace_table(make_bars([("Z", 9, 1, 1, 1, 1, 1)]), path, fmt)
    sources.replace_table(bars, path, fmt)  # replaces, does not append
    schema = sources.BAR_SCHEMA if fmt == "json" else None
    got = sources.read_bars(spark, path, fmt, schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, bars.collect()))


def test_partition_folder_becomes_the_ticker(spark, make_bars, tmp_path):
    bars = make_bars([("A", 0, 1, 2, 0.5, 1.5, 10), ("B", 1, 2, 3, 1.0, 2.5, 20)])
    sources.replace_table(bars, str(tmp_path / "p"), partition_by=["ticker"])
    got = sources.read_bars(spark, str(tmp_path / "p"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, bars.collect()))


def test_rates_keep_only_date_and_close(spark, tmp_path):
    (tmp_path / "fx.csv").write_text("Date,Open,Close\n2020-01-02,1,17.5\n2020-01-03,1,NaN\n")
    got = sources.read_fx(
        spark, str(tmp_path), "csv", "Date", "Close", "Date date, Open double, Close double", header="true"
    )
    assert [tuple(r) for r in got.orderBy("fx_dt").collect()] == [
        (dtm.date(2020, 1, 2), 17.5),
        (dtm.date(2020, 1, 3), None),
    ]


def test_bars_from_trades_with_ties(spark):
    ticks = spark.createDataFrame(
        [("A", 0, 3, 10.0, 1), ("A", 0, 1, 12.0, 2), ("A", 0, 2, 8.0, 3), ("A", 1, 1, 5.0, 4)],
        "ticker string, d int, seq int, price double, qty int",
    )
    got = {r.dt: r for r in sources.build_bars(ticks, F.col("d")).collect()}
    assert (got[0].open, got[0].high, got[0].low, got[0].close, got[0].volume) == (12, 12, 8, 10, 6)
    assert got[1].open == got[1].close == got[1].adj_close == 5


def test_lookback_excludes_the_end(spark, make_bars):
    bars = make_bars([("A", i, 1, 1, 1, 1, 1) for i in range(10)])
    got = sources.lookback(bars, day(8), days=3).collect()
    assert sorted(r.dt for r in got) == [day(5), day(6), day(7)]


def test_universe_by_list_and_by_table(spark, make_bars):
    bars = make_bars([(t, 0, 1, 1, 1, 1, 1) for t in "ABC"])
    listed = sources.in_universe(bars, ["C", "A"])
    joined = sources.in_universe(bars, spark.createDataFrame([("A",), ("C",), ("C",)], "ticker string"))
    assert {r.ticker for r in listed.collect()} == {"A", "C"}
    assert joined.count() == 2
    assert sources.concat_bars(bars, bars.select(*reversed(bars.columns))).count() == 6
    assert sources.distinct_tickers(sources.concat_bars(bars, bars)).count() == 3


def test_dimension_types_and_defaults(spark):
    raw = spark.createDataFrame([("A", "10", None), ("B", "20", False)], "ticker string, default_window string, enabled boolean")
    dim = sources.asset_dimension(raw, {"trade_fee": 0.001})
    assert len(dim.columns) == 17 and dict(dim.dtypes)["default_window"] == "int"
    got = {r.ticker: r for r in dim.collect()}
    assert (got["A"].default_window, got["A"].enabled, got["A"].trade_fee) == (10, True, 0.001)
    assert got["B"].enabled is False
    assert sources.portfolio_dimension(spark).count() == 7


def test_duplicate_keys(spark, make_bars):
    bars = make_bars([("A", 0, 1, 1, 1, 1, 1), ("A", 0, 2, 2, 2, 2, 2), ("B", 0, 1, 1, 1, 1, 1)])
    assert [tuple(r) for r in sources.duplicate_keys(bars, "ticker", "dt").collect()] == [("A", day(0), 2)]

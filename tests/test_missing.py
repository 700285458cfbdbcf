"""Missing and late values: NaN at every entry, unscored rows, unknown assets, any trade order."""

from __future__ import annotations

import datetime as dtm

from pyspark.sql import functions as F

from barline import streaming
from barline.operators import ledger, measures
from barline.operators.regime import chosen_window
from barline.sources import build_bars, canonical_bars
from tests.conftest import day

NAN = float("nan")


def test_missing_volume_of_a_vendor_file(spark):
    rows = [(day(i), 1.0, 1.0, 1.0, 1.0, 1.0, v) for i, v in enumerate([NAN, float("inf"), 5.0, None])]
    raw = spark.createDataFrame(
        rows, "dt date, open double, high double, low double, close double, adj_close double, volume double"
    )
    bars = canonical_bars(raw, "A").orderBy("dt").collect()
    assert [b.volume for b in bars] == [None, None, 5, None]


def test_trades_without_a_price(spark):
    ticks = spark.createDataFrame(
        [("A", NAN, 1.0, 1), ("A", 2.0, NAN, 2), ("A", 3.0, 4.0, 3), ("A", None, 8.0, 4)],
        "ticker string, price double, qty double, seq bigint",
    )
    bar = build_bars(ticks, F.lit(day(0))).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (2.0, 3.0, 2.0, 3.0, 13)


def test_unknown_volatility_takes_the_long_window(spark):
    rows = spark.createDataFrame([(NAN,), (None,), (1.0,), (0.001,)], "v double")
    assert [r[0] for r in rows.select(chosen_window(F.col("v"))).collect()] == [20, 20, 10, 20]


def test_unscored_rows_stay_in_cash(spark):
    rows = spark.createDataFrame(
        [("A", day(i), i + 1, 3, 0.01, 0.3, 0.01) for i in range(3)],
        "ticker string, dt date, rn bigint, n bigint, bm_ret double, adx double, avg_vol double",
    )
    scores = spark.createDataFrame(
        [("A", day(0), 0.1, 0.1, 0.8), ("A", day(1), 0.8, 0.1, 0.1)],
        "ticker string, dt date, p_short double, p_cash double, p_long double",
    )
    fact = ledger.strategy_fact(ledger.with_scores(rows, scores))
    assert [r.pos for r in fact.orderBy("dt").collect()] == [1, -1, 0]
    signal = measures.latest_signal(fact).first()
    assert (signal.dt, signal.pos) == (day(2), 0)


def test_assets_that_the_dimension_lacks(spark):
    fact = spark.createDataFrame(
        [(day(0), t, 1, 1.0, 0.1, 0.2, 0.1, 0.2, 0.1, 0.0, 0.0, 0.0) for t in "AB"],
        "dt date, ticker string, pos int, lev double, net_ret double, bm_ret double, cum_net double, "
        "cum_bm double, gross_ret double, fee double, interest double, borrow double",
    )
    dim = spark.createDataFrame(
        [("A", "equity", "tech")], "ticker string, asset_class string, sector string"
    )
    assert measures.directional_accuracy(fact, dim).first().calls == 2
    assert measures.directional_accuracy(fact, dim, "asset_class = 'equity'").first().calls == 1
    assert {r.ticker for r in measures.asset_summary(fact, dim).collect()} == {"A", "B"}


def test_streamed_bars_keep_late_trades(spark, tmp_path):
    """Four files of one trade each, far apart and out of order, one per micro-batch."""
    start = dtm.datetime(2024, 1, 1)
    trades = [(240, 5.0), (0, 1.0), (240, 7.0), (0, 3.0)]
    schema = "ticker string, ts timestamp, price double, qty int, seq bigint"
    for i, (hours, price) in enumerate(trades):
        rows = [("A", start + dtm.timedelta(hours=hours, minutes=i), price, 1, i)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    streaming.run_available(stream, streaming.bar_parts(out), f"{tmp_path}/state", mode="append")
    bars = [(r.open, r.close, r.volume) for r in streaming.merged_bars(spark, out).orderBy("ts").collect()]
    assert bars == [(1.0, 3.0, 2), (5.0, 7.0, 2)]

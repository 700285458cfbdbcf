"""Keys and types are checked where they come in; sinks and signals keep the right rows."""

import pytest
from pyspark.sql import functions as F

from barline import sources
from barline.operators.fx import fx_fill, fx_join
from barline.plans import attach_spread, number_rows
from barline.streaming import keep_latest_signals, signals


def test_a_repeated_bar_key_is_an_error(spark, make_bars):
    bars = make_bars([("A", 0, 1, 1, 1, 1, 1), ("A", 0, 2, 2, 2, 2, 2)])
    with pytest.raises(Exception, match="two rows with one"):
        number_rows(bars).collect()


def test_rates_join_on_dates_only(spark, make_bars, make_fx):
    bars = make_bars([("A", 0, 1, 1, 1, 1, 1)])
    with pytest.raises(TypeError, match="must be a DATE"):
        fx_join(bars.withColumn("dt", F.col("dt").cast("timestamp")), make_fx({0: 10}))
    with pytest.raises(TypeError, match="must be a DATE"):
        fx_fill(bars, make_fx({0: 10}).withColumn("fx_dt", F.col("fx_dt").cast("timestamp")))


@pytest.mark.parametrize("tickers", [["A", "B", "A"], ["A", None]])
def test_the_dimension_has_one_row_per_ticker(spark, tickers):
    rows = spark.createDataFrame([(t,) for t in tickers], "ticker string")
    with pytest.raises(Exception, match="repeated or NULL ticker"):
        sources.asset_dimension(rows).collect()


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    sources.replace_table(spark.range(3), path)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sources.replace_table(bad, path)
    assert sources.read_table(spark, path).count() == 3
    sources.replace_table(sources.read_table(spark, path).where("id > 0"), path)
    assert sorted(r.id for r in sources.read_table(spark, path).collect()) == [1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_a_correction_of_a_later_batch_wins(spark, tmp_path):
    def batch(day, pos):
        return spark.sql(
            f"select 'A' ticker, date'2024-01-0{day}' dt, {pos} pos, 1D lev, 0.1D bm_ret"
        )

    merge = keep_latest_signals(str(tmp_path))
    for i, rows in enumerate([batch(1, 1), batch(2, 1), batch(2, -1), batch(1, 0)]):
        merge(rows, i)
    row = signals(spark, str(tmp_path)).first()
    assert (str(row.dt), row.pos) == ("2024-01-02", -1)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["version=2", "version=3"]


def test_attach_spread_keeps_every_row(spark):
    rows = spark.range(100).select(F.lit("A").alias("ticker"), F.col("id").alias("dt"))
    rows = rows.unionByName(spark.range(3).select(F.lit("B").alias("ticker"), F.col("id").alias("dt")))
    found = spark.createDataFrame([("A", 7)], "ticker string, v int")
    assert attach_spread(rows, found, ["ticker"], "dt").count() == 100
    left = attach_spread(rows, found, ["ticker"], "dt", how="left")
    assert left.count() == 103 and left.where("v is null").count() == 3

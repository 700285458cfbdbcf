import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barline.plans import attach_per_key, blocks, frame_window, number_rows, rolling_means
from barline.plans import running_totals, with_frames
from tests.conftest import day


@pytest.fixture(scope="module")
def series(spark):
    """One ticker with most rows, with gaps, and two short ones."""
    rng = random.Random(7)
    rows = [("hot", day(i), rng.uniform(-1, 1)) for i in range(600) if rng.random() < 0.6]
    rows += [("b", day(i), float(i)) for i in (3, 4, 500)] + [("c", day(9), 1.0)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "ticker string, dt date, x double")


def whole(name):
    return Window.partitionBy(name).orderBy("dt")


def test_row_numbers_across_buckets(series, monkeypatch):
    monkeypatch.setattr(blocks, "BUCKET_STEPS", 16)
    got = number_rows(series, previous={"px": "x", "pd": "dt"})
    w = whole("ticker")
    wrong = got.withColumns(
        {
            "rn2": F.row_number().over(w),
            "n2": F.count(F.lit(1)).over(Window.partitionBy("ticker")),
            "px2": F.lag("x").over(w),
            "pd2": F.lag("dt").over(w),
        }
    ).where("rn <> rn2 or n <> n2 or not (px <=> px2) or not (pd <=> pd2)")
    assert wrong.count() == 0 and got.count() == series.count()


@pytest.mark.parametrize("before,after,size", [(5, 0, 16), (5, 2, 4), (40, 1, 7), (3, 3, 1000)])
def test_frames_hold_exactly_the_reach(series, before, after, size):
    numbered = number_rows(series)
    framed = with_frames(numbered, before, after, block_rows=size)
    assert framed.where("own").count() == series.count()
    wrong = framed.where(
        (F.col("rn") <= F.col("block") * size - before)
        | (F.col("rn") > (F.col("block") + 1) * size + after)
        | (F.col("own") != F.floor((F.col("rn") - 1) / size).eqNullSafe(F.col("block")))
    )
    assert wrong.count() == 0
    largest = framed.groupBy("ticker", "block").count().agg(F.max("count")).first()[0]
    assert largest <= size + before + after
    w = whole("ticker").rowsBetween(-before, after)
    inside = framed.withColumn("s", F.sum("x").over(frame_window().rowsBetween(-before, after)))
    want = numbered.withColumn("want", F.sum("x").over(w)).select("ticker", "rn", "want")
    off = inside.where("own").join(want, ["ticker", "rn"]).where(F.abs(F.col("s") - F.col("want")) > 1e-12)
    assert off.count() == 0


def test_running_totals_by_blocks(series):
    got = running_totals(number_rows(series), {"cum": "x"}, block_rows=8)
    want = F.sum("x").over(whole("ticker").rowsBetween(Window.unboundedPreceding, 0))
    off = got.withColumn("want", want).where(F.abs(F.col("cum") - F.col("want")) > 1e-9)
    assert off.count() == 0 and got.count() == series.count()


def test_per_key_row_reaches_every_block_once(series):
    numbered = number_rows(series)
    stats = numbered.groupBy("ticker").agg(F.max("n").alias("rows"), F.sum("x").alias("total"))
    got = attach_per_key(numbered, stats, rows="rows", block_rows=8)
    assert got.count() == series.count()
    want = F.sum("x").over(Window.partitionBy("ticker"))
    assert got.withColumn("w", want).where("abs(total - w) > 1e-9").count() == 0


@pytest.mark.parametrize("windows", [(20, 10), (12, 5), (10,), (30, 10, 7)])
def test_rolling_means_equal_plain_frames(series, windows):
    with_gaps = series.withColumn("y", F.when(F.col("x") > -0.5, F.col("x")))
    framed = with_frames(number_rows(with_gaps), max(windows), block_rows=1000)
    got = rolling_means(
        framed, {"x": F.col("x"), "y": F.col("y")}, {("y",): F.col("y")}, windows
    )
    w = frame_window()
    for name in ("x", "y"):
        for k in windows:
            got = got.withColumn(f"want_{name}_{k}", F.avg(name).over(w.rowsBetween(1 - k, 0)))
    for name in ("x", "y"):
        for k in windows:
            a, b = F.col(f"{name}_{k}"), F.col(f"want_{name}_{k}")
            assert got.where((F.abs(a - b) > 1e-12) | (a.isNull() != b.isNull())).count() == 0

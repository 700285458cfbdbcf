"""Master features kept up to date: only the stretches that changed bars touch are worked out again.

Bars of a ticker fall into stretches of ``STRETCH_DAYS`` calendar days. The features of a bar
depend on the bars ``reach`` rows before it and on the one after, so a changed bar makes
its own stretch dirty, the stretches that begin within ``reach`` bars after it, and the one
right before it. A dirty stretch is a frame of its own: its bars and those of the few stretches
that hold its ``reach`` bars before and the bar after. Which these are follows from the number of
bars per stretch, a small table kept beside the features, so what is read depends on what
has changed and not on how long the series are.

A missing rate may be lent by another ticker traded on the same date. Every bar without a
rate leaves an offer (the rate at its own bar before, or none); offers are kept as well, so the
lenders come from them and not from the bars, and where a date's lender has changed the
stretches of its borrowers are dirty too.

An update writes the new rows as one more version and then a state that names, for every
(ticker, stretch), the version that counts. Nothing stored is changed, so a reader sees the
table before or after an update, and a failed update leaves the one before.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.operators.fx import fx_convert, fx_join
from barline.operators.indicators import (
    WINDOWS,
    daily_terms,
    feature_columns,
    look_back,
    rolling_features,
)
from barline.plans import frame_window, land
from barline.plans.landing import hadoop_path

# Days of one stretch: about 350 bars of a daily series. A DATE has at most 7,130 stretches.
STRETCH_DAYS = 512
KEYS = ["ticker", "stretch"]
COUNTS = "ticker string, stretch int, bars bigint, version int"
OFFERS = "ticker string, stretch int, dt date, lent_dt date, lent double"


class Stored(NamedTuple):
    """A feature table: its last version and what belongs to it (none before the first update)."""

    version: int
    counts: DataFrame
    offers: DataFrame


def stretch_of(day: Column, days: int = STRETCH_DAYS) -> Column:
    return F.floor(F.unix_date(day) / F.lit(days)).cast("int")


def with_stretch(bars: DataFrame, days: int = STRETCH_DAYS) -> DataFrame:
    """Bars with their stretch; a table partitioned by ``stretch`` keeps its own column."""
    if "stretch" in bars.columns:
        return bars
    return bars.withColumn("stretch", stretch_of(F.col("dt"), days))


def bars_of(bars: DataFrame, stretches: DataFrame, days: int = STRETCH_DAYS) -> DataFrame:
    """The bars of the listed (ticker, stretch) pairs.

    Their stretch numbers, at most one per ``days`` days of the calendar, and the days they
    span are predicates of the scan: folders of a table partitioned by stretch, or row
    groups of one sorted by day, that hold none of them are not read.
    """
    numbers = sorted(r[0] for r in stretches.select("stretch").distinct().collect())
    if not numbers:
        return with_stretch(bars, days).where("false")
    first, end = (F.date_from_unix_date(F.lit(n * days)) for n in (numbers[0], numbers[-1] + 1))
    return (
        with_stretch(bars.where((F.col("dt") >= first) & (F.col("dt") < end)), days)
        .where(F.col("stretch").isin(numbers))
        .join(stretches.select(*KEYS).distinct(), KEYS, "left_semi")
    )


# --- the stored table -------------------------------------------------------------------


def stored(spark: SparkSession, path: str) -> Stored:
    """The last version whose state has been written whole."""
    fs, folder = hadoop_path(spark, f"{path}/counts")
    versions = [-1]
    if fs.exists(folder):
        for entry in fs.listStatus(folder):  # one folder per update
            name = entry.getPath().getName()
            _, done = hadoop_path(spark, f"{path}/counts/{name}/_SUCCESS")
            if name.startswith("v") and fs.exists(done):
                versions.append(int(name[1:]))
    last = max(versions)
    if last < 0:
        return Stored(last, spark.createDataFrame([], COUNTS), spark.createDataFrame([], OFFERS))
    return Stored(
        last,
        spark.read.schema(COUNTS).parquet(f"{path}/counts/v{last}"),
        spark.read.schema(OFFERS).parquet(f"{path}/offers/v{last}"),
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The features of the last version: ticker, dt, features and the next bar's return."""
    now = stored(spark, path)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(now.counts.select(*KEYS, "version"), [*KEYS, "version"], "left_semi").drop(
        "version", "stretch"
    )


# --- what a change touches ----------------------------------------------------------------


def _positions(counts: DataFrame) -> tuple[DataFrame, Window]:
    """Stretches with the numbers of their first bar and of the bar after their last."""
    series = Window.partitionBy("ticker").orderBy("stretch")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_from", F.coalesce(F.sum("bars").over(before), F.lit(0)))
    return placed.withColumn("_to", F.col("_from") + F.col("bars")), series


def dirty_stretches(counts: DataFrame, touched: DataFrame, reach: int) -> DataFrame:
    """Stretches whose features may have changed; the windows see one row per stretch.

    A touched stretch that has no bar left still makes its neighbours dirty.
    """
    marks = touched.select(*KEYS).distinct().withColumn("_touched", F.lit(True))
    rows, series = _positions(
        counts.select(*KEYS, "bars")
        .join(marks, KEYS, "full")
        .withColumns({"bars": F.coalesce("bars", F.lit(0)), "_touched": F.col("_touched").isNotNull()})
    )
    ended = F.when(F.col("_touched"), F.col("_to"))
    last = F.max(ended).over(series.rowsBetween(Window.unboundedPreceding, -1))
    return (
        rows.withColumns({"_last": last, "_next": F.lead("_touched", 1, False).over(series)})
        .where(F.col("_touched") | F.col("_next") | F.coalesce(F.col("_from") < F.col("_last") + reach, F.lit(False)))
        .select(*KEYS)
    )


def frame_sources(counts: DataFrame, dirty: DataFrame, reach: int) -> DataFrame:
    """``ticker, block, stretch, own``: which stretches make up the frame of a dirty one.

    A stretch has at least one bar, so the ``reach`` bars before lie in as many stretches at most.
    """
    placed, series = _positions(counts.where("bars > 0"))
    near = F.collect_list(F.struct("stretch", "_to")).over(series.rowsBetween(-reach, -1))
    reached = F.filter("_near", lambda s: s["_to"] > F.col("_from") - F.lit(reach))
    sources = F.concat(
        F.transform(reached, lambda s: s["stretch"]), F.array_compact(F.array("stretch", "_after"))
    )
    return (
        placed.withColumns({"_near": near, "_after": F.lead("stretch").over(series)})
        .join(dirty.select(*KEYS).distinct(), KEYS, "left_semi")
        .select("ticker", F.col("stretch").alias("block"), F.explode(sources).alias("stretch"))
        .withColumn("own", F.col("stretch") == F.col("block"))
    )


# --- frames -----------------------------------------------------------------------------------


def _frames(bars: DataFrame, fx: DataFrame, sources: DataFrame, days: int) -> DataFrame:
    """The bars of all frames with a rate row, in order, and the rate at the bar before."""
    w = frame_window("dt")
    rows = fx_join(bars_of(bars, sources, days), fx).join(sources, KEYS)
    repeated = F.lag("dt").over(w) == F.col("dt")
    return rows.withColumns(
        {
            "rn": F.when(
                repeated, F.raise_error(F.lit("two rows with one (ticker, dt)")).cast("int")
            ).otherwise(F.row_number().over(w)),
            "_prev_dt": F.lag("dt").over(w),
            "_prev_fx": F.lag("fx_close").over(w),
        }
    )


def _offers(frames: DataFrame) -> DataFrame:
    """What the bars without a rate have to lend: the rate at the bar before, if it has one."""
    return frames.where(F.col("own") & F.col("fx_close").isNull()).select(
        "ticker",
        F.col("block").alias("stretch"),
        "dt",
        F.when(F.col("_prev_fx").isNotNull(), F.col("_prev_dt")).alias("lent_dt"),
        F.col("_prev_fx").alias("lent"),
    )


def _lenders(offers: DataFrame) -> DataFrame:
    """One row per date that has a lender: the offer of the latest bar."""
    return (
        offers.where(F.col("lent").isNotNull())
        .groupBy("dt")
        .agg(F.max_by("lent", "lent_dt").alias("_lent"))
    )


def _features(frames: DataFrame, lenders: DataFrame, windows: Sequence[int]) -> DataFrame:
    # Lenders are one row per date, as the rates are.
    filled = frames.join(F.broadcast(lenders), "dt", "left").withColumn(
        "fx_close", F.coalesce("fx_close", "_prev_fx", "_lent")
    )
    return (
        rolling_features(daily_terms(fx_convert(filled)), windows)
        .where("own")
        .select("ticker", "dt", *feature_columns(windows), "next_ret", F.col("block").alias("stretch"))
    )


# --- updates -----------------------------------------------------------------------------------


def update_features(
    path: str,
    bars: DataFrame,
    fx: DataFrame,
    changed: DataFrame | None = None,
    windows: Sequence[int] = WINDOWS,
    days: int = STRETCH_DAYS,
) -> Stored:
    """Bring the feature table at ``path`` in line with ``bars`` and give its new state.

    ``bars`` holds all bars as they are now; ``changed`` the keys (ticker, dt) of those that are
    new, corrected or withdrawn since the last update, and also of bars on dates whose
    rate has changed. Without ``changed``, and the first time, everything counts as changed.
    A table keeps the ``days`` and ``windows`` of its first update. Bars on dates
    without a rate row have no features; (ticker, dt) must be unique.
    """
    spark = bars.sparkSession
    before = stored(spark, path)
    version, reach = before.version + 1, look_back(windows) + 1  # and the rate before that
    dated = fx.select(F.col("fx_dt").alias("dt"))
    if changed is None or before.version < 0:
        touched = with_stretch(bars.select("ticker", "dt"), days).select(*KEYS).distinct()
        touched = touched.unionByName(before.counts.select(*KEYS)).distinct()
    else:
        touched = with_stretch(changed.select("ticker", "dt"), days).select(*KEYS).distinct()
    touched = land(touched, "touched-stretches")
    recounted = (
        bars_of(bars.select("ticker", "dt", *[c for c in ("stretch",) if c in bars.columns]), touched, days)
        .join(dated, "dt", "left_semi")
        .groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("bars"))
    )
    counts = land(
        before.counts.join(touched, KEYS, "left_anti").unionByName(
            recounted.withColumn("version", F.lit(version))
        ),
        "stretch-counts",
    )
    dirty = land(dirty_stretches(counts, touched, reach), "dirty-stretches")
    # Withdrawn stretches have no bars left and no offers either.
    gone = dirty.unionByName(touched).distinct()
    offers = land(
        before.offers.join(gone, KEYS, "left_anti").unionByName(
            _offers(_frames(bars, fx, frame_sources(counts, dirty, reach), days))
        ),
        "rate-offers",
    )
    lenders = _lenders(offers)
    moved = (
        lenders.join(_lenders(before.offers).withColumnRenamed("_lent", "_was"), "dt", "full")
        .where(~F.col("_lent").eqNullSafe(F.col("_was")))
        .select("dt")
    )
    borrowers = offers.where(F.col("lent").isNull()).join(moved, "dt", "left_semi").select(*KEYS)
    dirty = land(
        dirty.unionByName(dirty_stretches(counts, borrowers, reach)).distinct(), "dirty-stretches"
    )
    rows = _features(_frames(bars, fx, frame_sources(counts, dirty, reach), days), lenders, windows)
    rows.write.mode("overwrite").parquet(f"{path}/rows/version={version}")
    offers.write.mode("overwrite").parquet(f"{path}/offers/v{version}")
    renewed = dirty.withColumn("_renewed", F.lit(version))
    (
        counts.where("bars > 0")
        .join(renewed, KEYS, "left")
        .select(*KEYS, "bars", F.coalesce("_renewed", "version").alias("version"))
        .write.mode("overwrite")
        .parquet(f"{path}/counts/v{version}")  # last: from here on the new version counts
    )
    return stored(spark, path)

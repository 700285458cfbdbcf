"""A stored layout of bars that features read without a shuffle.

``write_layout`` puts the frames of all blocks (see ``plans.blocks``) into a table that is
partitioned by ``lane`` (a hash of the ticker), bucketed by (ticker, block) and sorted by
(ticker, block, dt) within a bucket: the order that every rolling feature asks for. The
shuffle for it is paid once, when bars come in; ``layout_features`` and all that is built
on frames then start from a scan that is already clustered, with no exchange of rows.

A ticker lies in one lane, so a universe prunes lanes when the query runs: the lanes of
its tickers are found first and only their folders are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.fx import PRICES, fx_convert, fx_fill
from barline.operators.indicators import (
    WINDOWS,
    daily_terms,
    feature_columns,
    look_back,
    rolling_features,
)
from barline.plans import BLOCK_ROWS, with_frames

LANES = 64
BUCKETS = 16


def lane_of(ticker: Column, lanes: int = LANES) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(lanes)).cast("int")


def write_layout(
    bars: DataFrame,
    fx: DataFrame,
    table: str,
    path: str,
    windows: Sequence[int] = WINDOWS,
    block_rows: int = BLOCK_ROWS,
    lanes: int = LANES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Write the converted, numbered and framed bars as ``table`` at ``path``, replacing it.

    One file per lane and bucket: rows are dealt by both, so a hot ticker has its blocks
    in all buckets of its lane.
    """
    framed = with_frames(
        fx_convert(fx_fill(bars, fx)), before=look_back(windows), after=1, block_rows=block_rows
    ).select("ticker", "block", "dt", "own", "rn", "n", *PRICES, "volume")
    (
        framed.withColumn("lane", lane_of(F.col("ticker"), lanes))
        .repartition(buckets, "ticker", "block")
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .partitionBy("lane")
        .bucketBy(buckets, "ticker", "block")
        .sortBy("ticker", "block", "dt")
        .saveAsTable(table)
    )
    return bars.sparkSession.table(table)


def in_lanes(layout: DataFrame, universe: DataFrame, lanes: int = LANES) -> DataFrame:
    """Frames of the universe's tickers; lanes without one of them are not read.

    The lanes are one row each, at most ``lanes``, hence the broadcast; the tickers are left to
    Spark's size check.
    """
    tickers = universe.select("ticker").distinct()
    wanted = tickers.select(lane_of(F.col("ticker"), lanes).alias("lane")).distinct()
    return layout.join(F.broadcast(wanted), "lane", "left_semi").join(tickers, "ticker", "left_semi")


def layout_features(layout: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """``master_features`` from a written layout (or part of it)."""
    return (
        rolling_features(daily_terms(layout), windows)
        .where("own")
        .select("dt", "ticker", *feature_columns(windows), "rn", "n", "next_ret")
    )


def drop_layout(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")

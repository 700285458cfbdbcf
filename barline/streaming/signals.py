"""The latest signal per ticker, kept up to date from a stream of fact rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.operators.measures import TENDENCY_BARS
from barline.plans.landing import hadoop_path

STATE = ("ticker", "dt", "pos", "lev", "bm_ret")
GROUP_DAYS = 256


def _last_rows(rows: DataFrame, bars: int) -> DataFrame:
    """The last ``bars`` rows per ticker, reduced per stretch of days first.

    A fact has one row per ticker and date, so no group exceeds ``GROUP_DAYS``
    rows in the first step or ``bars`` per stretch in the second.
    """
    stretch = F.floor(F.unix_date("dt") / F.lit(GROUP_DAYS))
    latest = F.row_number().over(Window.partitionBy("ticker", "_group").orderBy(F.desc("dt")))
    last = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("dt")))
    return (
        rows.withColumn("_group", stretch)
        .withColumn("_place", latest)
        .where(F.col("_place") <= bars)
        .withColumn("_place", last)
        .where(F.col("_place") <= bars)
        .drop("_group", "_place")
    )


def keep_latest_signals(
    path: str, bars: int = TENDENCY_BARS
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` upsert of the last ``bars`` rows per ticker.

    Version ``i`` is version ``i - 1`` with batch ``i`` merged in, so a retried
    batch writes the same version again. A corrected row of a later batch replaces the
    earlier one; within a batch the larger row wins. Versions before ``i - 1`` are deleted.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, batch.select(*STATE)
        told = rows.withColumn("_batch", F.lit(batch_id))
        if batch_id > 0:
            before = spark.read.schema(rows.schema).parquet(f"{path}/version={batch_id - 1}")
            told = told.unionByName(before.withColumn("_batch", F.lit(batch_id - 1)))
        values = [c for c in STATE if c not in ("ticker", "dt")]
        newest = (
            told.groupBy("ticker", "dt")
            .agg(F.max(F.struct("_batch", *values)).alias("_row"))
            .select("ticker", "dt", *[F.col(f"_row.{c}").alias(c) for c in values])
        )
        _last_rows(newest, bars).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        if batch_id > 1:
            fs, old = hadoop_path(spark, f"{path}/version={batch_id - 2}")
            fs.delete(old, True)

    return merge


def signals(spark: SparkSession, path: str) -> DataFrame:
    """Position, leverage and tendency per ticker from the newest version."""
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("version").alias("version"))
    return (
        rows.join(F.broadcast(newest), "version")  # one row
        .groupBy("ticker")
        .agg(
            F.max("dt").alias("dt"),
            F.max_by("pos", "dt").alias("pos"),
            F.max_by("lev", "dt").alias("lev"),
            F.signum(F.avg("bm_ret")).cast("int").alias("tendency"),
        )
    )

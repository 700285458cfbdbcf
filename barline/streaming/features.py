"""Master features from a stream of converted bars, with out-of-order and corrected bars put right.

The state of a ticker is its last ``keep`` bars and nothing else. A micro-batch's bars of
a ticker are put among them by date; from the first changed date on, the features are
computed again over the kept bars and sent out, so a row may come several times and
the newest version of a (ticker, dt) counts. A bar older than the kept ones cannot be
put right from the state: it goes to a side table, from which an update of the stored
features (``operators.incremental``) picks it up, so no bar is lost and none is guessed.

A row's features reach ``look_back`` bars back, so a batch may be up to
``keep - look_back`` bars out of order per ticker without any bar going aside.

The state is a table of at most ``keep`` rows per ticker, written anew by every micro-batch
as ``keep_latest_signals`` writes its own: a retried batch reads the version before it
and writes the same again. All work is column expressions over (ticker, block) frames
of the kept and the new bars; however long a history is, a batch reads only those.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.operators.fx import PRICES
from barline.operators.indicators import (
    WINDOWS,
    daily_terms,
    feature_columns,
    look_back,
    rolling_features,
)
from barline.plans import land, number_rows, with_frames
from barline.plans.landing import hadoop_path

KEEP = 256
BAR = ("ticker", "dt", *PRICES, "volume")


def _ranked(bars: DataFrame, keep: int) -> DataFrame:
    """Bars with ``_back`` (0 for a ticker's newest), for those that are kept.

    Reduced per stretch of dates first: a group has at most ``keep`` dates, the second
    step at most ``keep`` rows per stretch.
    """
    stretch = F.floor(F.unix_date("dt") / F.lit(keep))
    inside = F.row_number().over(Window.partitionBy("ticker", "_stretch").orderBy(F.desc("dt")))
    filled = Window.partitionBy("ticker").orderBy(F.desc("_stretch"))
    counts = (
        bars.withColumn("_stretch", stretch)
        .groupBy("ticker", "_stretch")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn(
            "_newer",
            F.coalesce(F.sum("_rows").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .drop("_rows")
    )
    return (
        bars.withColumn("_stretch", stretch)
        .withColumn("_place", inside)
        .join(counts, ["ticker", "_stretch"])
        .withColumn("_back", F.col("_place") + F.col("_newer") - F.lit(1))
        .drop("_place", "_newer", "_stretch")
    )


def _newest(bars: DataFrame, order: str) -> DataFrame:
    """One row per (ticker, dt): the one with the largest ``order``, then the larger row."""
    values = [c for c in bars.columns if c not in ("ticker", "dt", order)]
    return (
        bars.groupBy("ticker", "dt")
        .agg(F.max(F.struct(order, *values)).alias("_row"))
        .select("ticker", "dt", *[F.col(f"_row.{c}").alias(c) for c in [order, *values]])
    )


def keep_features(
    path: str, windows: Sequence[int] = WINDOWS, keep: int = KEEP
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of the features that a micro-batch of bars changes.

    ``bars`` hold converted prices. A later batch corrects a bar by bringing it again; within
    a batch the larger row wins. Written under ``path``: ``rows`` (features with their
    batch), ``state`` and ``late``, one folder per batch. The table of rows counts once the
    state of its batch is whole; older states are deleted.
    """
    reach = look_back(windows)
    if keep <= reach:
        raise ValueError(f"keep more than {reach} bars, a feature reaches that far back")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        told = batch.select(*BAR).withColumn("_batch", F.lit(batch_id))
        schema = told.withColumn("_full", F.lit(True)).schema
        if batch_id > 0:
            held = spark.read.schema(schema).parquet(f"{path}/state/batch={batch_id - 1}")
        else:
            held = spark.createDataFrame([], schema)
        # Where a ticker has dropped bars, those before its oldest kept one are unknown.
        edge = (
            held.groupBy("ticker")
            .agg(F.min("dt").alias("_oldest"), F.max("_full").alias("_full"))
            .where("_full")
            .drop("_full")
        )
        marked = told.join(edge, "ticker", "left").withColumn(
            "_late", F.coalesce(F.col("dt") < F.col("_oldest"), F.lit(False))
        )
        marked = land(marked, "stream-batch")
        marked.where("_late").select(*BAR).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        fresh = marked.where("not _late").select(*BAR, "_batch")
        both = _newest(held.select(*BAR, "_batch").unionByName(fresh), "_batch")
        frames = with_frames(number_rows(both), before=reach, after=1)
        features = rolling_features(daily_terms(frames), windows).where("own")
        # Rows from the bar before the first changed one on: its next return changes too.
        first = fresh.groupBy("ticker").agg(F.min("dt").alias("_first"))
        last_before = (
            both.join(first, "ticker")
            .where(F.col("dt") < F.col("_first"))
            .groupBy("ticker")
            .agg(F.max("dt").alias("_before"))
        )
        since = first.join(last_before, "ticker", "left").select(
            "ticker", F.coalesce("_before", "_first").alias("_since")
        )
        # The oldest kept rows of a ticker that has dropped bars lack what they reach back to;
        # theirs were right when they were sent and nothing before them can have changed.
        known = (
            features.join(since, "ticker")
            .join(edge.select("ticker", F.lit(True).alias("_full")), "ticker", "left")
            .where(F.col("dt") >= F.col("_since"))
            .where(F.col("_full").isNull() | (F.col("rn") > reach))
        )
        unsure = (
            features.join(since, "ticker")
            .join(edge.select("ticker"), "ticker", "left_semi")
            .where((F.col("dt") >= F.col("_since")) & (F.col("rn") <= reach))
            .select("ticker", "dt")
        )
        known.select("ticker", "dt", *feature_columns(windows), "next_ret").write.mode(
            "overwrite"
        ).parquet(f"{path}/rows/batch={batch_id}")
        # Bars that came behind the newest but before what can be computed: aside as well.
        aside = fresh.select(*BAR).join(unsure, ["ticker", "dt"], "left_semi")
        aside.write.mode("append").parquet(f"{path}/late/batch={batch_id}")
        dropped = _ranked(both, keep)
        full = dropped.groupBy("ticker").agg((F.max("_back") >= keep).alias("_now"))
        was = edge.select("ticker", F.lit(True).alias("_was"))
        (
            dropped.where(F.col("_back") < keep)
            .join(full, "ticker")
            .join(was, "ticker", "left")
            .withColumn("_full", F.col("_now") | F.coalesce("_was", F.lit(False)))
            .select(*BAR, "_batch", "_full")
            .write.mode("overwrite")
            .parquet(f"{path}/state/batch={batch_id}")
        )
        if batch_id > 1:
            fs, old = hadoop_path(spark, f"{path}/state/batch={batch_id - 2}")
            fs.delete(old, True)

    return merge


def streamed_features(spark: SparkSession, path: str) -> DataFrame:
    """The newest features per (ticker, dt)."""
    rows = spark.read.parquet(f"{path}/rows")
    return _newest(rows, "batch").drop("batch")


def late_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars that came too late for the state, to be merged by an update of the stored table."""
    return spark.read.parquet(f"{path}/late").select(*BAR)

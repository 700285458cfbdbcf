"""Bars from a stream of trades."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.sources import canonical_bars
from barline.sources.bars import known_trades


def bar_parts(path: str, length: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of what each micro-batch of trades adds to its bars.

    No state and no watermark: a part keeps the order keys of its open and close, and
    ``merged_bars`` puts the parts together, whatever order the trades came in.
    """
    write = versioned_sink(path)

    def add(batch: DataFrame, batch_id: int) -> None:
        parts = (
            known_trades(batch)
            .groupBy("ticker", F.window("ts", length).alias("_window"))
            .agg(
                F.min_by("price", "seq").alias("open"),
                F.min("seq").alias("open_seq"),
                F.max("price").alias("high"),
                F.min("price").alias("low"),
                F.max_by("price", "seq").alias("close"),
                F.max("seq").alias("close_seq"),
                F.sum("qty").alias("volume"),
            )
        )
        write(parts.withColumn("ts", F.col("_window.start")).drop("_window"), batch_id)

    return add


def merged_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars of all parts so far, as ``build_bars`` makes them from all trades."""
    return (
        spark.read.parquet(path)
        .groupBy("ticker", "ts")
        .agg(
            F.min_by("open", "open_seq").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "close_seq").alias("close"),
            F.sum("volume").cast("bigint").alias("volume"),
        )
        .select(
            "ticker", "ts", "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume"
        )
    )


def windowed_bars(
    ticks: DataFrame, delay: str, length: str = "1 hour", name: str = "ts"
) -> DataFrame:
    """The bars of ``build_bars`` over event-time windows, kept as streaming state.

    The watermark bounds the state to the windows of the last ``delay``; trades later
    than that are dropped, which is why it has no default. ``bar_parts`` drops none.
    """
    return (
        known_trades(ticks)
        .withWatermark("ts", delay)
        .groupBy("ticker", F.window("ts", length).alias("_window"))
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("qty").cast("bigint").alias("volume"),
        )
        .select(
            "ticker",
            F.col("_window.start").alias(name),
            "open",
            "high",
            "low",
            "close",
            F.col("close").alias("adj_close"),
            "volume",
        )
    )


def ingest_bars(stream: DataFrame, path: str, checkpoint: str, ticker: str | None = None) -> None:
    """Append what a stream of vendor bar files holds now, in canonical columns, to a table.

    The file sink's log makes each input file count once, also after a restart.
    """
    (
        canonical_bars(stream, ticker)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def versioned_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: one folder per micro-batch, replaced if the batch is retried."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return write


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a versioned sink (updated windows replace earlier ones)."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "version")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("_row"))
    return newest.select(*keys, "_row.*")


def run_available(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "update",
) -> None:
    """Process what the source holds now, then stop; a later call goes on from the checkpoint."""
    (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )

"""Leak-free scaling, sequence samples and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.operators.indicators import FAMILIES, WINDOWS
from barline.plans import BLOCK_ROWS, attach_per_key, frame_window, with_frames

# Feature order inside a sample row.
SAMPLE_FEATURES = ("log_ret", *FAMILIES)


def scaler_stats(split_rows: DataFrame) -> DataFrame:
    """Mean and population deviation of each feature over a ticker's training rows.

    A feature that never changes gets deviation 1, so it scales to 0.
    """
    sd = {f: F.stddev_pop(f) for f in SAMPLE_FEATURES}
    return (
        split_rows.where(F.col("split") == "train")
        .groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("train_rows"),
            F.max("clean_n").alias("clean_n"),
            *[F.avg(f).alias(f"{f}_mean") for f in SAMPLE_FEATURES],
            *[F.when(sd[f] == 0, F.lit(1.0)).otherwise(sd[f]).alias(f"{f}_sd") for f in SAMPLE_FEATURES],
        )
    )


def scaled_features(
    split_rows: DataFrame, stats: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Split rows with every feature standardised by its ticker's training statistics."""
    joined = attach_per_key(
        split_rows,
        stats.drop("train_rows"),
        rows="clean_n",
        row="clean_rn",
        block_rows=block_rows,
    )
    return joined.select(
        "ticker",
        "dt",
        "split",
        "split_rn",
        "split_n",
        "win",
        *[((F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_sd")).alias(f) for f in SAMPLE_FEATURES],
        "label_next",
    )


def sequence_samples(scaled: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``x``: the ``win`` rows before a row of the same split, ``y``: the last one's next label.

    The row itself is left out of ``x``; the first ``win`` rows of a split have no
    sample. Frame bounds are constants in Spark, so 20 rows are gathered and a
    10-bar ticker keeps the last 10.
    """
    longest = max(WINDOWS)
    framed = with_frames(
        scaled, before=longest, row="split_rn", total="split_n", block_rows=block_rows
    )
    w = frame_window("split_rn", ("ticker", "split"))
    rows = F.collect_list(F.array(*SAMPLE_FEATURES)).over(w.rowsBetween(-longest, -1))
    return (
        framed.withColumns({"_rows": rows, "y": F.lag("label_next").over(w)})
        .where(F.col("own") & (F.col("split_rn") > F.col("win")))
        .select(
            "ticker",
            "split",
            "dt",
            "win",
            F.slice("_rows", -F.col("win"), F.col("win")).alias("x"),
            "y",
        )
    )


def class_weights(samples: DataFrame) -> DataFrame:
    """Balanced weight ``n / (classes * count)`` per ticker and class of the training samples.

    Keyed by the class value, so a class that never occurs shifts nothing.
    """
    ticker = Window.partitionBy("ticker")  # at most three rows
    return (
        samples.where(F.col("split") == "train")
        .groupBy("ticker", "y")
        .agg(F.count(F.lit(1)).alias("n_samples"))
        .withColumn(
            "weight",
            F.sum("n_samples").over(ticker)
            / (F.count(F.lit(1)).over(ticker) * F.col("n_samples")),
        )
    )

"""Rows behind the watermark go to a side table and are counted, none is dropped.

The watermark of a micro-batch is the latest time of the batches before it less ``delay``, kept
as one row per batch beside the table; so a retried batch splits its rows the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCOUNT = "given bigint, kept bigint, late bigint, latest timestamp"


def late_aside(
    path: str, delay: str, write: Callable[[DataFrame, int], None], time: str = "ts"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that hands rows in time on to ``write`` and puts the others aside.

    ``delay`` is an interval such as ``1 day``. A row without a time is late. Rows aside are
    under ``late`` of ``path``, the counts of every batch under ``account``.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = None
        if batch_id > 0:
            before = spark.read.schema(ACCOUNT).parquet(f"{path}/account/batch={batch_id - 1}")
            latest = before.select(F.col("latest").cast("string")).first()[0]  # one row
        edge = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.col(time).isNull() | F.coalesce(F.col(time).cast("timestamp") < edge, F.lit(False))
        kept = batch.where(~late)
        batch.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        write(kept, batch_id)
        (
            batch.agg(
                F.count(F.lit(1)).alias("given"),
                F.count_if(~late).alias("kept"),
                F.count_if(late).alias("late"),
                F.greatest(F.max(F.col(time).cast("timestamp")), F.lit(latest).cast("timestamp")).alias("latest"),
            )
            .write.mode("overwrite")
            .parquet(f"{path}/account/batch={batch_id}")
        )

    return split


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/late").drop("batch")


def account(spark: SparkSession, path: str) -> DataFrame:
    """``batch, given, kept, late`` of every batch."""
    return spark.read.parquet(f"{path}/account").select("batch", "given", "kept", "late")

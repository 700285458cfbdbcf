"""Parts of streamed bars kept in levels, so that readers open few of them.

``bar_parts`` leaves one part per micro-batch. Here ``FAN`` neighbouring parts of a level merge into
one of the next level, as soon as they are there: after N batches at most ``FAN - 1`` parts a
level and ``log(N)`` levels are read. A part covers the batches from its first to its
last; it is written whole under a name that says so and never changed, so a retried merge
writes the same part again.

A reader takes, of the parts that are whole, the largest ones that do not overlap, from the first
batch on. Which parts it takes does not depend on when the small ones are deleted, and that
happens one merge later, so a reader that has begun still finds its parts.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.plans.landing import hadoop_path
from barline.sources.bars import known_trades

FAN = 4
PART = (
    "ticker string, ts timestamp, open double, open_seq decimal(38,0), high double, low double, "
    "close double, close_seq decimal(38,0), volume bigint"
)


class Part(NamedTuple):
    first: int
    last: int
    path: str


def whole_parts(spark: SparkSession, path: str) -> list[Part]:
    """Parts that have been written to the end; one name per part reaches the driver."""
    fs, folder = hadoop_path(spark, path)
    found = []
    for entry in fs.listStatus(folder) if fs.exists(folder) else ():
        name = entry.getPath().getName()
        first, _, last = name.removeprefix("batches-").partition("-")
        _, done = hadoop_path(spark, f"{path}/{name}/_SUCCESS")
        if name.startswith("batches-") and fs.exists(done):
            found.append(Part(int(first), int(last), f"{path}/{name}"))
    return found


def current_parts(spark: SparkSession, path: str) -> list[Part]:
    """The parts that make up the table: each batch once, from the largest parts there are."""
    largest: dict[int, Part] = {}
    for part in whole_parts(spark, path):
        if part.first not in largest or part.last > largest[part.first].last:
            largest[part.first] = part
    out, at = [], 0
    while at in largest:
        out.append(largest[at])
        at = largest[at].last + 1
    return out


def _combined(parts: DataFrame) -> DataFrame:
    """Parts of bars put together; again parts, with the order keys of open and close."""
    return parts.groupBy("ticker", "ts").agg(
        F.min_by("open", "open_seq").alias("open"),
        F.min("open_seq").alias("open_seq"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_seq").alias("close"),
        F.max("close_seq").alias("close_seq"),
        F.sum("volume").cast("bigint").alias("volume"),
    )


def _as_part(df: DataFrame) -> DataFrame:
    kinds = [column.strip().split(" ", 1) for column in PART.replace("(38,0)", "(38;0)").split(",")]
    return df.select(*[F.col(name).cast(kind.replace(";", ",")).alias(name) for name, kind in kinds])


def compacting_parts(
    path: str, length: str = "1 hour", fan: int = FAN
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer as ``bar_parts``, which also merges full levels.

    ``seq`` must fit ``decimal(38,0)``. Trades may come in any order and as late as they like.
    """

    def name(first: int, last: int) -> str:
        return f"{path}/batches-{first:012d}-{last:012d}"

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        trades = known_trades(batch).withColumn("ts", F.window("ts", length)["start"]).select(
            "ticker",
            "ts",
            F.col("price").alias("open"),
            F.col("seq").alias("open_seq"),
            F.col("price").alias("high"),
            F.col("price").alias("low"),
            F.col("price").alias("close"),
            F.col("seq").alias("close_seq"),
            F.col("qty").alias("volume"),
        )
        _as_part(_combined(trades)).write.mode("overwrite").parquet(name(batch_id, batch_id))
        size = fan
        while (batch_id + 1) % size == 0:  # the last batch of a part of this size
            first, step = batch_id + 1 - size, size // fan
            smaller = [name(at, at + step - 1) for at in range(first, first + size, step)]
            whole = _combined(spark.read.schema(PART).parquet(*smaller))
            _as_part(whole).write.mode("overwrite").parquet(name(first, batch_id))
            size *= fan
        drop_covered(spark, path, before=batch_id)

    return add


def drop_covered(spark: SparkSession, path: str, before: int) -> None:
    """Delete parts that a larger part covers, but for those of parts made in batch ``before``."""
    parts = whole_parts(spark, path)
    for part in parts:
        if any(
            p.first <= part.first and part.last <= p.last < before and p != part for p in parts
        ):
            fs, folder = hadoop_path(spark, part.path)
            fs.delete(folder, True)


def compacted_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars of all batches so far, as ``build_bars`` makes them from all trades."""
    parts = current_parts(spark, path)
    rows = (
        spark.read.schema(PART).parquet(*[p.path for p in parts])
        if parts
        else spark.createDataFrame([], PART)
    )
    return _combined(rows).select(
        "ticker", "ts", "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume"
    )

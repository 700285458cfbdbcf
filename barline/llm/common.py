"""Helpers shared by the corpus operators.

Nothing here collects rows. ``land`` (from ``barline.plans``) writes a table to the
shared folder of ``spark.checkpoint.dir`` and reads it back, so row numbers and
partition numbers taken before it stay what they are when a task runs again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.plans import land

# White space of a word in Java's and DuckDB's pattern syntax.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

LOWEST = -(2**63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_rows(df: DataFrame) -> DataFrame:
    """Add ``_row``, unique per row, and ``_run``, the input partition. Land the result
    before it is used twice: both depend on how the input was split."""
    return df.withColumns(
        {"_row": F.monotonically_increasing_id(), "_run": F.spark_partition_id()}
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(
    df: DataFrame, order: Sequence[str], sums: Mapping[str, str], name: str
) -> DataFrame:
    """Add ``{new: column}`` inclusive running sums over the whole table by ``order``.

    Rows are sorted into ranges, one per shuffle partition, and landed; a running sum
    of the range totals (one row per partition) gives each range its start, so no task
    sees more than one range. ``order`` should tell rows apart: rows it does not tell
    apart share a range. The range number stays as ``_part``.
    """
    spark, order = df.sparkSession, list(order)
    ranged = land(
        df.repartitionByRange(partitions(spark), *order).withColumn(
            "_part", F.spark_partition_id()
        ),
        name,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(*[F.sum(col).alias(f"_sum_{new}") for new, col in sums.items()])
        .select(
            "_part",
            *[
                F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_from_{new}")
                for new in sums
            ],
        )
    )
    inside = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    # The broadcast side has one row per shuffle partition.
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumns(
            {new: F.col(f"_from_{new}") + F.sum(col).over(inside) for new, col in sums.items()}
        )
        .drop(*[f"_from_{new}" for new in sums])
    )


def lookup(
    rows: DataFrame, found: DataFrame, keys: Sequence[str], run: str = "_run"
) -> DataFrame:
    """Inner join of ``found`` (one row per ``keys``) onto ``rows``, safe for hot keys.

    The keys are first reduced to one row per (keys, run), which a map-side aggregate
    does before the shuffle; only those meet ``found``. The rows then join on
    (keys, run), so a key with a third of all rows is spread over all runs.
    """
    keys = list(keys)
    pairs = rows.select(*keys, run).distinct().join(found, keys)
    return rows.join(pairs, [*keys, run])

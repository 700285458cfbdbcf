"""As-of join: for every row the last known value at or before its time.

Both tables are cut into buckets of time per key; inside a bucket the values are carried
forward by a window, and what a bucket does not know it takes from the last bucket that
does, which one row per (key, bucket) tells. No window sees more rows than one bucket, so a
key with a third of all rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = 1_024


def time_number(df: DataFrame, order: str) -> Column:
    """Days of a date, microseconds of a timestamp, or the number itself."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(order).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp"))
    return F.col(order).cast("bigint")


def asof_join(
    rows: DataFrame,
    values: DataFrame,
    key: Sequence[str],
    order: str,
    value: str,
    name: str | None = None,
    staleness: int | None = None,
    bucket: int = BUCKET,
) -> DataFrame:
    """``rows`` with ``name``, the newest non-NULL ``value`` of ``values`` with the same ``key`` at
    or before ``order``, and ``{name}_at``, when that was.

    ``staleness`` is how old it may be, in units of ``order`` (days of a date, microseconds of a
    timestamp); without it any age will do. ``(key, order)`` must be unique in ``values``, else
    the larger value of one time is taken; rows with a NULL key or time find nothing.
    """
    key, name = list(key), name or value
    sound = F.lit(True)
    for column in (*key, order, value):
        sound = sound & F.col(column).isNotNull()
    known = (
        values.where(sound)
        .select(*key, F.col(order).alias("_time"), time_number(values, order).alias("_t"), F.col(value).alias("_v"))
        .groupBy(*key, "_time", "_t")
        .agg(F.max("_v").alias("_v"))
        .withColumn("_bucket", F.floor(F.col("_t") / F.lit(bucket)))
    )
    asked = rows.withColumn("_t", time_number(rows, order)).withColumn(
        "_bucket", F.floor(F.col("_t") / F.lit(bucket))
    )
    # Combined per (key, bucket) before the shuffle.
    last = known.groupBy(*key, "_bucket").agg(
        F.max_by("_v", "_t").alias("_last_v"), F.max("_time").alias("_last_time"), F.max("_t").alias("_last_t")
    )
    buckets = asked.select(*key, "_bucket").distinct().withColumn("_asked", F.lit(True))
    series = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last.join(buckets, [*key, "_bucket"], "full")
        .withColumns({f"_old_{c}": F.last(f"_last_{c}", ignorenulls=True).over(series) for c in ("v", "time", "t")})
        .where("_asked")
        .select(*key, "_bucket", "_old_v", "_old_time", "_old_t")
    )
    # Values come before the rows of their own time.
    inside = Window.partitionBy(*key, "_bucket").orderBy("_t", "_kind").rowsBetween(
        Window.unboundedPreceding, 0
    )
    both = known.select(*key, "_bucket", "_t", "_time", "_v", F.lit(0).alias("_kind")).unionByName(
        asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True
    )
    filled = (
        both.withColumns(
            {
                "_new_v": F.last("_v", ignorenulls=True).over(inside),
                "_new_time": F.last("_time", ignorenulls=True).over(inside),
                "_new_t": F.last(F.when(F.col("_kind") == 0, F.col("_t")), ignorenulls=True).over(inside),
            }
        )
        .where("_kind = 1")
        .join(carried, [*key, "_bucket"], "left")
    )
    fresh = F.lit(True) if staleness is None else F.col("_t") - F.coalesce("_new_t", "_old_t") <= staleness
    return filled.select(
        *rows.columns,
        F.when(fresh, F.coalesce("_new_v", "_old_v")).alias(name),
        F.when(fresh, F.coalesce("_new_time", "_old_time")).alias(f"{name}_at"),
    )

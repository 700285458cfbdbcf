"""Ordered work over long series without one task per series.

A window over ``partitionBy(ticker)`` puts a whole ticker into one task, so a
ticker with a third of all rows would decide the run time. Every ordered
computation here is split into blocks of at most ``BLOCK_ROWS`` consecutive rows:

* ``number_rows``   row number within the series, from counts per time bucket;
* ``with_frames``   each block plus copies of the few neighbouring rows that a
  bounded frame reaches, so the window over ``(ticker, block)`` is exact;
* ``running_totals`` a prefix sum from block sums and a window inside the block;
* ``attach_per_key`` a per-ticker row joined on ``(ticker, block)``, so that the
  join key of a hot ticker is spread as well; ``attach_spread`` does it by a hash.

The only windows over a whole ticker run on one row per bucket or block. Short and
long series take the same plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one (ticker, block) group: about 10 MB of feature rows.
BLOCK_ROWS = 65_536

# Time steps of one numbering bucket. A bar key is unique per (ticker, step), so
# a bucket holds at most this many rows.
BUCKET_STEPS = 8_192

# Parts of a hot key in a join without row numbers.
SPREAD = 16


def block_of(position: Column, block_rows: int = BLOCK_ROWS) -> Column:
    """Block index of a 1-based position."""
    return F.floor((position - F.lit(1)) / F.lit(block_rows))


def _time_bucket(df: DataFrame, order: str, step_seconds: int) -> Column:
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        step = F.unix_date(order)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        step = F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / F.lit(step_seconds))
    else:
        step = F.col(order)
    return F.floor(step / F.lit(BUCKET_STEPS))


def number_rows(
    df: DataFrame,
    key: Sequence[str] = ("ticker",),
    order: str = "dt",
    row: str = "rn",
    total: str = "n",
    previous: Mapping[str, str] | None = None,
    step_seconds: int = 3_600,
) -> DataFrame:
    """Add the row number within ``key`` by ``order`` and the row count of ``key``.

    ``(key, order)`` must be unique; a repeated one is an error. Counts per (key, time
    bucket) are combined before the shuffle; their running sum gives each bucket its
    first number, and the sort only sees one bucket at a time. ``previous`` adds
    ``{new: column}`` of the row before; a bucket's first row takes it from the last row
    of the bucket before. ``step_seconds`` is the bar length where ``order`` is a timestamp.
    """
    key, previous = list(key), dict(previous or {})
    bucketed = df.withColumn("_bucket", _time_bucket(df, order, step_seconds))
    by_bucket = Window.partitionBy(*key).orderBy("_bucket")
    starts = (
        bucketed.groupBy(*key, "_bucket")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.max_by(col, order).alias(f"_last_{new}") for new, col in previous.items()],
        )
        .select(
            *key,
            "_bucket",
            F.coalesce(
                F.sum("_rows").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(*key)).alias(total),
            *[F.lag(f"_last_{new}").over(by_bucket).alias(f"_last_{new}") for new in previous],
        )
    )
    inside = Window.partitionBy(*key, "_bucket").orderBy(order)
    numbered = bucketed.join(starts, [*key, "_bucket"]).withColumns(
        {
            "_place": F.when(
                F.lag(order).over(inside) == F.col(order),
                F.raise_error(F.lit(f"two rows with one ({', '.join(key)}, {order})")).cast("int"),
            ).otherwise(F.row_number().over(inside)),
            **{f"_prev_{new}": F.lag(col).over(inside) for new, col in previous.items()},
        }
    )
    return numbered.withColumns(
        {
            row: F.col("_place") + F.col("_before"),
            **{
                new: F.when(F.col("_place") == 1, F.col(f"_last_{new}")).otherwise(
                    F.col(f"_prev_{new}")
                )
                for new in previous
            },
        }
    ).drop(
        "_bucket",
        "_before",
        "_place",
        *[f"_last_{new}" for new in previous],
        *[f"_prev_{new}" for new in previous],
    )


def with_frames(
    df: DataFrame,
    before: int,
    after: int = 0,
    row: str = "rn",
    total: str = "n",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``block`` and ``own``, with copies of the rows a block's frames reach.

    A row belongs to the frame of every block that starts at most ``before`` rows
    after it or ends at most ``after`` rows ahead of it; ``own`` marks its home
    block. Of ``block_rows`` rows only ``before + after`` are copied.
    """
    zero_based = F.col(row) - F.lit(1)
    first = F.greatest(F.lit(0), F.floor((zero_based - F.lit(after)) / F.lit(block_rows)))
    last = F.least(
        block_of(F.col(total), block_rows),
        F.floor((zero_based + F.lit(before)) / F.lit(block_rows)),
    )
    return df.withColumn("block", F.explode(F.sequence(first, last))).withColumn(
        "own", F.col("block") == block_of(F.col(row), block_rows)
    )


def frame_window(row: str = "rn", key: Sequence[str] = ("ticker",)) -> WindowSpec:
    return Window.partitionBy(*key, "block").orderBy(row)


def running_totals(
    df: DataFrame,
    totals: dict[str, str],
    key: Sequence[str] = ("ticker",),
    row: str = "rn",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``{new: column}`` running sums within ``key`` by ``row``.

    Block sums are combined before the shuffle; the window over a whole series
    sees one row per block. A table that comes from a window over ``(key, block)``
    keeps its ``block`` column and is not exchanged again.
    """
    key = list(key)
    blocked = (
        df if "block" in df.columns else df.withColumn("block", block_of(F.col(row), block_rows))
    )
    earlier = (
        Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = blocked.groupBy(*key, "block").agg(
        *[F.sum(col).alias(f"_sum_{new}") for new, col in totals.items()]
    )
    starts = sums.select(
        *key,
        "block",
        *[
            F.coalesce(F.sum(f"_sum_{new}").over(earlier), F.lit(0.0)).alias(f"_from_{new}")
            for new in totals
        ],
    )
    inside = frame_window(row, key).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(starts, [*key, "block"])
        .withColumns(
            {new: F.col(f"_from_{new}") + F.sum(col).over(inside) for new, col in totals.items()}
        )
        .drop("block", *[f"_from_{new}" for new in totals])
    )


def attach_per_key(
    df: DataFrame,
    per_key: DataFrame,
    rows: str,
    key: Sequence[str] = ("ticker",),
    row: str = "rn",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner join of one row per ``key`` onto its series, on ``(key, block)``.

    ``per_key`` is repeated once per block (column ``rows`` holds the series
    length), so no join key has more than ``block_rows`` rows.
    """
    blocks = F.sequence(F.lit(0).cast("bigint"), block_of(F.col(rows), block_rows))
    spread = per_key.withColumn("_block", F.explode(blocks)).drop(rows)
    return (
        df.withColumn("_block", block_of(F.col(row), block_rows))
        .join(spread, [*key, "_block"])
        .drop("_block")
    )


def spread_of(by: str, parts: int = SPREAD) -> Column:
    """One of ``parts`` numbers, the same for equal values of ``by``."""
    return F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")


def attach_spread(
    df: DataFrame,
    per_key: DataFrame,
    key: Sequence[str],
    by: str,
    how: str = "inner",
    parts: int = SPREAD,
) -> DataFrame:
    """Join of one row per ``key`` where rows have no number: ``per_key`` is repeated
    ``parts`` times, and the rows of a hot key are spread over the parts by ``by``."""
    numbers = F.sequence(F.lit(0), F.lit(parts - 1))
    return (
        df.withColumn("_part", spread_of(by, parts))
        .join(per_key.withColumn("_part", F.explode(numbers)), [*key, "_part"], how)
        .drop("_part")
    )

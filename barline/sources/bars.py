"""Bar tables: from files with vendor headers, or built from single trades."""

from __future__ import annotations

import datetime as dtm
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions import null_if_nan

BAR_SCHEMA = (
    "ticker string, dt date, open double, high double, low double, close double, "
    "adj_close double, volume bigint"
)

# Vendor header -> canonical column.
VENDOR_HEADERS = {
    "Date": "dt",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}

LOOKBACK_DAYS = 365 * 4


def canonical_bars(
    df: DataFrame,
    ticker: str | Column | None = None,
    headers: Mapping[str, str] = VENDOR_HEADERS,
) -> DataFrame:
    """Rename, order and type the columns of a vendor table; NaN prices and volumes become NULL.

    ``ticker`` is a constant for one-asset files, or a column; by default the
    table's own ``ticker`` column (which may be a partition directory).
    """
    back = {new: old for old, new in headers.items() if old in df.columns}
    key = (
        F.col("ticker")
        if ticker is None
        else (ticker if isinstance(ticker, Column) else F.lit(ticker))
    )

    def source(name: str) -> Column:
        return F.col(f"`{back.get(name, name)}`")

    prices = ("open", "high", "low", "close", "adj_close")
    volume = source("volume")
    if isinstance(df.schema[back.get("volume", "volume")].dataType, (T.FloatType, T.DoubleType)):
        volume = F.when(F.abs(volume) < F.lit(2.0**63), volume)  # neither NaN nor infinite
    return df.select(
        key.cast("string").alias("ticker"),
        source("dt").cast("date").alias("dt"),
        *[null_if_nan(source(p).cast("double")).alias(p) for p in prices],
        volume.cast("bigint").alias("volume"),
    )


def read_bars(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    schema: str | None = None,
    ticker: str | None = None,
    **options: str,
) -> DataFrame:
    """Read bar files (parquet, ORC, CSV, JSON); text formats need ``schema``."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} bars need a schema")
    return canonical_bars(reader.load(paths if isinstance(paths, str) else list(paths)), ticker)


def known_trades(ticks: DataFrame) -> DataFrame:
    """Trades with NaN as NULL; ``seq`` is NULL where the price is, so it opens no bar."""
    floating = {f.name for f in ticks.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    price, qty = (
        null_if_nan(F.col(c).cast("double")) if c in floating else F.col(c) for c in ("price", "qty")
    )
    return ticks.withColumns(
        {"price": price, "qty": qty, "seq": F.when(price.isNotNull(), F.col("seq"))}
    )


def build_bars(
    ticks: DataFrame,
    period: Column,
    name: str = "dt",
    keys: Sequence[str] = ("ticker",),
) -> DataFrame:
    """Open, high, low, close and volume per ``keys`` and ``period``.

    ``ticks`` holds the keys, ``price``, ``qty`` and ``seq``; ``seq`` orders the
    trades of a period and should be a fixed-width type (see ``order_key``), so
    that the aggregate is hash-based and combines before the shuffle. A hot ticker
    then sends one row per period and task. A trade without a price (NULL or NaN) counts
    for the volume only, one without a quantity for the prices only.
    """
    return (
        known_trades(ticks)
        .groupBy(*keys, period.alias(name))
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("qty").cast("bigint").alias("volume"),
        )
        .select(*keys, name, "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume")
    )


def lookback(
    bars: DataFrame, as_of: dtm.date | str | Column, days: int = LOOKBACK_DAYS, column: str = "dt"
) -> DataFrame:
    """Bars of the ``days`` days before ``as_of``, which is excluded."""
    end = (as_of if isinstance(as_of, Column) else F.lit(str(as_of))).cast("date")
    return bars.where((F.col(column) >= F.date_sub(end, days)) & (F.col(column) < end))


def in_universe(bars: DataFrame, universe: DataFrame | Iterable[str]) -> DataFrame:
    """Bars of the listed tickers: a literal list, or a table with a ``ticker`` column."""
    if isinstance(universe, DataFrame):
        return bars.join(universe.select("ticker"), "ticker", "left_semi")
    return bars.where(F.col("ticker").isin(sorted(universe)))


def concat_bars(*parts: DataFrame) -> DataFrame:
    """All bars of several tables, matched by column name."""
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def distinct_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct()


def ticker_history(df: DataFrame, ticker: str, columns: Sequence[str]) -> DataFrame:
    """The chosen columns of one ticker; predicate and projection reach the scan."""
    return df.where(F.col("ticker") == F.lit(ticker)).select(*columns)

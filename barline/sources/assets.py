"""The asset dimension of the star schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Column -> type, in table order.
ASSET_COLUMNS = {
    "ticker": "string",
    "asset_name": "string",
    "region": "string",
    "market": "string",
    "description": "string",
    "asset_class": "string",
    "asset_subclass": "string",
    "sector": "string",
    "industry": "string",
    "source_ccy": "string",
    "model_ccy": "string",
    "borrow_rate": "double",
    "trade_fee": "double",
    "market_hours": "string",
    "default_window": "int",
    "critical_vol": "double",
    "enabled": "boolean",
}

ASSET_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ASSET_COLUMNS.items())

# The default portfolio (ticker, market, class, sector, currency,
# annual borrow rate, default window).
PORTFOLIO = (
    ("BIMBOA.MX", "BMV", "Acciones", "Consumer Defensive", "MXN", 0.015, 10),
    ("BTC-USD", "CCC", "Criptomonedas", "Tecnología Financiera", "BTC", 0.015, 10),
    ("GLD", "NYSE", "Materias Primas", "Metales Preciosos", "USD", 0.0075, 20),
    ("QQQ", "NASDAQ", "Acciones", "Multisectorial", "USD", 0.015, 10),
    ("SPY", "NYSE", "Acciones", "Multisectorial", "USD", 0.0075, 20),
    ("TLT", "NASDAQ", "Renta Fija", "Gobierno", "USD", 0.0075, 20),
    ("WALMEX.MX", "BMV", "Acciones", "Consumer Defensive", "MXN", 0.015, 10),
)


def asset_dimension(
    rows: DataFrame, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Any asset table in the dimension's columns and types.

    Text such as ``'10'`` is cast to its column type. ``defaults`` fills NULL or
    missing columns; an asset is enabled unless the table says otherwise. The ticker is
    the key: a repeated or NULL one is an error.
    """
    fill = {"enabled": True, **(defaults or {})}
    out = []
    for name, kind in ASSET_COLUMNS.items():
        value = F.col(name) if name in rows.columns else F.lit(None)
        out.append(F.coalesce(value.cast(kind), F.lit(fill.get(name)).cast(kind)).alias(name))
    same = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    broken = F.col("ticker").isNull() | (same > 1)
    key = F.when(broken, F.raise_error(F.lit("repeated or NULL ticker")).cast("string")).otherwise(
        F.col("ticker")
    )
    return rows.select(*out).withColumn("ticker", key)


def portfolio_dimension(spark: SparkSession, rows: Iterable[Sequence[Any]] = PORTFOLIO) -> DataFrame:
    """The default portfolio as a dimension table."""
    table = spark.createDataFrame(
        list(rows),
        "ticker string, market string, asset_class string, sector string, source_ccy string, "
        "borrow_rate double, default_window int",
    )
    return asset_dimension(table, {"model_ccy": "MXN", "trade_fee": 0.001, "critical_vol": 0.015})


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once or are NULL, with their row counts (empty = sound)."""
    missing = F.lit(False)
    for column in key:
        missing = missing | F.col(column).isNull()
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | missing)

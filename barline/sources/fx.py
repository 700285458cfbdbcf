"""Exchange-rate series: one row per date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import null_if_nan

FX_SCHEMA = "fx_dt date, fx_close double"


def daily_rates(quotes: DataFrame, date: Column, rate: Column) -> DataFrame:
    """``fx_dt, fx_close`` from any quote table; NaN rates become NULL."""
    return quotes.select(
        date.cast("date").alias("fx_dt"), null_if_nan(rate.cast("double")).alias("fx_close")
    )


def read_fx(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    date: str = "fx_dt",
    close: str = "fx_close",
    schema: str | None = None,
    **options: str,
) -> DataFrame:
    """Read date and close of a rate file; only these two columns are scanned."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    quotes = reader.load(paths if isinstance(paths, str) else list(paths))
    return daily_rates(quotes, F.col(f"`{date}`"), F.col(f"`{close}`"))

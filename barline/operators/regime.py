"""Volatility regime: which window length suits a ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import prefix_length

CRITICAL_VOL = 0.015


def chosen_window(avg_vol: Column, threshold: float = CRITICAL_VOL) -> Column:
    """10 for a volatile ticker, else 20 (also where the volatility is NULL or NaN)."""
    volatile = ~F.isnan(avg_vol) & (avg_vol >= F.lit(threshold))
    return F.when(volatile, F.lit(10)).otherwise(F.lit(20))


def training_atr() -> Column:
    """20-bar normalised ATR on the first 80 % of the ticker's rows, else NULL."""
    return F.when(F.col("rn") <= prefix_length(F.col("n")), F.col("atr_n_20"))


def volatility_regime(features: DataFrame, threshold: float = CRITICAL_VOL) -> DataFrame:
    """``ticker, avg_vol, win``: one pass, combined before the shuffle."""
    return (
        features.groupBy("ticker")
        .agg(F.avg(training_atr()).alias("avg_vol"))
        .withColumn("win", chosen_window(F.col("avg_vol"), threshold))
    )

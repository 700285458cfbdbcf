"""Partial aggregates per ticker and month, and measures under a date slicer.

A stored cube is the fact by month and one row per (ticker, month) with what the measures
need in a form that merges: sums, counts, count with mean and squared deviations, and the
values on the last date. A range takes whole months from these rows and only its first
and last month, where they are cut, from the fact: at most two months of rows are read,
however long the range is. The result is that of the measures over the fact's rows in it.
"""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators import measures

# Columns whose deviation the measures report.
_SPREAD = {"sd_net": "net_ret", "sd_bm": "bm_ret"}
_LAST = ("cum_net", "cum_bm")
_SUMS = ("gross_ret", *measures.COSTS)
_COUNTS = ("hits", "calls", "days_long", "days_cash", "days_short")


def partials(fact: DataFrame) -> DataFrame:
    """One row per (ticker, month) of a fact with one row per (ticker, dt).

    Rows combine before the shuffle, so a ticker with a third of them sends one row per
    month and task.
    """
    spread = {}
    for name, column in _SPREAD.items():
        spread[f"{name}_n"] = F.count(column)
        spread[f"{name}_mean"] = F.avg(column)
        spread[f"{name}_m2"] = F.var_pop(column) * F.count(column)
    return fact.groupBy("ticker", F.trunc("dt", "month").alias("month")).agg(
        F.max("dt").alias("last_dt"),
        *[F.max_by(c, "dt").alias(c) for c in _LAST],
        *[F.sum(c).alias(c) for c in _SUMS],
        *[measures.TALLY[c]().alias(c) for c in _COUNTS],
        *[value.alias(name) for name, value in spread.items()],
    )


def merged(parts: DataFrame) -> DataFrame:
    """Rows of ``partials`` to one row per ticker, as ``measures.ticker_summary``."""

    def deviation(name: str) -> Column:
        n, mean = F.col(f"{name}_n"), F.col(f"{name}_mean")
        rows, total = F.sum(n), F.sum(n * mean)
        # Within the parts, and between their means.
        squares = F.sum(f"{name}_m2") + F.sum(n * mean * mean) - total * total / rows
        return F.when(rows > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (rows - 1))).alias(name)

    return parts.groupBy("ticker").agg(
        *[F.max_by(c, "last_dt").alias(c) for c in _LAST],
        *[F.sum(c).alias(c) for c in (*_SUMS, *_COUNTS)],
        *[deviation(name) for name in _SPREAD],
    )


def store_cube(fact: DataFrame, path: str) -> None:
    """Write the fact and its partials under ``path``, by month.

    Months that are stored already are replaced by those of ``fact``, others stay: a
    day's new rows cost their month. Rows go to files by ranges of (month, ticker). A cube
    that never got a row cannot be read.
    """
    months = fact.withColumn("month", F.trunc("dt", "month"))
    _write(months.repartitionByRange("month", "ticker"), f"{path}/fact")
    _write(partials(fact).repartitionByRange("month", "ticker"), f"{path}/months")


def _write(rows: DataFrame, path: str) -> None:
    writer = rows.write.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path, mode="overwrite", partitionBy="month")


def _first_of(day: date) -> date:
    return day.replace(day=1)


def _last_of(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def cut_months(start: date | None, end: date | None) -> list[date]:
    """Months of which a range has some days only, by their first day."""
    cut = set()
    if start and start != _first_of(start):
        cut.add(_first_of(start))
    if end and end != _last_of(end):
        cut.add(_first_of(end))
    return sorted(cut)


def summary_between(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """``measures.ticker_summary`` of the stored rows from ``start`` to ``end``, both
    included; None leaves a side open. A range without rows, or that ends before it
    starts, gives an empty result."""
    cut = [F.lit(m) for m in cut_months(start, end)]
    month, dt = F.col("month"), F.col("dt")
    whole = spark.read.parquet(f"{path}/months").withColumn("month", month.cast("date"))
    if start:
        whole = whole.where(month >= F.lit(_first_of(start)))
    if end:
        whole = whole.where(month <= F.lit(_first_of(end)))
    if start and end and end < start:
        whole = whole.where("false")
    if not cut:
        return merged(whole)
    whole = whole.where(~month.isin(*cut))
    edge = spark.read.parquet(f"{path}/fact").where(month.isin(*cut))
    if start:
        edge = edge.where(dt >= F.lit(start))
    if end:
        edge = edge.where(dt <= F.lit(end))
    return merged(whole.unionByName(partials(edge)))


def kpi_scorecard_between(
    spark: SparkSession,
    path: str,
    dim: DataFrame,
    start: date | None = None,
    end: date | None = None,
    where: Column | str | None = None,
    investment: float = measures.INITIAL_INVESTMENT,
) -> DataFrame:
    """``measures.kpi_scorecard`` of the stored rows from ``start`` to ``end``."""
    summary = summary_between(spark, path, start, end)
    return measures.scorecard(measures.summarised(summary, dim, where), investment)


def perf_by_asset_between(
    spark: SparkSession,
    path: str,
    dim: DataFrame,
    start: date | None = None,
    end: date | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """``measures.perf_by_asset`` of the stored rows from ``start`` to ``end``."""
    summary = summary_between(spark, path, start, end)
    return measures.performance(measures.summarised(summary, dim, where))

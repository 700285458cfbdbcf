"""Market tables derived from the test tables (see FIXTURES.md), and the staged results.

Stages follow the batch: bars and rates, features, split rows, fact. Each is landed
once per session and data folder, as a nightly job would, and read by what follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import order_key
from barline.operators import indicators, labels, ledger
from barline.plans import land
from barline.plans.landing import new_path
from barline.sources import asset_dimension, build_bars, daily_rates, write_layout

CALM_TYPES = ("SMALL", "MEDIUM", "LARGE")

# p_type -> (class, sector, currency, borrow rate, default window)
ASSETS = {
    "ECONOMY": ("equity", "tech", "USD", 0.015, 10),
    "STANDARD": ("equity", "consumer", "USD", 0.015, 10),
    "PROMO": ("crypto", "tech", "MXN", 0.015, 10),
    "LARGE": ("equity", "consumer", "MXN", 0.0075, 20),
    "MEDIUM": ("commodity", "materials", "USD", 0.0075, 20),
    "SMALL": ("fixed_income", "government", "USD", 0.0075, 20),
}

_landed: dict[tuple[str, str, str], DataFrame] = {}


def staged(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _landed:
        _landed[key] = land(build(), name)
    return _landed[key]


def staged_as(
    spark: SparkSession, folder: str, name: str, write: Callable[[], DataFrame]
) -> DataFrame:
    """As ``staged``, for what lands itself."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _landed:
        _landed[key] = write()
    return _landed[key]


def forget_staged() -> None:
    """Make the next query build its stages again."""
    _landed.clear()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def narrow_ticker() -> Column:
    """The part type; LARGE and PROMO quote in local currency, in either case."""
    return (
        F.when(F.col("p_type") == "LARGE", F.lit("LARGE.MX"))
        .when(F.col("p_type") == "PROMO", F.lit("PROMO.mx"))
        .otherwise(F.col("p_type"))
    )


def wide_ticker() -> Column:
    return F.concat_ws("-", "p_brand", "p_type")


def trades(spark: SparkSession, folder: str, ticker: Column) -> DataFrame:
    """One trade per line item; order key, line number and price order a day's trades.

    A price is a whole number of 1/10000, so it can be part of the order key.
    """
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", ticker.alias("ticker"))
    swing = F.when(F.col("p_type").isin(*CALM_TYPES), F.lit(0.5)).otherwise(F.lit(20.0))
    unit = F.ln(F.col("l_extendedprice") / F.col("l_quantity"))
    line = F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("units", F.floor((F.lit(1000.0) + swing * unit) * 10_000 + F.lit(0.5)))
        .select(
            "ticker",
            F.col("l_shipdate").cast("date").alias("dt"),
            (F.col("units") / F.lit(10_000.0)).alias("price"),
            F.col("l_quantity").alias("qty"),
            order_key(line, F.col("units")).alias("seq"),
        )
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return build_bars(trades(spark, folder, narrow_ticker()), F.col("dt"))


def wide_bars(spark: SparkSession, folder: str) -> DataFrame:
    return build_bars(trades(spark, folder, wide_ticker()), F.col("dt"))


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as trades: the type is the ticker, the value the price."""
    return events.select(
        F.col("event_type").alias("ticker"),
        "ts",
        F.col("value").alias("price"),
        F.lit(1).alias("qty"),
        order_key(F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")).alias("seq"),
    )


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hourly_bars(spark: SparkSession, folder: str) -> DataFrame:
    ticks = event_ticks(table(spark, folder, "events"))
    return build_bars(ticks, hour_of(F.col("ts")), name="ts")


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """One rate per order date, missing on the first two days of every 37-day stretch."""
    day = F.col("o_orderdate").cast("date")
    quotes = (
        table(spark, folder, "orders")
        .groupBy(day.alias("day"))
        .agg(F.round(F.lit(17.0) + F.avg("o_totalprice") / F.lit(1e7), 6).alias("rate"))
    )
    missing = F.pmod(F.dayofyear("day"), F.lit(37)).isin(0, 1)
    return daily_rates(quotes, F.col("day"), F.when(~missing, F.col("rate")))


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """Traded assets from the part table, and one untraded index per region."""
    fields = ("asset_class", "sector", "source_ccy", "borrow_rate", "default_window")

    def attribute(position: int) -> Column:
        cases = F.lit(None)
        for kind, values in ASSETS.items():
            cases = F.when(F.col("p_type") == kind, F.lit(values[position])).otherwise(cases)
        return cases

    traded = (
        table(spark, folder, "part")
        .select("p_type")
        .distinct()
        .select(
            narrow_ticker().alias("ticker"),
            F.concat(F.lit("Asset "), F.col("p_type")).alias("asset_name"),
            *[attribute(i).alias(name) for i, name in enumerate(fields)],
        )
    )
    indices = table(spark, folder, "region").select(
        F.concat(F.lit("INDEX "), F.col("r_name")).alias("ticker"),
        F.concat(F.lit("Index "), F.col("r_name")).alias("asset_name"),
        F.lit("equity").alias("asset_class"),
        F.lit("index").alias("sector"),
        F.lit("USD").alias("source_ccy"),
        F.lit(0.015).alias("borrow_rate"),
        F.lit(20).alias("default_window"),
    )
    return asset_dimension(
        traded.unionByName(indices),
        {"model_ccy": "MXN", "trade_fee": 0.001, "critical_vol": 0.015},
    )


def arithmetic_scores(evaluation: DataFrame) -> DataFrame:
    """Three probabilities from the row number, in place of a model."""
    long = F.pmod(F.col("rn") * 37, F.lit(100)) / F.lit(100.0)
    short = (F.lit(1.0) - long) * (F.pmod(F.col("rn") * 53, F.lit(100)) / F.lit(100.0))
    return evaluation.withColumns(
        {"p_long": long, "p_short": short, "p_cash": F.lit(1.0) - long - short}
    )


# --- stages -----------------------------------------------------------------------


def staged_bars(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    if wide:
        return staged(spark, folder, "wide_bars", lambda: wide_bars(spark, folder))
    return staged(spark, folder, "bars", lambda: bars(spark, folder))


def staged_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The bars laid out for features (blocks of 1,000 bars)."""
    path = new_path(spark, "layout")
    return staged_as(
        spark,
        folder,
        "layout",
        lambda: write_layout(
            staged_bars(spark, folder),
            staged_rates(spark, folder),
            "layout_" + path.rsplit("-", 1)[1],
            path,
            block_rows=1_000,
        ),
    )


def staged_rates(spark: SparkSession, folder: str) -> DataFrame:
    return staged(spark, folder, "rates", lambda: rates(spark, folder))


def staged_assets(spark: SparkSession, folder: str) -> DataFrame:
    return staged(spark, folder, "assets", lambda: assets(spark, folder))


def staged_features(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    return staged(
        spark,
        folder,
        "wide_features" if wide else "features",
        lambda: indicators.master_features(
            staged_bars(spark, folder, wide), staged_rates(spark, folder)
        ),
    )


def staged_split(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    return staged(
        spark,
        folder,
        "wide_split" if wide else "split",
        lambda: labels.chrono_split(labels.label_rows(staged_features(spark, folder, wide))),
    )


def staged_fact(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    return staged(
        spark,
        folder,
        "wide_fact" if wide else "fact",
        lambda: ledger.strategy_fact(
            arithmetic_scores(ledger.evaluation_rows(staged_split(spark, folder, wide)))
        ),
    )

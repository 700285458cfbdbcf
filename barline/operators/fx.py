"""Currency normalisation: rate join, one-step gap fill, price conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.plans import asof_join, number_rows

PRICES = ("open", "high", "low", "close", "adj_close")
LOCAL_SUFFIX = ".MX"


def _dates_only(df: DataFrame, column: str) -> None:
    if not isinstance(df.schema[column].dataType, T.DateType):
        raise TypeError(f"{column} must be a DATE, not {df.schema[column].dataType.simpleString()}")


def _rates_by_date(fx: DataFrame) -> DataFrame:
    """One row per date; a second one is an error."""
    return fx.groupBy("fx_dt").agg(
        F.when(F.count(F.lit(1)) == 1, F.max("fx_close"))
        .otherwise(F.raise_error(F.lit("two FX rows on one date")).cast("double"))
        .alias("fx_close")
    )


def fx_join(bars: DataFrame, fx: DataFrame) -> DataFrame:
    """Add ``fx_close`` of the bar's date; bars on dates without a rate row are dropped.

    ``fx`` must have one row per date, and a second one is an error; both date columns
    must be of type DATE. That also bounds the broadcast: a DATE column has at most 3.65
    million values, whatever the number of bars.
    """
    _dates_only(bars, "dt")
    _dates_only(fx, "fx_dt")
    by_date = _rates_by_date(fx)
    return bars.join(F.broadcast(by_date), F.col("dt") == F.col("fx_dt")).drop("fx_dt")


def fx_lenders(bars: DataFrame, fx: DataFrame) -> DataFrame:
    """Per date without a rate, the rate at the latest previous bar of any ticker traded on it.

    The dates without a rate end stretches of dates, numbered on the rate table (one row
    per date). Bars combine to one row per (ticker, stretch) before the shuffle, and only
    those rows are put in order per ticker.
    """
    earlier = Window.orderBy("fx_dt").rowsBetween(Window.unboundedPreceding, -1)
    stretches = _rates_by_date(fx).withColumn(
        "_stretch", F.coalesce(F.count_if(F.col("fx_close").isNull()).over(earlier), F.lit(0))
    )
    known = F.when(F.col("fx_close").isNotNull(), F.col("dt"))
    ends = (
        bars.select("ticker", "dt")
        .join(F.broadcast(stretches), F.col("dt") == F.col("fx_dt"))
        .groupBy("ticker", "_stretch")
        .agg(
            F.max(known).alias("_last_dt"),
            F.max_by("fx_close", known).alias("_last_fx"),
            F.max(F.when(F.col("fx_close").isNull(), F.col("dt"))).alias("_last_gap"),
        )
    )
    series = Window.partitionBy("ticker").orderBy("_stretch")
    # The bar before a gap is in its own stretch, or ends the ticker's stretch before;
    # one that itself has no rate lends nothing.
    before = ends.withColumns(
        {f"_before_{c}": F.lag(f"_last_{c}").over(series) for c in ("dt", "fx", "gap")}
    )
    own, lends = F.col("_last_dt").isNotNull(), F.col("_before_gap").isNull()
    return (
        before.where(F.col("_last_gap").isNotNull())
        .select(
            F.col("_last_gap").alias("dt"),
            *[
                F.when(own, F.col(f"_last_{c}")).when(lends, F.col(f"_before_{c}")).alias(f"_{c}")
                for c in ("dt", "fx")
            ],
        )
        .where(F.col("_fx").isNotNull())
        .groupBy("dt")
        .agg(F.max_by("_fx", "_dt").alias("_lent"))
    )


def fx_fill(bars: DataFrame, fx: DataFrame) -> DataFrame:
    """Join the rates; fill a missing one with that at the ticker's previous bar, one step only.

    The step reads the unfilled column, so a second missing rate in a row stays
    missing for that ticker. Where the ticker has no such rate, another ticker
    without a rate on that date may lend its own: the one with the latest
    previous bar. The rows come back numbered (``rn`` of ``n``).

    The lenders are one row per date, hence the broadcast (see ``fx_join``).
    """
    numbered = number_rows(fx_join(bars, fx), previous={"_prev_fx": "fx_close"})
    return (
        numbered.join(F.broadcast(fx_lenders(bars, fx)), "dt", "left")
        .withColumn("fx_close", F.coalesce("fx_close", "_prev_fx", "_lent"))
        .drop("_prev_fx", "_lent")
    )


def fx_asof(bars: DataFrame, fx: DataFrame, staleness: int | None = None) -> DataFrame:
    """Add ``fx_close``, the last known rate at or before the bar's date, and ``fx_close_at``.

    ``staleness`` is how many days old it may be (default: any). Unlike ``fx_fill`` no bar is
    dropped: one on a date without a rate row takes the rate before, one before the first
    rate has NULL. The dates of the bars, of which a DATE column has at most 3.65 million, meet
    the rates; bars then join by date.
    """
    _dates_only(bars, "dt")
    _dates_only(fx, "fx_dt")
    dates = bars.select("dt").where(F.col("dt").isNotNull()).distinct()
    rates = _rates_by_date(fx).withColumnRenamed("fx_dt", "dt")
    dated = asof_join(dates, rates, [], "dt", "fx_close", staleness=staleness)
    return bars.join(F.broadcast(dated), "dt", "left")


def fx_convert(df: DataFrame, local_suffix: str = LOCAL_SUFFIX) -> DataFrame:
    """Prices in the model currency; tickers with the local suffix (any case) stay as they are."""
    local = F.col("ticker").ilike(f"%{local_suffix}")
    return df.withColumns(
        {p: F.when(local, F.col(p)).otherwise(F.col(p) * F.col("fx_close")) for p in PRICES}
    )

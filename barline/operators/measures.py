"""Star-schema measures and the tables behind the dashboard views.

Every measure takes the strategy fact and the asset dimension; ``where`` is the
filter context, a condition on the dimension's columns. The dimension side of a
join is left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import safe_div
from barline.functions.expr import TRADING_DAYS

INITIAL_INVESTMENT = 100_000.0
TENDENCY_BARS = 5
COSTS = ("fee", "interest", "borrow")
# Class and sector of traded assets that the dimension lacks.
UNKNOWN = "(unknown)"


def filtered(dim: DataFrame, where: Column | str | None = None) -> DataFrame:
    """The dimension under a filter context (asset, sector, class)."""
    return dim if where is None else dim.where(where)


def _known(dim: DataFrame) -> DataFrame:
    return dim.withColumn("_known", F.lit(True))


def _named(joined: DataFrame) -> DataFrame:
    """Class and sector of rows that found no asset."""
    return joined.withColumns(
        {
            c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(UNKNOWN))
            for c in ("asset_class", "sector")
        }
    ).drop("_known")


def star_join(fact: DataFrame, dim: DataFrame, where: Column | str | None = None) -> DataFrame:
    """Fact rows with class and sector of the assets in context.

    Without a filter, rows of assets that the dimension lacks stay, as ``UNKNOWN``.
    """
    context = filtered(dim, where).select("ticker", "asset_class", "sector")
    if where is not None:
        return fact.join(context, "ticker")
    return _named(fact.join(_known(context), "ticker", "left"))


def _hits() -> Column:
    """Rows whose position had the sign of the benchmark return."""
    return F.count_if(
        ((F.col("pos") == 1) & (F.col("bm_ret") > 0))
        | ((F.col("pos") == -1) & (F.col("bm_ret") < 0))
    )


def _calls() -> Column:
    return F.count_if(F.col("pos") != 0)


# Counts per ticker, by name.
TALLY = {
    "hits": _hits,
    "calls": _calls,
    "days_long": lambda: F.count_if(F.col("pos") == 1),
    "days_cash": lambda: F.count_if(F.col("pos") == 0),
    "days_short": lambda: F.count_if(F.col("pos") == -1),
}


def last_values(fact: DataFrame) -> DataFrame:
    """Cumulated returns per ticker on its last date; the larger one if that date occurs twice.

    Rows meet the last dates on (ticker, date), so a hot ticker stays spread.
    """
    last = fact.groupBy("ticker").agg(F.max("dt").alias("dt"))
    return (
        fact.select("ticker", "dt", "cum_net", "cum_bm")
        .join(last, ["ticker", "dt"], "left_semi")
        .groupBy("ticker")
        .agg(F.max("cum_net").alias("cum_net"), F.max("cum_bm").alias("cum_bm"))
    )


def ticker_summary(fact: DataFrame) -> DataFrame:
    """Everything the measures need per ticker; all aggregates are fixed-width and hashed.

    Where the fact numbers its rows, the last values come with the sums, in one pass.
    """
    numbered = "rn" in fact.columns
    last = [F.max_by(c, "rn").alias(c) for c in ("cum_net", "cum_bm")] if numbered else []
    sums = fact.groupBy("ticker").agg(
        *last,
        F.sum("gross_ret").alias("gross_ret"),
        *[F.sum(c).alias(c) for c in COSTS],
        *[count().alias(name) for name, count in TALLY.items()],
        F.stddev_samp("net_ret").alias("sd_net"),
        F.stddev_samp("bm_ret").alias("sd_bm"),
    )
    return sums if numbered else sums.join(last_values(fact), "ticker")


def asset_summary(fact: DataFrame, dim: DataFrame, where: Column | str | None = None) -> DataFrame:
    """One row per asset in context, traded or not, with its measures (NULL if never traded).

    Without a filter, traded assets that the dimension lacks have a row as well.
    """
    return summarised(ticker_summary(fact), dim, where)


def summarised(
    summary: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Rows of ``ticker_summary`` beside the assets in context, as ``asset_summary``."""
    if where is not None:
        return filtered(dim, where).join(summary, "ticker", "left")
    return _named(_known(dim).join(summary, "ticker", "full"))


def accuracy(hits: Column, calls: Column) -> Column:
    return F.coalesce(safe_div(hits.cast("double"), calls.cast("double")), F.lit(0.0))


def money(investment: float = INITIAL_INVESTMENT) -> dict[str, Column]:
    """Gross gain, cost parts, total cost and net gain of a summary row on ``investment``."""
    amount = F.lit(investment)
    gross = amount * (F.exp("gross_ret") - F.lit(1.0))
    total = amount * (F.col("fee") + F.col("interest") + F.col("borrow"))
    return {
        "gross_money": gross,
        **{f"{c}_money": amount * F.col(c) for c in COSTS},
        "total_cost": total,
        "net_money": gross - total,
    }


def kpi_scorecard(
    fact: DataFrame,
    dim: DataFrame,
    where: Column | str | None = None,
    investment: float = INITIAL_INVESTMENT,
) -> DataFrame:
    """One row: summed returns and alpha, accuracy, money and costs."""
    return scorecard(asset_summary(fact, dim, where), investment)


def scorecard(assets: DataFrame, investment: float = INITIAL_INVESTMENT) -> DataFrame:
    """The scorecard of rows of ``asset_summary``."""
    return assets.withColumns(money(investment)).agg(
        F.sum("cum_net").alias("cum_net"),
        F.sum("cum_bm").alias("cum_bm"),
        (F.sum("cum_net") - F.sum("cum_bm")).alias("alpha"),
        accuracy(F.sum("hits"), F.sum("calls")).alias("accuracy"),
        F.sum("gross_money").alias("gross_money"),
        F.sum("total_cost").alias("total_cost"),
        F.sum("net_money").alias("net_money"),
    )


def directional_accuracy(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Correct calls over calls; 0 if the strategy never left cash."""
    return star_join(fact, dim, where).agg(
        _calls().alias("calls"), _hits().alias("hits"), accuracy(_hits(), _calls()).alias("accuracy")
    )


def equity_curve(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Summed cumulated returns by date: overall, by class, by sector and by ticker.

    ``scope`` names the slice; the columns it does not use are NULL. The fact has one row
    per date and ticker, which is the ticker slice and needs no class or sector; the others
    come from its sums by date, class and sector, so no row is multiplied.
    """
    rows = star_join(fact, dim, where)
    curves = ("cum_net", "cum_bm")
    sums = rows.groupBy("dt", "asset_class", "sector").agg(*[F.sum(c).alias(c) for c in curves])
    slices = [["dt"], ["dt", "asset_class"], ["dt", "sector"]]
    scope = (
        F.when(F.grouping("sector") == 0, F.lit("sector"))
        .when(F.grouping("asset_class") == 0, F.lit("asset_class"))
        .otherwise(F.lit("all"))
    )
    none = F.lit(None).cast("string")
    grouped = sums.groupingSets(
        [[F.col(c) for c in s] for s in slices], "dt", "asset_class", "sector"
    ).agg(scope.alias("scope"), *[F.sum(c).alias(c) for c in curves])
    single = fact
    if where is not None:
        single = fact.join(filtered(dim, where).select("ticker"), "ticker", "left_semi")
    by_ticker = single.select(
        "dt",
        none.alias("asset_class"),
        none.alias("sector"),
        F.lit("ticker").alias("scope"),
        *curves,
        "ticker",
    )
    return (
        grouped.withColumn("ticker", none)
        .unionByName(by_ticker)
        .select("dt", "asset_class", "sector", "ticker", "scope", *curves)
    )


def latest_signal(
    fact: DataFrame,
    bars: int = TENDENCY_BARS,
    dim: DataFrame | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Last position and leverage per ticker, and the sign of its recent mean return.

    Row numbers come with the fact, so the last rows are a condition, not a window. The
    last row is that of the largest number present. ``where`` filters ``dim``.
    """
    if where is not None:
        fact = fact.join(filtered(dim, where).select("ticker"), "ticker", "left_semi")
    recent = F.when(F.col("rn") > F.col("n") - F.lit(bars), F.col("bm_ret"))
    return fact.groupBy("ticker").agg(
        *[F.max_by(c, "rn").alias(c) for c in ("dt", "pos", "lev")],
        F.signum(F.avg(recent)).cast("int").alias("tendency"),
    )


def perf_by_asset(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Returns, alpha, annualised volatility, accuracy and position days per asset."""
    return performance(asset_summary(fact, dim, where))


def performance(assets: DataFrame) -> DataFrame:
    """The performance table of rows of ``asset_summary``."""
    year = F.sqrt(F.lit(float(TRADING_DAYS)))
    return assets.select(
        "ticker",
        "asset_class",
        "cum_net",
        "cum_bm",
        (F.col("cum_net") - F.col("cum_bm")).alias("alpha"),
        (F.col("sd_net") * year).alias("vol_net"),
        (F.col("sd_bm") * year).alias("vol_bm"),
        accuracy(F.col("hits"), F.col("calls")).alias("accuracy"),
        "days_long",
        "days_cash",
        "days_short",
    )


def alpha_by_class(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    return (
        asset_summary(fact, dim, where)
        .groupBy("asset_class")
        .agg(
            F.sum("cum_net").alias("cum_net"),
            F.sum("cum_bm").alias("cum_bm"),
            (F.sum("cum_net") - F.sum("cum_bm")).alias("alpha"),
        )
    )


def leverage_curve(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Mean leverage beside the summed curves, by date."""
    return (
        star_join(fact, dim, where)
        .groupBy("dt")
        .agg(
            F.avg("lev").alias("avg_lev"),
            F.sum("cum_net").alias("cum_net"),
            F.sum("cum_bm").alias("cum_bm"),
        )
    )


def position_tally(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """Days short, in cash and long: per ticker and overall (NULL ticker)."""
    return (
        star_join(fact, dim, where)
        .rollup("ticker")
        .agg(
            F.count_if(F.col("pos") == -1).alias("days_short"),
            F.count_if(F.col("pos") == 0).alias("days_cash"),
            F.count_if(F.col("pos") == 1).alias("days_long"),
            F.count(F.lit(1)).alias("days"),
        )
    )


def cost_impact(
    fact: DataFrame,
    dim: DataFrame,
    where: Column | str | None = None,
    investment: float = INITIAL_INVESTMENT,
) -> DataFrame:
    """Gross gain, cost parts and net gain per asset, with class subtotals and a grand total."""
    amounts = money(investment)
    return (
        star_join(ticker_summary(fact), dim, where)
        .withColumns(amounts)
        .rollup("asset_class", "ticker")
        .agg(*[F.sum(name).alias(name) for name in amounts])
    )


def best_asset(
    fact: DataFrame, dim: DataFrame, where: Column | str | None = None
) -> DataFrame:
    """The asset with the largest alpha (first by name on a tie)."""
    return (
        perf_by_asset(fact, dim, where)
        .select("ticker", "cum_net", "cum_bm", "alpha")
        .where(F.col("alpha").isNotNull())
        .orderBy(F.desc("alpha"), "ticker")
        .limit(1)
    )

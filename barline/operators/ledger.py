"""The return ledger: positions, leverage, costs, net and cumulative returns.

It takes any table of scores; no model is needed to run it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import argmax3, daily_rate
from barline.operators.regime import CRITICAL_VOL
from barline.plans import BLOCK_ROWS, frame_window, land, running_totals, with_frames

TRADE_FEE = 0.001
MARGIN_RATE = 0.06
BORROW_RATE_CALM = 0.0075
BORROW_RATE_VOLATILE = 0.015
EVEN_ODDS = 1.0 / 3.0

FACT_COLUMNS = (
    "dt",
    "ticker",
    "pos",
    "lev",
    "net_ret",
    "bm_ret",
    "cum_net",
    "cum_bm",
    "gross_ret",
    "fee",
    "interest",
    "borrow",
)


def evaluation_rows(split_rows: DataFrame) -> DataFrame:
    """Test rows that have a sample, numbered by ``rn`` of ``n``, with unscaled ADX and return.

    A row's return pairs with the sample whose window ends on the row before.
    """
    return split_rows.where(
        (F.col("split") == "test") & (F.col("split_rn") > F.col("win"))
    ).select(
        "ticker",
        "dt",
        (F.col("split_rn") - F.col("win")).alias("rn"),
        (F.col("split_n") - F.col("win")).alias("n"),
        F.col("log_ret").alias("bm_ret"),
        F.col("adx_n").alias("adx"),
        "avg_vol",
    )


def with_scores(evaluation: DataFrame, scores: DataFrame) -> DataFrame:
    """Evaluation rows with ``p_short, p_cash, p_long`` of the same ticker and date.

    A row without scores stays in cash (0, 1, 0): no row is lost and ``rn`` keeps its order.
    A second row of scores for one (ticker, dt) is an error. The check is an aggregate on the
    keys of the join, which shuffles the scores on them in any case.
    """
    repeated = F.raise_error(F.lit("two rows of scores with one (ticker, dt)")).cast("double")
    single = scores.groupBy("ticker", "dt").agg(
        *[
            F.when(F.count(F.lit(1)) == 1, F.max(name)).otherwise(repeated).alias(name)
            for name in ("p_short", "p_cash", "p_long")
        ]
    )
    joined = evaluation.join(single, ["ticker", "dt"], "left")
    unscored = F.col("p_short").isNull() | F.col("p_cash").isNull() | F.col("p_long").isNull()
    cash = {"p_short": 0.0, "p_cash": 1.0, "p_long": 0.0}
    return joined.withColumns(
        {name: F.when(unscored, F.lit(p)).otherwise(F.col(name)) for name, p in cash.items()}
    )


def leverage(p_long: Column, adx: Column) -> Column:
    """1 to 2 by the score's distance from even odds and the trend strength.

    The order of the branches matters; a distance of 0.15 to 0.2 in a weak trend
    falls through to 1.
    """
    distance = F.abs(p_long - F.lit(EVEN_ODDS))
    strong = adx >= 0.25
    far = distance >= 0.2
    middle = (distance >= 0.15) & (distance < 0.2)
    near = (distance >= 0.05) & (distance < 0.15)
    return (
        F.when(far & strong, F.lit(2.0))
        .when((middle & strong) | (far & (adx < 0.25)), F.lit(1.5))
        .when(near, F.lit(1.25))
        .otherwise(F.lit(1.0))
    )


def positions(scored: DataFrame) -> DataFrame:
    """Add ``pos`` (-1, 0, 1) and ``lev``; leverage is set for cash rows too."""
    return scored.withColumns(
        {
            "pos": argmax3(F.col("p_short"), F.col("p_cash"), F.col("p_long")),
            "lev": leverage(F.col("p_long"), F.col("adx")),
        }
    )


def cost_columns(
    positioned: DataFrame,
    trade_fee: float = TRADE_FEE,
    margin_rate: float = MARGIN_RATE,
    calm_rate: float = BORROW_RATE_CALM,
    volatile_rate: float = BORROW_RATE_VOLATILE,
    threshold: float = CRITICAL_VOL,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``fee`` (any position change; none on the first row), ``interest`` and ``borrow``.

    All three scale with the leverage; a ticker without a known volatility pays
    the volatile rate. The ``block`` of the frames stays for the running sums.
    """
    framed = with_frames(positioned, before=1, block_rows=block_rows)
    previous = F.coalesce(F.lag("pos").over(frame_window()), F.col("pos"))
    rate = F.when(F.col("avg_vol") < F.lit(threshold), F.lit(calm_rate)).otherwise(
        F.lit(volatile_rate)
    )
    none = F.lit(0.0)
    return (
        framed.withColumn("_previous", previous)
        .where("own")
        .withColumns(
            {
                "fee": F.when(
                    F.col("pos") != F.col("_previous"), F.lit(trade_fee) * F.col("lev")
                ).otherwise(none),
                "interest": F.when(
                    F.col("pos") != 0, (F.col("lev") - 1.0) * daily_rate(margin_rate)
                ).otherwise(none),
                "borrow": F.when(F.col("pos") == -1, F.col("lev") * daily_rate(rate)).otherwise(
                    none
                ),
            }
        )
        .drop("_previous", "own")
    )


def strategy_fact(scored: DataFrame, block_rows: int = BLOCK_ROWS, **costs: float) -> DataFrame:
    """The fact table: one row per ticker and date, with its cost parts kept."""
    ledger = cost_columns(positions(scored), block_rows=block_rows, **costs).withColumn(
        "gross_ret", F.col("pos") * F.col("bm_ret") * F.col("lev")
    )
    ledger = ledger.withColumn(
        "net_ret", F.col("gross_ret") - F.col("fee") - F.col("interest") - F.col("borrow")
    )
    # Block sums and rows both read it: the positions and frames are worked out once.
    ledger = land(ledger, "ledger")
    summed = running_totals(
        ledger, {"_sum_net": "net_ret", "_sum_bm": "bm_ret"}, block_rows=block_rows
    )
    return summed.withColumns(
        {
            "cum_net": F.exp("_sum_net") - F.lit(1.0),
            "cum_bm": F.exp("_sum_bm") - F.lit(1.0),
        }
    ).select(*FACT_COLUMNS, "rn", "n")

"""Three-class labels, clean rows and the chronological split.

Two facts about a ticker's whole history are needed in every block: ticker
totals (regime, band, row counts) and the last five known returns before the
block. Both come from one summary row per (ticker, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions import prefix_length, safe_div
from barline.operators.indicators import FAMILIES
from barline.operators.regime import CRITICAL_VOL, chosen_window, training_atr
from barline.plans import BLOCK_ROWS, block_of, frame_window

BASELINE_BARS = 5
BAND_SHARE = 0.15


def three_class(ret: Column, baseline: Column, band: Column) -> Column:
    """1 above the band around the baseline, -1 below it, else 0 (also where unknown)."""
    return (
        F.when(ret > baseline + band, F.lit(1))
        .when(ret < baseline - band, F.lit(-1))
        .otherwise(F.lit(0))
    )


def _known_returns() -> Window:
    """Rows of a block with a return (and, apart, those without) in time order."""
    return Window.partitionBy("ticker", "block", F.col("log_ret").isNotNull()).orderBy("rn")


def _usable(k: int) -> Column:
    """Row past the warm-up of window ``k``, with all its features (not NaN) and a next row."""
    complete = (F.col("rn") >= k) & (F.col("rn") < F.col("n"))
    for name in ("log_ret", *[f"{family}_{k}" for family in FAMILIES]):
        complete = complete & F.col(name).isNotNull() & ~F.isnan(name)
    return complete


def _last(values: Column, count: int) -> Column:
    return F.when(F.size(values) <= count, values).otherwise(F.slice(values, -count, count))


def _block_summary(blocked: DataFrame) -> DataFrame:
    """Sums and counts per (ticker, block), and the block's last known returns."""
    w = _known_returns()
    recent = [F.lag("log_ret", back).over(w) for back in range(BASELINE_BARS - 1, 0, -1)]
    known = F.col("log_ret").isNotNull()
    per_window = []
    for k in (10, 20):
        atr = F.when(F.col("rn") >= k, F.col(f"atr_n_{k}"))
        per_window += [
            F.sum(atr).alias(f"atr_sum_{k}"),
            F.count(atr).alias(f"atr_rows_{k}"),
            F.count_if(_usable(k)).alias(f"usable_{k}"),
        ]
    return (
        blocked.withColumn("_recent", F.array_compact(F.array(*recent, F.col("log_ret"))))
        .groupBy("ticker", "block")
        .agg(
            F.sum(training_atr()).alias("vol_sum"),
            F.count(training_atr()).alias("vol_rows"),
            *per_window,
            F.max_by(F.when(known, F.col("_recent")), F.when(known, F.col("rn"))).alias("tail"),
        )
    )


def _block_facts(blocked: DataFrame, threshold: float, band_share: float) -> DataFrame:
    """Per (ticker, block): regime, band, usable-row numbers, sums of the last 1..5 returns before."""
    ticker = Window.partitionBy("ticker")
    earlier = ticker.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    with_tail = Window.partitionBy("ticker", F.col("tail").isNotNull()).orderBy("block")
    summary = _block_summary(blocked)
    # each block with a tail adds at least one return, so five of them suffice
    tails = F.collect_list("tail").over(with_tail.rowsBetween(1 - BASELINE_BARS, 0))
    summary = summary.withColumn(
        "_after", F.when(F.col("tail").isNotNull(), _last(F.flatten(tails), BASELINE_BARS))
    )
    totals = ("vol_sum", "vol_rows", "atr_sum_10", "atr_rows_10", "atr_sum_20", "atr_rows_20")
    summary = summary.withColumns(
        {
            **{f"_{c}": F.sum(c).over(ticker) for c in totals},
            **{f"_usable_{k}": F.sum(f"usable_{k}").over(ticker) for k in (10, 20)},
            **{
                f"_before_{k}": F.coalesce(F.sum(f"usable_{k}").over(earlier), F.lit(0))
                for k in (10, 20)
            },
            "_head": F.last("_after", ignorenulls=True).over(earlier),
        }
    )
    avg_vol = safe_div(F.col("_vol_sum"), F.col("_vol_rows").cast("double"))
    volatile = F.col("win") == 10

    def by_window(name: str) -> Column:
        return F.when(volatile, F.col(f"{name}_10")).otherwise(F.col(f"{name}_20"))

    def last_sum(count: int) -> Column:
        values = F.slice("_head", -count, count)
        return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)

    head_sums = [
        F.when(F.size("_head") >= count, last_sum(count)) for count in range(1, BASELINE_BARS + 1)
    ]
    return (
        summary.withColumn("avg_vol", avg_vol)
        .withColumn("win", chosen_window(F.col("avg_vol"), threshold))
        .select(
            "ticker",
            "block",
            "avg_vol",
            "win",
            (
                F.lit(band_share)
                * safe_div(by_window("_atr_sum"), by_window("_atr_rows").cast("double"))
            ).alias("band"),
            by_window("_usable").alias("clean_n"),
            by_window("_before").alias("_clean_before"),
            F.array(*head_sums).alias("_head_sums"),
        )
    )


def label_rows(
    features: DataFrame,
    threshold: float = CRITICAL_VOL,
    band_share: float = BAND_SHARE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows past the warm-up with the chosen window's features, label and next label.

    The baseline is the mean of the ticker's previous five known returns; it may
    reach any distance back, so the first rows of a block add the last returns
    before the block to their own. The next label is this row's own five returns
    against the next bar's return. ``clean`` marks rows without NULLs, numbered by
    ``clean_rn`` of ``clean_n``.

    ``features`` is read twice (summary and rows): pass a landed table.
    """
    # one exchange on (ticker, block) serves every window and the join below; left to the
    # first window, which also splits by known returns, it would take a second one
    blocked = features.withColumn("block", block_of(F.col("rn"), block_rows)).repartition(
        "ticker", "block"
    )
    facts = _block_facts(blocked, threshold, band_share)
    w = frame_window()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    last_five = _known_returns().rowsBetween(1 - BASELINE_BARS, 0)
    known = F.col("log_ret").isNotNull()
    volatile = F.col("win") == 10

    rows = blocked.join(facts, ["ticker", "block"]).withColumns(
        {
            "_sum": F.sum("log_ret").over(last_five),
            "_have": F.count("log_ret").over(last_five).cast("int"),
        }
    )
    mean_here = F.when(
        known,
        (
            F.col("_sum")
            + F.when(F.col("_have") == BASELINE_BARS, F.lit(0.0)).otherwise(
                F.get("_head_sums", F.lit(BASELINE_BARS - 1) - F.col("_have"))
            )
        )
        / F.lit(float(BASELINE_BARS)),
    )
    mean_before_block = F.get("_head_sums", F.lit(BASELINE_BARS - 1)) / F.lit(float(BASELINE_BARS))
    usable = F.when(volatile, _usable(10)).otherwise(_usable(20))
    rows = (
        rows.withColumns({"_mean": mean_here, "clean": usable})
        .withColumns(
            {
                "_mean5": F.coalesce(
                    F.last("_mean", ignorenulls=True).over(so_far), mean_before_block
                ),
                "clean_rn": F.col("_clean_before")
                + F.sum(F.col("clean").cast("bigint")).over(so_far),
            }
        )
        .withColumn("_prev5", F.lag("_mean5").over(w))
    )
    opens_block = F.pmod(F.col("rn") - F.lit(1), F.lit(block_rows)) == 0
    baseline = F.when(
        known, F.when(opens_block, mean_before_block).otherwise(F.col("_prev5"))
    )
    return (
        rows.where(F.col("rn") >= F.col("win"))
        .withColumn("ma5", baseline)
        .select(
            "ticker",
            "dt",
            "rn",
            "n",
            "win",
            "avg_vol",
            "band",
            "log_ret",
            *[
                F.when(volatile, F.col(f"{f}_10")).otherwise(F.col(f"{f}_20")).alias(f)
                for f in FAMILIES
            ],
            "ma5",
            three_class(F.col("log_ret"), F.col("ma5"), F.col("band")).alias("label"),
            F.when(
                F.col("rn") < F.col("n"),
                three_class(F.col("next_ret"), F.col("_mean5"), F.col("band")),
            ).alias("label_next"),
            "clean",
            "clean_rn",
            "clean_n",
        )
    )


def chrono_split(labelled: DataFrame) -> DataFrame:
    """Clean rows with ``split`` (first 80 % of the ticker: train) and their number within it."""
    cut = prefix_length(F.col("clean_n"))
    in_train = F.col("clean_rn") <= cut
    return (
        labelled.where("clean")
        .drop("clean")
        .withColumns(
            {
                "split": F.when(in_train, F.lit("train")).otherwise(F.lit("test")),
                "split_rn": F.when(in_train, F.col("clean_rn")).otherwise(F.col("clean_rn") - cut),
                "split_n": F.when(in_train, cut).otherwise(F.col("clean_n") - cut),
            }
        )
    )

"""Rolling technical features over 20 and 10 bars.

All features share one window specification, ``(ticker, block)`` by date: one
exchange and one sort serve the lags, the rolling means and the mean of the
rolling directional index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import population_std, safe_div
from barline.operators.fx import fx_convert, fx_fill
from barline.plans import BLOCK_ROWS, frame_window, rolling_means, with_frames

WINDOWS = (20, 10)
FAMILIES = ("ma", "rv", "vol_z", "atr_n", "rsi_n", "adx_n")


def feature_columns(windows: Sequence[int] = WINDOWS) -> list[str]:
    return ["log_ret", *[f"{f}_{w}" for f in FAMILIES for w in windows]]


# --- formulas on columns -------------------------------------------------------


def log_return(close: Column, prev_close: Column) -> Column:
    return F.ln(safe_div(close, prev_close))


def true_range(high: Column, low: Column, prev_close: Column) -> Column:
    """Largest of high-low, |high-previous close| and |low-previous close|.

    Without a previous close it is NULL (``greatest`` would skip the NULLs).
    """
    spread, up, down = high - low, F.abs(high - prev_close), F.abs(low - prev_close)
    return (
        F.when((spread >= up) & (spread >= down), spread)
        .when((up >= spread) & (up >= down), up)
        .otherwise(down)
    )


def gain(diff: Column) -> Column:
    return F.when(diff > 0, diff).otherwise(F.lit(0.0))


def loss(diff: Column) -> Column:
    return F.when(diff < 0, -diff).otherwise(F.lit(0.0))


def dominant_move(move: Column, other: Column) -> Column:
    """``move`` where it is positive and beats the opposite move, else 0."""
    return F.when((move > other) & (move > 0), move).otherwise(F.lit(0.0))


def relative_strength(mean_gain: Column, mean_loss: Column) -> Column:
    """RSI scaled to 0..1; 1 without any loss."""
    ratio = safe_div(mean_gain, mean_loss)
    return F.when(mean_loss == 0, F.lit(1.0)).otherwise(
        (F.lit(100.0) - safe_div(F.lit(100.0), F.lit(1.0) + ratio)) / F.lit(100.0)
    )


def directional_indicator(mean_move: Column, atr: Column) -> Column:
    return F.when(atr == 0, F.lit(0.0)).otherwise(safe_div(mean_move, atr) * F.lit(100.0))


def directional_index(di_pos: Column, di_neg: Column) -> Column:
    total = di_pos + di_neg
    return F.when(total == 0, F.lit(0.0)).otherwise(
        F.abs(safe_div(di_pos - di_neg, total)) * F.lit(100.0)
    )


# --- steps on a framed table ----------------------------------------------------


def look_back(windows: Sequence[int] = WINDOWS) -> int:
    """Earlier rows a feature depends on: a mean of means, and the close before."""
    return 2 * (max(windows) - 1) + 1


def priced_frames(
    bars: DataFrame,
    fx: DataFrame,
    windows: Sequence[int] = WINDOWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Bars with a rate, filled, converted to the model currency, numbered and framed."""
    return with_frames(
        fx_convert(fx_fill(bars, fx)), before=look_back(windows), after=1, block_rows=block_rows
    )


def daily_terms(framed: DataFrame) -> DataFrame:
    """Per-bar inputs of the rolling means: return, true range, gain, loss, moves."""
    w = frame_window("dt")
    lagged = framed.withColumns(
        {f"prev_{c}": F.lag(c).over(w) for c in ("close", "high", "low")}
    )
    diff = F.col("close") - F.col("prev_close")
    up = F.col("high") - F.col("prev_high")
    down = F.col("prev_low") - F.col("low")
    return lagged.withColumns(
        {
            "log_ret": log_return(F.col("close"), F.col("prev_close")),
            "tr": true_range(F.col("high"), F.col("low"), F.col("prev_close")),
            "gain": gain(diff),
            "loss": loss(diff),
            "dm_pos": dominant_move(up, down),
            "dm_neg": dominant_move(down, up),
            # squares of large volumes overflow in integer arithmetic
            "vol": F.col("volume").cast("double"),
        }
    )


def rolling_features(terms: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Moving average, volatility, volume z-score, ATR, RSI, DI, DX and ADX per window."""
    ret, vol = F.col("log_ret"), F.col("vol")
    rolled = rolling_means(
        terms,
        {
            "m_ret": ret,
            "m_ret2": ret * ret,
            "m_vol": vol,
            "m_vol2": vol * vol,
            "atr": F.col("tr"),
            "m_gain": F.col("gain"),
            "m_loss": F.col("loss"),
            "m_pos": F.col("dm_pos"),
            "m_neg": F.col("dm_neg"),
        },
        {("m_ret", "m_ret2"): ret, ("m_vol", "m_vol2"): vol, ("atr",): F.col("tr")},
        windows,
        extra={"next_ret": F.lead("log_ret").over(frame_window("dt"))},
    )

    def at(name: str, k: int) -> Column:
        return F.col(f"{name}_{k}")

    derived = rolled.withColumns(
        {
            name: value
            for k in windows
            for name, value in {
                f"ma_{k}": at("m_ret", k),
                f"rv_{k}": population_std(at("m_ret", k), at("m_ret2", k)),
                f"vol_z_{k}": safe_div(
                    F.col("vol") - at("m_vol", k), population_std(at("m_vol", k), at("m_vol2", k))
                ),
                f"atr_n_{k}": safe_div(at("atr", k), F.col("close")),
                f"rsi_n_{k}": relative_strength(at("m_gain", k), at("m_loss", k)),
                f"di_pos_{k}": directional_indicator(at("m_pos", k), at("atr", k)),
                f"di_neg_{k}": directional_indicator(at("m_neg", k), at("atr", k)),
            }.items()
        }
    ).withColumns(
        {f"dx_{k}": directional_index(F.col(f"di_pos_{k}"), F.col(f"di_neg_{k}")) for k in windows}
    )
    index = {f"m_dx_{k}": F.col(f"dx_{k}") for k in windows}
    smoothed = rolling_means(
        derived, index, {(name,): value for name, value in index.items()}, windows
    )
    return smoothed.withColumns(
        {f"adx_n_{k}": F.col(f"m_dx_{k}_{k}") / F.lit(100.0) for k in windows}
    )


def indicator_table(
    bars: DataFrame,
    fx: DataFrame,
    windows: Sequence[int] = WINDOWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every price, term and indicator per bar; select what is needed, the rest is pruned."""
    framed = priced_frames(bars, fx, windows, block_rows)
    return rolling_features(daily_terms(framed), windows).where("own").drop("own", "block")


def master_features(
    bars: DataFrame,
    fx: DataFrame,
    windows: Sequence[int] = WINDOWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Key, features, row number and count, and the next bar's return."""
    return indicator_table(bars, fx, windows, block_rows).select(
        "dt", "ticker", *feature_columns(windows), "rn", "n", "next_ret"
    )

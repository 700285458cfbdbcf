"""Rolling means over several window lengths in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barline.functions import safe_div
from barline.plans.blocks import frame_window


def rolling_means(
    framed: DataFrame,
    values: Mapping[str, Column],
    known: Mapping[Sequence[str], Column],
    windows: Sequence[int],
    extra: Mapping[str, Column] | None = None,
    row: str = "rn",
    order: str = "dt",
) -> DataFrame:
    """Add ``{name}_{k}``: the mean of the last ``k`` rows of each value, for every window.

    NULLs are left out. ``known`` maps the names that may be NULL to a column that
    is NULL with them; the other values never are. ``extra`` columns are computed
    in the same window node. ``row`` is the row number within the series.

    Spark adds up a sliding frame from scratch for every row, so only the shortest
    window is summed, and a window that is a multiple of it adds the sums of 10,
    20, ... rows earlier. That is still a plain sum of the frame's values, where a
    difference of running sums would lose digits.
    """
    w = frame_window(order)
    base = min(windows)
    direct = [base, *[k for k in windows if k % base]]
    count_of = {name: f"_rows_{i}" for i, names in enumerate(known) for name in names}
    parts = {f"_sum_{name}": F.sum(value) for name, value in values.items()}
    parts |= {f"_rows_{i}": F.count(column) for i, column in enumerate(known.values())}

    def over(k: int) -> WindowSpec:
        return w.rowsBetween(1 - k, 0)

    first = {f"{part}_{k}": total.over(over(k)) for part, total in parts.items() for k in direct}
    steps = sorted({s for k in windows if k not in direct for s in range(base, k, base)})
    lags = {
        f"{part}_{base}_{s}": F.lag(f"{part}_{base}", s).over(w) for part in parts for s in steps
    }
    summed = framed.withColumns({**first, **(extra or {})})
    if lags:
        summed = summed.withColumns(lags)

    def total(part: str, k: int) -> Column:
        if k in direct:
            return F.col(f"{part}_{k}")
        pieces = [f"{part}_{base}", *[f"{part}_{base}_{s}" for s in range(base, k, base)]]
        out = F.lit(0)
        for piece in pieces:
            out = out + F.coalesce(F.col(piece), F.lit(0))
        return out

    def rows(name: str, k: int) -> Column:
        return total(count_of[name], k) if name in count_of else F.least(F.col(row), F.lit(k))

    return summed.withColumns(
        {
            f"{name}_{k}": safe_div(total(f"_sum_{name}", k), rows(name, k).cast("double"))
            for name in values
            for k in windows
        }
    ).drop(*first, *lags)

"""Slow row-by-row versions of the operators in plain Python, written from the definitions."""

from __future__ import annotations

import math
from collections.abc import Sequence


def div(a, b):
    return None if a is None or b is None or b == 0 else a / b


def mean(values: Sequence):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def roll(values: Sequence, i: int, k: int):
    return mean(values[max(0, i - k + 1) : i + 1])


def std(values: Sequence, i: int, k: int):
    m1 = roll(values, i, k)
    if m1 is None:
        return None
    m2 = roll([None if v is None else v * v for v in values], i, k)
    var = m2 - m1 * m1
    return 0.0 if var <= 1e-12 * max(m2, 1e-300) else math.sqrt(var)


def fill(series: dict[str, list[tuple]], rates: dict) -> dict[tuple, float | None]:
    """``series``: ticker -> ordered dates that have a rate row."""
    own, lent = {}, {}
    for ticker, dates in series.items():
        for i, d in enumerate(dates):
            before = rates[dates[i - 1]] if i else None
            own[ticker, d] = before
            if rates[d] is None and before is not None:
                lent.setdefault(d, []).append((dates[i - 1], before))
    out = {}
    for ticker, dates in series.items():
        for d in dates:
            value = rates[d] if rates[d] is not None else own[ticker, d]
            if value is None and d in lent:
                value = max(lent[d])[1]
            out[ticker, d] = value
    return out


def indicators(bars: list[dict], windows=(20, 10)) -> list[dict]:
    """Features of one ticker's converted bars in date order."""
    n = len(bars)
    ret, tr, gain, loss, pos, neg = [], [], [], [], [], []
    for i, b in enumerate(bars):
        p = bars[i - 1] if i else None
        c, pc = b["close"], p and p["close"]
        ratio = div(c, pc)
        ret.append(math.log(ratio) if ratio is not None and ratio > 0 else None)
        if None in (b["high"], b["low"], pc):
            tr.append(None)
        else:
            tr.append(max(b["high"] - b["low"], abs(b["high"] - pc), abs(b["low"] - pc)))
        d = None if c is None or pc is None else c - pc
        gain.append(d if d is not None and d > 0 else 0.0)
        loss.append(-d if d is not None and d < 0 else 0.0)
        up = None if p is None or None in (b["high"], p["high"]) else b["high"] - p["high"]
        down = None if p is None or None in (b["low"], p["low"]) else p["low"] - b["low"]
        both = up is not None and down is not None
        pos.append(up if both and up > down and up > 0 else 0.0)
        neg.append(down if both and down > up and down > 0 else 0.0)
    vol = [None if b["volume"] is None else float(b["volume"]) for b in bars]
    out = [{"log_ret": ret[i]} for i in range(n)]
    for k in windows:
        dx = []
        for i in range(n):
            row = out[i]
            row[f"ma_{k}"] = roll(ret, i, k)
            row[f"rv_{k}"] = std(ret, i, k)
            centre = roll(vol, i, k)
            row[f"vol_z_{k}"] = (
                None if vol[i] is None or centre is None else div(vol[i] - centre, std(vol, i, k))
            )
            atr = roll(tr, i, k)
            row[f"atr_n_{k}"] = div(atr, bars[i]["close"])
            g, lo = roll(gain, i, k), roll(loss, i, k)
            row[f"rsi_n_{k}"] = 1.0 if lo == 0 else (100 - 100 / (1 + g / lo)) / 100
            di = []
            for moves in (pos, neg):
                share = div(roll(moves, i, k), atr)
                di.append(0.0 if atr == 0 else None if share is None else share * 100)
            if None in di:
                dx.append(None)
            else:
                dx.append(0.0 if sum(di) == 0 else abs((di[0] - di[1]) / sum(di)) * 100)
            adx = roll(dx, i, k)
            row[f"adx_n_{k}"] = None if adx is None else adx / 100
    return out


FAMILIES = ("ma", "rv", "vol_z", "atr_n", "rsi_n", "adx_n")


def label(features: list[dict]) -> tuple[float | None, int, list[dict]]:
    """Regime, window and labelled rows of one ticker (rows carry ``rn``)."""
    n = len(features)
    avg_vol = mean([f["atr_n_20"] for f in features[: n * 4 // 5]])
    win = 10 if avg_vol is not None and avg_vol >= 0.015 else 20
    rows = []
    for i, f in enumerate(features):
        known = [g["log_ret"] for g in features[:i] if g["log_ret"] is not None]
        ma5 = None
        if f["log_ret"] is not None and len(known) >= 5:
            ma5 = sum(known[-5:]) / 5
        if i + 1 >= win:
            rows.append(
                {
                    "i": i,
                    "log_ret": f["log_ret"],
                    "ma5": ma5,
                    **{name: f[f"{name}_{win}"] for name in FAMILIES},
                }
            )
    atr = mean([r["atr_n"] for r in rows])
    for r in rows:
        r["label"] = 0
        if atr is not None and r["ma5"] is not None and r["log_ret"] is not None:
            if r["log_ret"] > r["ma5"] + 0.15 * atr:
                r["label"] = 1
            elif r["log_ret"] < r["ma5"] - 0.15 * atr:
                r["label"] = -1
    for r, after in zip(rows, [*rows[1:], None]):
        r["label_next"] = after["label"] if after else None
    return avg_vol, win, rows


def split(rows: list[dict]) -> tuple[list[dict], list[dict]]:
    """Train and test rows without NULLs."""
    needed = ("log_ret", *FAMILIES, "label_next")
    clean = [r for r in rows if all(r[c] is not None for c in needed)]
    cut = len(clean) * 4 // 5
    return clean[:cut], clean[cut:]


def samples(part: list[dict], scale: dict, win: int) -> list[tuple]:
    """(row index, x, y) per sample of one split."""
    names = ("log_ret", *FAMILIES)
    scaled = [[(r[c] - scale[c][0]) / scale[c][1] for c in names] for r in part]
    return [
        (part[i]["i"], scaled[i - win : i], part[i - 1]["label_next"])
        for i in range(win, len(part))
    ]

"""Currency, indicators, labels, split and samples against slow plain-Python versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barline.operators import indicators, labels, regime, samples
from barline.operators.fx import fx_convert, fx_fill, fx_join
from barline.plans import land
from tests import brute
from tests.conftest import day

BLOCKS = [7, 65_536]
PRICES = ("open", "high", "low", "close", "adj_close")


def same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


# --- currency ---------------------------------------------------------------------


def fx_of(spark, make_bars, make_fx, days, rates):
    bars = make_bars([(t, i, 1, 2, 0.5, 1, 1) for t, ds in days.items() for i in ds])
    got = fx_fill(bars, make_fx(rates)).collect()
    return {(r.ticker, (r.dt - day(0)).days): r.fx_close for r in got}


def test_bars_without_a_rate_row_are_dropped(spark, make_bars, make_fx):
    got = fx_of(spark, make_bars, make_fx, {"A": [0, 1, 2]}, {0: 10, 2: 12})
    assert got == {("A", 0): 10, ("A", 2): 12}


def test_fill_goes_one_step_only(spark, make_bars, make_fx):
    got = fx_of(spark, make_bars, make_fx, {"A": range(5)}, {0: 10, 1: None, 2: None, 3: None, 4: 14})
    assert [got["A", i] for i in range(5)] == [10, 10, None, None, 14]


def test_another_ticker_lends_its_previous_rate(spark, make_bars, make_fx):
    days = {"A": [0, 1, 2], "B": [0, 2], "C": [2]}
    got = fx_of(spark, make_bars, make_fx, days, {0: 10, 1: None, 2: None})
    # A has no rate on day 1; B's previous bar is day 0; C has no previous bar
    assert got == {("A", 0): 10, ("A", 1): 10, ("A", 2): 10, ("B", 0): 10, ("B", 2): 10, ("C", 2): 10}


def test_latest_lender_wins(spark, make_bars, make_fx):
    days = {"A": [2, 3], "B": [0, 3], "C": [1, 3], "D": [3]}
    got = fx_of(spark, make_bars, make_fx, days, {0: 10, 1: 11, 2: None, 3: None})
    assert got["B", 3] == 10 and got["C", 3] == 11
    assert got["A", 3] == 11 and got["D", 3] == 11


def test_two_rates_on_one_date_are_an_error(spark, make_bars, make_fx):
    fx = make_fx({0: 10}).unionByName(make_fx({0: 11}))
    with pytest.raises(Exception, match="two FX rows"):
        fx_join(make_bars([("A", 0, 1, 1, 1, 1, 1)]), fx).collect()


def test_local_tickers_keep_their_prices(spark, make_bars, make_fx):
    bars = make_bars([(t, 0, 1, 4, 0.5, 2, 7) for t in ("x.MX", "y.mx", "MX", "z")])
    got = {r.ticker: r for r in fx_convert(fx_join(bars, make_fx({0: 10}))).collect()}
    assert [got[t].close for t in ("x.MX", "y.mx", "MX", "z")] == [2, 2, 20, 20]
    assert (got["z"].open, got["z"].high, got["z"].low, got["z"].adj_close) == (10, 40, 5, 20)
    assert got["z"].volume == 7


# --- indicators -------------------------------------------------------------------


def flat_fx(make_fx, days):
    return make_fx({i: 1.0 for i in days})


def features_of(make_bars, make_fx, closes, highs=None, lows=None, volumes=None, block_rows=65_536):
    n = len(closes)
    highs, lows = highs or closes, lows or closes
    volumes = volumes or [1] * n
    rows = [("t", i, closes[i], highs[i], lows[i], closes[i], volumes[i]) for i in range(n)]
    table = indicators.indicator_table(
        make_bars(rows), flat_fx(make_fx, range(n)), block_rows=block_rows
    )
    return [r.asDict() for r in table.orderBy("rn").collect()]


def test_single_bar(spark, make_bars, make_fx):
    (row,) = features_of(make_bars, make_fx, [5.0], [6.0], [4.0])
    for name in ("log_ret", "tr", "ma_20", "rv_20", "atr_n_20", "dx_20", "adx_n_20", "vol_z_20"):
        assert row[name] is None, name
    assert row["rsi_n_20"] == 1.0 and row["dm_pos"] == 0.0 and row["dm_neg"] == 0.0


def test_flat_series(spark, make_bars, make_fx):
    rows = features_of(make_bars, make_fx, [5.0] * 25)
    last = rows[-1]
    assert last["rv_20"] == 0.0 and last["rv_10"] == 0.0
    assert last["vol_z_20"] is None  # no spread in the volume
    assert last["rsi_n_20"] == 1.0  # no loss, although no gain either
    assert last["atr_n_20"] == 0.0 and last["di_pos_20"] == 0.0 and last["adx_n_20"] == 0.0


def test_true_range_takes_the_largest_of_three(spark, make_bars, make_fx):
    rows = features_of(make_bars, make_fx, [10, 10, 20, 5], [11, 12, 21, 6], [9, 9, 19, 4])
    assert [r["tr"] for r in rows] == [None, 3, 11, 16]


def test_zero_and_negative_closes_give_nulls(spark, make_bars, make_fx):
    rows = features_of(make_bars, make_fx, [10, 0, 5, -5, -10])
    assert [r["log_ret"] is None for r in rows] == [True, True, True, True, False]
    assert rows[1]["atr_n_20"] is None  # divided by a zero close


def test_huge_volumes(spark, make_bars, make_fx):
    rows = features_of(make_bars, make_fx, [1.0, 2.0, 3.0], volumes=[30_000_000_000, 10, 10])
    assert same(rows[2]["vol_z_20"], -1 / math.sqrt(2), 1e-6)


def test_close_and_not_adjusted_close_governs(spark, make_bars, make_fx):
    bars = make_bars([("t", i, c, c, c, c, 1) for i, c in enumerate((1.0, 2.0))])
    bars = bars.withColumn("adj_close", F.lit(1.0))
    row = indicators.indicator_table(bars, flat_fx(make_fx, range(2))).orderBy("rn").collect()[1]
    assert same(row.log_ret, math.log(2))


def random_market(seed, days=230):
    """Three tickers with gaps, missing rates in runs, NULL closes and zero prices."""
    rng = random.Random(seed)
    rates = {i: (None if rng.random() < 0.12 or 60 <= i < 72 else rng.uniform(15, 20)) for i in range(days)}
    for i in rng.sample(range(days), 8):
        del rates[i]
    rows = []
    for ticker, keep, vol in (("hot", 0.97, 0.03), ("loc.mx", 0.8, 0.002), ("tiny", 0.08, 0.05)):
        price = 100.0
        for i in range(days):
            if rng.random() > keep:
                continue
            o = price
            price *= math.exp(rng.gauss(0, vol))
            c = None if rng.random() < 0.01 else price
            if ticker == "hot" and rng.random() < 0.02:
                c = 0.0
            top, low = max(o, price) * (1 + vol / 4), min(o, price) * (1 - vol / 4)
            volume = None if rng.random() < 0.02 else rng.randint(1, 10**6)
            rows.append((ticker, i, o, top, low, c, volume))
    return rows, rates


def brute_market(rows, rates):
    by_ticker = {}
    for t, i, o, h, lo, c, v in rows:
        if i in rates:
            by_ticker.setdefault(t, []).append((i, o, h, lo, c, v))
    filled = brute.fill({t: [b[0] for b in bars] for t, bars in by_ticker.items()}, rates)
    out = {}
    for t, bars in by_ticker.items():
        converted = []
        for i, _, h, lo, c, v in bars:
            rate = 1.0 if t.lower().endswith(".mx") else filled[t, i]

            def price(p, rate=rate):
                return None if p is None or rate is None else p * rate

            converted.append({"high": price(h), "low": price(lo), "close": price(c), "volume": v})
        out[t] = ([b[0] for b in bars], brute.indicators(converted))
    return out


@pytest.fixture(scope="module", params=[1])
def market(request, spark, make_bars, make_fx):
    rows, rates = random_market(request.param)
    return make_bars(rows), make_fx(rates), brute_market(rows, rates)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_features_of_a_gappy_market(market, block_rows):
    bars, fx, want = market
    got = indicators.master_features(bars, fx, block_rows=block_rows).collect()
    assert len(got) == sum(len(days) for days, _ in want.values())
    for r in got:
        days, rows = want[r.ticker]
        i = r.rn - 1
        assert r.dt == day(days[i]) and r.n == len(days)
        for name in indicators.feature_columns():
            assert same(r[name], rows[i][name], 1e-7), (r.ticker, i, name, r[name], rows[i][name])
        after = rows[i + 1]["log_ret"] if i + 1 < len(rows) else None
        assert same(r.next_ret, after)


def test_bounds(market):
    bars, fx, _ = market
    for r in indicators.master_features(bars, fx).collect():
        for k in (20, 10):
            assert 0 <= r[f"rsi_n_{k}"] <= 1
            assert r[f"adx_n_{k}"] is None or 0 <= r[f"adx_n_{k}"] <= 1
            assert r[f"atr_n_{k}"] is None or r[f"atr_n_{k}"] >= 0


def test_a_later_bar_changes_no_earlier_feature(spark, make_bars, make_fx):
    rng = random.Random(3)
    closes = [100 + rng.uniform(-5, 5) for _ in range(60)]
    a = features_of(make_bars, make_fx, closes)
    b = features_of(make_bars, make_fx, [*closes[:-1], 500.0])
    for x, y in zip(a[:-1], b[:-1]):
        assert all(x[c] == y[c] for c in indicators.feature_columns())
    assert a[-1]["log_ret"] != b[-1]["log_ret"]


# --- regime, labels, split, samples -----------------------------------------------


@pytest.fixture(scope="module")
def labelled(market):
    bars, fx, want = market
    features = land(indicators.master_features(bars, fx), "test_features")
    return features, {t: brute.label(rows) for t, (_, rows) in want.items()}


def test_regime(labelled):
    features, want = labelled
    got = {r.ticker: r for r in regime.volatility_regime(features).collect()}
    for ticker, (avg_vol, win, _) in want.items():
        assert same(got[ticker].avg_vol, avg_vol) and got[ticker].win == win
    assert {w for _, w, _ in want.values()} == {10, 20}


def test_regime_of_a_ticker_without_volatility_is_the_long_window(spark):
    df = spark.createDataFrame([("a", 1, 1, None)], "ticker string, rn bigint, n bigint, atr_n_20 double")
    row = regime.volatility_regime(df).first()
    assert row.avg_vol is None and row.win == 20


@pytest.mark.parametrize("block_rows", [3, 16, 65_536])
def test_labels_and_split(labelled, block_rows):
    features, want = labelled
    rows = labels.label_rows(features, block_rows=block_rows)
    got = rows.collect()
    assert len(got) == sum(len(r) for _, _, r in want.values())
    by_key = {(t, r["i"]): r for t, (_, _, rs) in want.items() for r in rs}
    for g in got:
        w = by_key[g.ticker, g.rn - 1]
        for name in ("log_ret", *brute.FAMILIES, "ma5"):
            assert same(g[name], w[name], 1e-7), (g.ticker, g.rn, name, g[name], w[name])
        assert (g.label, g.label_next) == (w["label"], w["label_next"]), (g, w)
    parts = {(r.ticker, r.rn - 1): r for r in labels.chrono_split(rows).collect()}
    for ticker, (_, _, rs) in want.items():
        train, test = brute.split(rs)
        for name, part in (("train", train), ("test", test)):
            for place, r in enumerate(part, 1):
                g = parts.pop((ticker, r["i"]))
                assert (g.split, g.split_rn, g.split_n) == (name, place, len(part))
    assert not parts


@pytest.mark.parametrize("block_rows", [5, 65_536])
def test_scaling_and_samples(labelled, block_rows):
    features, want = labelled
    split = land(labels.chrono_split(labels.label_rows(features)), "test_split")
    stats = samples.scaler_stats(split)
    scales = {r.ticker: r for r in stats.collect()}
    scaled = samples.scaled_features(split, stats, block_rows)
    got = samples.sequence_samples(scaled, block_rows).collect()
    keys = {(r.ticker, r.dt): r.rn - 1 for r in split.collect()}
    found = {(r.ticker, r.split, keys[r.ticker, r.dt]): r for r in got}
    for ticker, (_, win, rs) in want.items():
        train, test = brute.split(rs)
        if not train:
            continue
        scale = {
            c: (scales[ticker][f"{c}_mean"], scales[ticker][f"{c}_sd"])
            for c in ("log_ret", *brute.FAMILIES)
        }
        for c, (m, sd) in scale.items():
            values = [r[c] for r in train]
            centre = sum(values) / len(values)
            assert same(m, centre, 1e-7)
            spread = math.sqrt(sum((v - centre) ** 2 for v in values) / len(values))
            assert same(sd, spread or 1.0, 1e-7)
        for name, part in (("train", train), ("test", test)):
            for i, x, y in brute.samples(part, scale, win):
                g = found.pop((ticker, name, i))
                assert len(g.x) == win and g.y == y and g.win == win
                assert all(same(p, q, 1e-6) for a, b in zip(g.x, x) for p, q in zip(a, b))
    assert not found


def test_a_constant_feature_scales_to_zero(spark):
    columns = ", ".join(f"{f} double" for f in samples.SAMPLE_FEATURES)
    rows = [("t", day(i), "train", i + 1, 4, 10, *[float(i)] * 6, 3.0, 0, i + 1, 4) for i in range(4)]
    split = spark.createDataFrame(
        rows,
        f"ticker string, dt date, split string, split_rn bigint, split_n bigint, win int, {columns}, "
        "label_next int, clean_rn bigint, clean_n bigint",
    )
    got = samples.scaled_features(split, samples.scaler_stats(split)).collect()
    assert [r[samples.SAMPLE_FEATURES[-1]] for r in got] == [0.0] * 4


def test_class_weights_ignore_a_missing_class(spark):
    rows = [("t", "train", y) for y in (-1, -1, -1, 1)] + [("t", "test", 0)]
    df = spark.createDataFrame(rows, "ticker string, split string, y int")
    got = {r.y: r.weight for r in samples.class_weights(df).collect()}
    assert got == {-1: 4 / (2 * 3), 1: 4 / 2}

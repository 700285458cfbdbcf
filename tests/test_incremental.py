"""Features kept up to date against the features of all bars at once."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from barline.operators import incremental, indicators
from barline.plans.landing import new_path

COLUMNS = ["ticker", "dt", *indicators.feature_columns(), "next_ret"]
DAYS = 64


def rows(df):
    found = [
        tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r)
        for r in df.select(*COLUMNS).collect()
    ]
    return sorted(found, key=repr)


def random_bars(rng, tickers, days, share):
    out = {}
    for t in tickers:
        price = 100.0
        for d in range(days):
            if rng.random() < share[t]:
                price *= 1 + rng.uniform(-0.03, 0.03)
                high, low = price * rng.uniform(1, 1.02), price * rng.uniform(0.98, 1)
                out[t, d] = (t, d, price, high, low, price, rng.randint(1, 1000))
    return out


@pytest.fixture(scope="module")
def market():
    rng = random.Random(4)
    share = {"A": 0.9, "B.mx": 0.7, "C": 0.03, "D": 0.5}
    bars = random_bars(rng, list(share), 420, share)
    rates = {d: None if rng.random() < 0.12 else 17 + rng.random() for d in range(415) if d % 50 != 7}
    return rng, bars, rates


def test_updates_equal_the_features_of_all_bars(spark, make_bars, make_fx, market):
    """New, late, corrected and withdrawn bars, sparse tickers, lent rates; five updates."""
    rng, bars, rates = market
    fx, path = make_fx(rates), new_path(spark, "incremental")
    now = {k: v for k, v in bars.items() if k[1] < 200 and rng.random() < 0.8}
    versions = [dict(now)]
    now |= {k: v for k, v in bars.items() if k[1] < 320}  # late ones and a new stretch
    versions.append(dict(now))
    now |= {k: v for k, v in bars.items()}
    for k in rng.sample(sorted(now), 5):
        t, d, *p, v = now[k]
        now[k] = (t, d, *[x * 1.1 for x in p], v)
    versions.append(dict(now))
    gaps = [d for d, r in rates.items() if r is None]
    for k in [k for k in now if k[1] in gaps[3:6] or (k[0] == "C" and k[1] < 150)]:
        del now[k]  # borrowers and lenders are gone, and whole stretches of C
    versions.append(dict(now))
    versions.append(dict(now))
    old = {}
    for version in versions:
        frame = make_bars(list(version.values()))
        keys = [k for k in {*old, *version} if old.get(k) != version.get(k)]
        changed = frame.limit(0) if not keys else make_bars([(*k, 1, 1, 1, 1, 1) for k in keys])
        state = incremental.update_features(path, frame, fx, changed, days=DAYS)
        want = rows(indicators.master_features(frame, fx))
        assert rows(incremental.read_features(spark, path)) == want
        old = version
    assert state.version == 4


def test_a_correction_reads_its_neighbourhood_only(spark, make_bars, make_fx):
    rng = random.Random(6)
    share = {t: 0.9 for t in "ABC"}
    bars = random_bars(rng, "ABC", 3_000, share)
    fx, path = make_fx({d: 17.0 + d / 1e4 for d in range(3_000)}), new_path(spark, "incremental")
    table = new_path(spark, "bars-by-stretch")
    frame = make_bars(list(bars.values()))
    incremental.with_stretch(frame, DAYS).write.partitionBy("stretch").parquet(table)
    stored_bars = spark.read.parquet(table)
    first = incremental.update_features(path, stored_bars, fx, days=DAYS)
    stretches = first.counts.count()
    touched = incremental.with_stretch(frame.where("ticker = 'B'").limit(1), DAYS).select("ticker", "stretch")
    one = frame.where("ticker = 'B' and dt = date '2024-01-01'").select("ticker", "dt")
    assert one.count() == 1
    incremental.update_features(path, stored_bars, fx, one, days=DAYS)
    renewed = spark.read.parquet(f"{path}/rows/version=1")
    assert 1 <= renewed.select("ticker", "stretch").distinct().count() <= 3 < stretches
    assert {r.ticker for r in renewed.select("ticker").distinct().collect()} == {"B"}
    read = incremental.bars_of(stored_bars, incremental.frame_sources(first.counts, touched, 40), DAYS)
    assert read.count() <= 4 * DAYS
    plan = read._jdf.queryExecution().executedPlan().toString()
    folders = re.search(r"PartitionFilters: \[[^\]]*stretch#\d+ IN \(([\d,]+)\)", plan).group(1)
    assert len(folders.split(",")) <= 3  # the others are not read
    assert rows(incremental.read_features(spark, path)) == rows(indicators.master_features(frame, fx))


def test_a_failed_update_leaves_the_table(spark, make_bars, make_fx, market):
    _, bars, rates = market
    fx, path = make_fx(rates), new_path(spark, "incremental")
    good = make_bars([v for k, v in bars.items() if k[1] < 100])
    incremental.update_features(path, good, fx, days=DAYS)
    before = rows(incremental.read_features(spark, path))
    twice = good.unionByName(good.limit(1))
    with pytest.raises(Exception, match="two rows with one"):
        incremental.update_features(path, twice, fx, good.select("ticker", "dt"), days=DAYS)
    assert incremental.stored(spark, path).version == 0
    assert rows(incremental.read_features(spark, path)) == before


def test_an_empty_table(spark, make_bars, make_fx):
    path = new_path(spark, "incremental")
    none = make_bars([("A", 1, 1, 1, 1, 1, 1)]).where("false")
    incremental.update_features(path, none, make_fx({1: 2.0}), days=DAYS)
    assert incremental.read_features(spark, path).count() == 0
    some = make_bars([("A", 1, 1, 1, 1, 1, 1), ("A", 2, 1, 1, 1, 2, 1)])
    incremental.update_features(path, some, make_fx({1: 2.0, 2: 2.0}), some, days=DAYS)
    assert incremental.read_features(spark, path).where(F.col("log_ret") > 0).count() == 1

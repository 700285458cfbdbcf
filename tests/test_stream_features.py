"""Streamed features against those of all bars at once."""

from __future__ import annotations

import random

import pytest

from barline import streaming
from barline.operators import indicators
from barline.operators.fx import fx_convert, fx_fill
from barline.plans.landing import new_path

from tests.test_incremental import random_bars, rows

KEEP = 60


def run_batches(batches, path, keep=KEEP):
    write = streaming.keep_features(path, keep=keep)
    for i, batch in enumerate(batches):
        write(batch, i)


@pytest.fixture(scope="module")
def market(spark, make_bars, make_fx):
    rng = random.Random(9)
    bars = random_bars(rng, ["A", "B.mx", "C"], 240, {"A": 0.9, "B.mx": 0.6, "C": 0.2})
    fx = make_fx({d: 17 + rng.random() for d in range(240)})
    frame = make_bars(list(bars.values()))
    converted = fx_convert(fx_fill(frame, fx)).select(*streaming.BAR).cache()
    return rng, converted, rows(indicators.master_features(frame, fx))


def parts_of(spark, converted, place):
    whole = sorted(converted.collect(), key=lambda r: (r.dt, r.ticker))
    groups: dict[int, list] = {}
    for i, r in enumerate(whole):
        groups.setdefault(place(i, len(whole)), []).append(r)
    return [spark.createDataFrame(groups[k], converted.schema) for k in sorted(groups)]


def test_bars_out_of_order_are_put_right(spark, market):
    rng, converted, want = market
    path, keep = new_path(spark, "stream-features"), 190
    batches = parts_of(spark, converted, lambda i, n: int((i + rng.random() * 18) * 4 // (n + 18)))
    wrong = batches[1].withColumn("close", batches[1].close * 1.5).where("day(dt) % 9 = 0")
    run_batches([batches[0], batches[1].join(wrong, ["ticker", "dt"], "left_anti").unionByName(wrong)], path, keep)
    write = streaming.keep_features(path, keep=keep)
    write(batches[1], 2)  # corrections
    write(batches[2], 3)
    write(batches[2], 3)  # a retried batch
    write(batches[3], 4)
    assert streaming.late_bars(spark, path).count() == 0
    assert rows(streaming.streamed_features(spark, path)) == want
    state = spark.read.parquet(f"{path}/state/batch=4").groupBy("ticker").count().collect()
    assert max(r["count"] for r in state) <= keep


def test_bars_too_late_for_the_state_go_aside(spark, market):
    _, converted, want = market
    path = new_path(spark, "stream-features")
    whole = sorted(converted.where("ticker = 'A'").collect(), key=lambda r: r.dt)
    late = whole[20]
    frames = [
        spark.createDataFrame(p, converted.schema)
        for p in (whole[:20] + whole[21:150], [late], whole[150:])
    ]
    run_batches(frames, path)
    aside = streaming.late_bars(spark, path).collect()
    assert [(r.ticker, r.dt) for r in aside] == [("A", late.dt)]
    # Rows beyond its reach are those of all bars; none is sent for the late bar itself.
    got = {r[:2]: r for r in rows(streaming.streamed_features(spark, path))}
    assert ("A", late.dt) not in got
    for r in want:
        if r[0] == "A" and r[1] > whole[20 + indicators.look_back() + 1].dt:
            assert got[r[:2]] == r


def test_the_state_must_hold_what_a_feature_reaches_back_to():
    with pytest.raises(ValueError, match="keep more than"):
        streaming.keep_features("unused", keep=indicators.look_back())

"""As-of joins against a search row by row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barline.operators import fx as fx_ops
from barline.plans import asof_join

from tests.conftest import day


def slow(rows, values, staleness):
    out = []
    for key, t in rows:
        known = [
            (at, v)
            for k, at, v in values
            if v is not None and k == key and None not in (t, at, key)
            and at <= t and (staleness is None or t - at <= staleness)
        ]
        at, v = max(known, default=(None, None))
        out.append((key, t, v, at))
    return sorted(out, key=repr)


@pytest.mark.parametrize("staleness", [None, 0, 1, 7])
@pytest.mark.parametrize("bucket", [4, 1024])
def test_last_known_value(spark, staleness, bucket):
    rng = random.Random(1)
    values = [
        (k, t, None if rng.random() < 0.3 else float(t)) for k in "ab" for t in range(-40, 120) if rng.random() < 0.2
    ] + [("c", 3, 1.0), (None, 4, 9.0), ("a", None, 8.0)]
    rows = [(k, t) for k in "abcd" for t in range(-60, 130, 3)] + [(None, 5), ("a", None), ("a", 9), ("a", 9)]
    left = spark.createDataFrame(rows, "k string, t int")
    right = spark.createDataFrame(values, "k string, t int, v double")
    got = asof_join(left, right, ["k"], "t", "v", "found", staleness, bucket)
    assert got.columns == ["k", "t", "found", "found_at"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == slow(rows, values, staleness)


def test_no_rows_and_no_values(spark):
    left = spark.createDataFrame([("a", 1)], "k string, t int")
    none = spark.createDataFrame([], "k string, t int, v double")
    assert [tuple(r) for r in asof_join(left, none, ["k"], "t", "v").collect()] == [("a", 1, None, None)]
    assert asof_join(left.where("false"), none, ["k"], "t", "v").collect() == []


def test_rates_of_days_without_a_rate_row(make_bars, make_fx):
    bars = make_bars([("A", i, 1, 1, 1, 1, 1) for i in range(6)])
    fx = make_fx({1: 10.0, 2: None, 4: None})
    rate = lambda n: {r.dt: r.fx_close for r in fx_ops.fx_asof(bars, fx, n).collect()}
    assert rate(None) == {day(0): None, **{day(i): 10.0 for i in range(1, 6)}}
    assert rate(2) == {day(0): None, **{day(i): 10.0 for i in range(1, 4)}, day(4): None, day(5): None}


def test_windows_see_one_bucket_of_rows(spark):
    """A window over a key alone sits on one row per bucket."""
    left = spark.range(10).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    right = left.withColumn("v", F.col("t") * 1.0)
    text = asof_join(left, right, ["k"], "t", "v")._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Window [" in line:
            assert "_bucket" in line.split("], [")[1] or "_last_" in line, line

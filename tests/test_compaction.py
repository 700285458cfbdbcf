"""Compacted parts of streamed bars, and late rows that are counted."""

from __future__ import annotations

import datetime as dtm
import random
from decimal import Decimal

from pyspark.sql import functions as F

from barline import sources, streaming
from barline.plans.landing import new_path

TICKS = "ticker string, ts timestamp, price double, qty bigint, seq decimal(38,0)"
START = dtm.datetime(2024, 1, 1)


def ticks_of(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("ab"), START + dtm.timedelta(minutes=rng.randrange(600)), rng.random(), 1, Decimal(rng.randrange(10**6)))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, TICKS)


def bars(df):
    return sorted(tuple(r) for r in df.select("ticker", "ts", "open", "high", "low", "close", "volume").collect())


def test_parts_stay_few_and_the_bars_whole(spark):
    path, whole = new_path(spark, "compacted"), None
    write = streaming.compacting_parts(path, fan=3)
    for i in range(11):
        batch = ticks_of(spark, 30, i)
        write(batch, i)
        if i == 5:
            write(batch, i)  # a retried batch, with its merge
        whole = batch if whole is None else whole.unionByName(batch)
        parts = streaming.current_parts(spark, path)
        assert [p.first for p in parts[1:]] == [p.last + 1 for p in parts[:-1]] and parts[-1].last == i
        digits, n = 0, i + 1
        while n:
            digits, n = digits + n % 3, n // 3
        assert len(parts) == digits  # two a level at most
    want = sources.build_bars(whole, F.date_trunc("hour", "ts"), name="ts")
    assert bars(streaming.compacted_bars(spark, path)) == bars(want)


def test_no_batch_yet(spark):
    assert streaming.compacted_bars(spark, new_path(spark, "compacted")).collect() == []


def test_late_rows_are_put_aside_and_counted(spark):
    path, kept = new_path(spark, "late"), []
    split = streaming.late_aside(path, "1 hour", lambda df, i: kept.extend(df.select("price").collect()))
    at = lambda minutes, p: ("a", None if minutes is None else START + dtm.timedelta(minutes=minutes), p, 1, p)
    split(spark.createDataFrame([at(0, 1), at(300, 2)], "ticker string, ts timestamp, price int, qty int, seq int"), 0)
    second = spark.createDataFrame(
        [at(239, 3), at(240, 4), at(500, 5), at(None, 6)],
        "ticker string, ts timestamp, price int, qty int, seq int",
    )
    split(second, 1)
    assert sorted(r.price for r in kept) == [1, 2, 4, 5]
    assert sorted(r.price for r in streaming.late_rows(spark, path).collect()) == [3, 6]
    got = sorted(tuple(r) for r in streaming.account(spark, path).collect())
    assert got == [(0, 2, 2, 0), (1, 4, 2, 2)]

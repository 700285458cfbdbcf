"""Measures under a date slicer: from monthly partials and cut months alone."""

import math
from datetime import date, timedelta

import pytest

from barline.operators import cube, measures
from barline.plans.landing import new_path
from tests.test_ledger import FACT
from tests.test_plans import plan


def rows():
    out = []
    for k, (ticker, first, days) in enumerate(
        [("a", date(2020, 1, 5), 200), ("b", date(2020, 2, 1), 29), ("c", date(2020, 3, 31), 1), ("off", date(2020, 4, 2), 90)]
    ):
        for i in range(days):
            x = math.sin(i * (k + 1)) / 50
            pos = (i * 7 + k) % 3 - 1
            ret = None if i % 11 == 5 else x
            out.append((first + timedelta(i), ticker, pos, 1.0, ret, x / 2, i / 100, -i / 90, x, 0.001, 0.002, 0.0, i + 1, days))
    return out


@pytest.fixture(scope="module")
def stored(spark):
    fact = spark.createDataFrame(rows(), FACT).repartition(5)
    dim = spark.createDataFrame(
        [("a", "equity", "tech"), ("b", "equity", "food"), ("c", "gold", "metal"), ("idle", "gold", "metal")],
        "ticker string, asset_class string, sector string",
    )
    path = new_path(spark, "cube")
    cube.store_cube(fact, path)
    return fact, dim, path


def close(got, want):
    got, want = [sorted(map(tuple, d.collect()), key=str) for d in (got, want)]
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert math.isclose(x, y, abs_tol=1e-9) if isinstance(x, float) and isinstance(y, float) else x == y


@pytest.mark.parametrize("where", [None, "asset_class = 'equity'"])
@pytest.mark.parametrize(
    "start,end",
    [
        (None, None),
        (date(2020, 1, 20), date(2020, 5, 10)),
        (date(2020, 2, 1), date(2020, 4, 30)),
        (date(2020, 2, 10), date(2020, 2, 20)),
        (date(2020, 3, 31), date(2020, 3, 31)),
        (None, date(2020, 3, 15)),
        (date(2020, 3, 2), None),
        (date(2019, 1, 1), date(2019, 6, 6)),
        (date(2020, 5, 20), date(2020, 2, 10)),
    ],
)
def test_a_range_equals_the_measures_over_its_rows(spark, stored, start, end, where):
    fact, dim, path = stored
    inside = fact
    if start:
        inside = inside.where(inside.dt >= start)
    if end:
        inside = inside.where(inside.dt <= end)
    close(cube.kpi_scorecard_between(spark, path, dim, start, end, where), measures.kpi_scorecard(inside, dim, where))
    close(cube.perf_by_asset_between(spark, path, dim, start, end, where), measures.perf_by_asset(inside, dim, where))


def test_only_cut_months_are_read_from_the_fact(spark, stored):
    _, _, path = stored
    summary = cube.summary_between(spark, path, date(2020, 1, 20), date(2020, 5, 10))
    text = plan(summary)
    assert text.count("Scan parquet") == 2
    scan = next(x for x in text.splitlines() if "Scan parquet" in x and "net_ret" in x and "pos" in x)
    assert "PartitionFilters" in scan and "month IN (2020-01-01,2020-05-01)" in scan.replace("month#", "month")
    assert plan(cube.summary_between(spark, path, date(2020, 2, 1), date(2020, 4, 30))).count("Scan parquet") == 1
    assert cube.cut_months(date(2020, 1, 20), date(2020, 1, 25)) == [date(2020, 1, 1)]
    assert cube.cut_months(date(2020, 2, 1), date(2020, 2, 29)) == []


def test_changed_months_replace_their_rows_alone(spark, stored):
    fact, dim, _ = stored
    path = new_path(spark, "cube")
    cube.store_cube(fact.where("dt < '2020-06-10'"), path)
    cube.store_cube(fact.where("dt >= '2020-06-01'"), path)
    close(cube.perf_by_asset_between(spark, path, dim), measures.perf_by_asset(fact, dim))

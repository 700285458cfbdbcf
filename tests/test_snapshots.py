"""Tables replaced through a pointer."""

from __future__ import annotations

import pytest

from barline import sources
from barline.plans.landing import hadoop_path, new_path
from barline.sources import snapshots


def values(df):
    return sorted(r.v for r in df.collect())


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def test_a_reader_sees_the_old_table_or_the_new_one(spark, monkeypatch):
    path = new_path(spark, "snapshots")
    sources.replace_snapshot(numbers(spark, 2), path)
    old = sources.read_snapshot(spark, path)
    seen = []
    point = snapshots.point_at
    monkeypatch.setattr(
        snapshots, "point_at", lambda *a: (seen.append(values(sources.read_snapshot(spark, path))), point(*a))
    )
    sources.replace_snapshot(numbers(spark, 3), path)
    assert seen == [[0, 1]]  # written, not yet named
    assert values(sources.read_snapshot(spark, path)) == [0, 1, 2]
    assert values(old) == [0, 1]  # a reader that has begun goes on


def test_a_failed_write_leaves_the_table(spark):
    path = new_path(spark, "snapshots")
    sources.replace_snapshot(numbers(spark, 2), path)
    broken = numbers(spark, 3).selectExpr("cast(assert_true(v < 1) as int) AS x", "v")
    with pytest.raises(Exception, match="assert|ASSERT|USER_RAISED"):
        sources.replace_snapshot(broken, path)
    assert values(sources.read_snapshot(spark, path)) == [0, 1]


def test_a_table_replaced_from_itself_and_old_ones_expire(spark):
    path = new_path(spark, "snapshots")
    sources.replace_snapshot(numbers(spark, 4), path)
    for _ in range(3):
        sources.replace_snapshot(sources.read_snapshot(spark, path).where("v <> 3"), path, keep=2)
    assert values(sources.read_snapshot(spark, path)) == [0, 1, 2]
    fs, folder = hadoop_path(spark, f"{path}/snapshots")
    assert len(fs.listStatus(folder)) == 2


def test_two_writers_of_one_number(spark, monkeypatch):
    """The second one finds the number taken and takes the next."""
    path = new_path(spark, "snapshots")
    sources.replace_snapshot(numbers(spark, 1), path)
    real, calls = snapshots._pointers, []

    def stale(session, where):
        calls.append(1)
        return [] if len(calls) == 1 else real(session, where)

    monkeypatch.setattr(snapshots, "_pointers", stale)
    sources.replace_snapshot(numbers(spark, 5), path)
    assert [n for n, _ in real(spark, path)] == [1, 2]
    assert values(sources.read_snapshot(spark, path)) == [0, 1, 2, 3, 4]


def test_no_table(spark):
    with pytest.raises(FileNotFoundError):
        sources.read_snapshot(spark, new_path(spark, "snapshots"))

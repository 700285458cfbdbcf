"""Tables replaced in one step: snapshots and a pointer.

A table is a folder of snapshots, each written whole and never changed, and a folder of
pointers, one small file per replacement named ``{number}-{snapshot}``. The pointer with the
largest number names the table; it is created, never renamed or rewritten, which file systems and
object stores alike do in one step. A reader resolves the pointer first, so it sees the
snapshot before a replacement or after it; a failed write leaves no pointer. Two writers
that meet take numbers one after the other: the last to create its pointer wins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barline.plans.landing import hadoop_path

KEEP = 2


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, snapshot), oldest first."""
    fs, folder = hadoop_path(spark, f"{path}/pointers")
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return sorted((int(n), s) for n, _, s in (name.partition("-") for name in names) if n.isdigit())


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table now."""
    found = _pointers(spark, path)
    return f"{path}/snapshots/{found[-1][1]}" if found else None


def replace_snapshot(df: DataFrame, path: str, keep: int = KEEP, fmt: str = "parquet") -> str:
    """Make ``df`` the table at ``path``; it may read the table it replaces.

    The last ``keep`` snapshots stay for readers that have resolved them; older ones expire.
    """
    spark, path, name = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    df.write.mode("errorifexists").format(fmt).save(f"{path}/snapshots/{name}")
    point_at(spark, path, name)
    expire_snapshots(spark, path, keep)
    return f"{path}/snapshots/{name}"


def point_at(spark: SparkSession, path: str, name: str) -> int:
    """Create the next pointer; a number that another writer has taken meanwhile is skipped."""
    number = max((n for n, _ in _pointers(spark, path)), default=0) + 1
    while True:
        fs, marker = hadoop_path(spark, f"{path}/pointers/{number:012d}-{name}")
        fs.create(marker, False).close()
        if [n for n, _ in _pointers(spark, path)].count(number) == 1:
            return number
        fs.delete(marker, False)
        number += 1


def expire_snapshots(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete all but the last ``keep`` pointers and the snapshots only older ones name."""
    found = _pointers(spark, path)
    old, living = found[:-keep] if keep else found, {name for _, name in found[-keep:]}
    for number, name in old:
        fs, marker = hadoop_path(spark, f"{path}/pointers/{number:012d}-{name}")
        fs.delete(marker, False)
        if name not in living:
            _, folder = hadoop_path(spark, f"{path}/snapshots/{name}")
            fs.delete(folder, True)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    folder = current_snapshot(spark, path.rstrip("/"))
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.format(fmt).load(folder)

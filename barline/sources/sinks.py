"""Table sinks with replace semantics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barline.plans.landing import hadoop_path


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write ``df`` to ``path``, replacing what is there.

    The table is written beside ``path`` and takes its place when it is whole, so a
    failed job leaves the old one; ``df`` may even read the table it replaces.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, former = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    writer = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    fs, target = hadoop_path(spark, path)
    _, beside = hadoop_path(spark, fresh)
    _, aside = hadoop_path(spark, former)
    try:
        writer.save(fresh)
    except Exception:
        fs.delete(beside, True)
        raise
    there = fs.exists(target)
    if there and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside; the new table is {fresh}")
    if not fs.rename(beside, target):
        raise OSError(f"cannot move {fresh} to {path}; the old table is {former}")
    if there:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)

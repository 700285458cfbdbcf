"""Tables written between stages.

A stage whose result is read more than once is written to the shared folder the
cluster names in ``spark.checkpoint.dir`` and read back: the lineage ends there,
a lost executor costs a re-read instead of a re-run, and the next stage sees real
file sizes, which is what Spark's own broadcast check goes by. Landed tables go with
the session, or earlier through ``drop_landed``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Application id -> paths written so far.
_landed: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse.

    A local warehouse serves a local master only; elsewhere it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if folder.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder}/landed"


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; what is written there goes with the session."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _landed.setdefault(spark.sparkContext.applicationId, []).append(path)
    fs, target = hadoop_path(spark, path)
    fs.deleteOnExit(target)
    return path


def land(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    ``compression`` is a parquet codec, by default that of the session.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def landed(spark: SparkSession) -> list[str]:
    """Paths given out in this session and not dropped yet, oldest first."""
    return list(_landed.get(spark.sparkContext.applicationId, ()))


def drop_landed(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Delete landed tables; only those that no unfinished result reads any more."""
    known = _landed.get(spark.sparkContext.applicationId, [])
    for path in list(known if paths is None else paths):
        if path in known:
            fs, target = hadoop_path(spark, path)
            fs.delete(target, True)
            known.remove(path)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and its path object."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target

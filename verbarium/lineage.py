"""Cutting lineage with written tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_live: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder for cut tables.

    It is the session's ``spark.checkpoint.dir``. Where that is unset a temporary folder is made, but only
    for a local master; on a cluster an unset folder is an error, since executors could not see a local one.
    """
    if named := spark.conf.get(_SETTING, None):
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        _own[app] = "file://" + tempfile.mkdtemp(prefix="verbarium-")
    return _own[app]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_and_count(df: DataFrame, condition: str) -> tuple[DataFrame, int]:
    """:func:`cut`, with the number of rows for which ``condition`` holds, counted while writing."""
    seen = Observation()
    back = cut(df.observe(seen, F.count_if(F.expr(condition)).alias("n")))
    return back, seen.get["n"]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: plan and lineage start afresh there.

    The files outlive lost executors. They are deleted by :func:`drop`, :func:`release` or at exit.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    _live[path] = spark
    return back


def drop(*tables: DataFrame | None) -> None:
    """Delete the files of tables made by :func:`cut` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_cut_path", None)
        if path in _live:
            _delete(_live.pop(path), path)


def release(spark: SparkSession) -> None:
    """Delete all cut tables of this session; results that still read them must have been written."""
    for path in [p for p, s in _live.items() if s is spark]:
        _live.pop(path)
        _delete(spark, path)


@atexit.register
def _at_exit() -> None:
    for path, spark in list(_live.items()):
        try:
            if spark.sparkContext._jsc.sc().isStopped():
                continue
            _delete(spark, path)
        except Exception:  # the JVM may be gone already
            return

"""Cutting lineage with tables in the cluster's shared folder.

A job that iterates or reads one intermediate result several times writes it once to the folder
named in ``spark.checkpoint.dir``, which every executor shares, and goes on from that table: a lost
executor then costs a re-read and nothing else. Only a session whose executors run in this process
(master ``local``) may do without the setting; it gets a temporary folder of this machine. On any
other master a missing setting is an error, since executors would write to their own disks.

Intermediate tables lie under ``newsloom/<application id>`` and are deleted when the application
ends; what an application left behind can be deleted by that name.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: dict[str, list[str]] = {}
_watched: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``; on a local master else one temporary folder per application."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise RuntimeError(f"spark.checkpoint.dir is not set: on master {master} intermediate tables need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="newsloom-")
        atexit.register(_remove_local, _own[app])
    return "file://" + _own[app]


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate table of this application; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/newsloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    forget_at_end(spark, path)
    return path


def forget_at_end(spark: SparkSession, path: str) -> None:
    """Have ``path`` deleted when the application ends."""
    app = spark.sparkContext.applicationId
    _written.setdefault(app, []).append(path)
    if app not in _watched:
        _watched.add(app)
        atexit.register(_at_end, spark, app)


def _at_end(spark: SparkSession, app: str) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId == app:
        drop_materialized(spark)
        _delete(spark, f"{shared_dir(spark)}/newsloom/{app}")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(df: DataFrame, label: str = "part") -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table, free of the plan that made it."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._newsloom_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing still to be computed reads, as those of an earlier round."""
    for t in tables:
        path = getattr(t, "_newsloom_path", None)
        if path:
            _delete(t.sparkSession, path)
            kept = _written.get(t.sparkSession.sparkContext.applicationId, [])
            if path in kept:
                kept.remove(path)


def retain(table: DataFrame) -> DataFrame:
    """Keep a table of :func:`materialize` until the application ends, also through :func:`drop_materialized`."""
    kept = _written.get(table.sparkSession.sparkContext.applicationId, [])
    if table._newsloom_path in kept:
        kept.remove(table._newsloom_path)
    return table


def drop_materialized(spark: SparkSession) -> None:
    """Delete every intermediate table this application wrote so far."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)

"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage (a lost executor re-reads files instead of recomputing
the plan behind them) and has a known size, so a broadcast can be decided on a
measured number instead of an estimate.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCK = threading.Lock()
_LOCAL_ROOTS: dict[str, str] = {}
_SCOPE = threading.local()


def stage_root(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, the checkpoint folder of the context; and in local mode, as in
    tests, a temporary folder that goes with the process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    with _LOCK:
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="creditloom-")
            atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
        return _LOCAL_ROOTS[app]


def stage_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the staging folder."""
    app = spark.sparkContext.applicationId
    path = f"{stage_root(spark)}/creditloom/{app}/{label}-{uuid.uuid4().hex}"
    getattr(_SCOPE, "paths", []).append(path)
    return path


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table, once nothing reads them any more."""
    spark = df.sparkSession
    root = f"{stage_root(spark)}/creditloom/"
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    _delete(spark, [folder for folder in folders if root.lstrip("/") in folder])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Stage what ``make`` returns, and delete what it staged on the way."""
    path = stage_path(spark, label)
    with scope(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside when it is left.

    For steps that end in a written table of their own: what they return must not read a
    staged one. Scopes may be nested.
    """
    outer = getattr(_SCOPE, "paths", None)
    _SCOPE.paths = []
    try:
        yield
    finally:
        _delete(spark, _SCOPE.paths)
        if outer is None:
            del _SCOPE.paths
        else:
            _SCOPE.paths = outer

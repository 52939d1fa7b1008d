"""History on disk: one folder per batch, split by ``is_current``.

Batch *n* writes the current slice and the versions it closed, nothing else. Closed
versions of earlier batches stay where they are, so the cost of a batch follows the
current slice and not the length of the history. Running a batch again replaces its
folder with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FOLDERS = "batch int, is_current string"
_META = (
    "row_hash string, valid_from timestamp, valid_to timestamp, "
    "is_deleted_in_source boolean, sk_id string"
)


def history_schema(record: str) -> str:
    """Columns of a stored history, given the columns of its records."""
    return f"{record}, {_META}"


def publish(versions: DataFrame, path: str, batch: int) -> None:
    """Write the outcome of a batch (see ``operators.history.advance``)."""
    versions.write.mode("overwrite").partitionBy("is_current").parquet(f"{path}/batch={batch}")


def read_history(
    spark: SparkSession, path: str, batch: int, schema: str | None = None
) -> DataFrame:
    """The whole history as of a batch.

    Superseded current slices are pruned by folder. Without a schema the columns of
    all files are merged, which reads every footer.
    """
    live = F.col("is_current") == "true"
    superseded = live & (F.col("batch") < batch)
    return _typed(
        _read(spark, path, path, schema).filter((F.col("batch") <= batch) & ~superseded)
    )


def read_current(
    spark: SparkSession, path: str, batch: int, schema: str | None = None
) -> DataFrame:
    """Only the current slice of a batch; other folders are not even listed."""
    slice_ = _read(spark, path, f"{path}/batch={batch}", schema)
    return _typed(slice_.filter(F.col("is_current") == "true"))


def read_batch(spark: SparkSession, path: str, batch: int, schema: str | None = None) -> DataFrame:
    """All that one batch wrote: its current slice and the versions it closed."""
    return _typed(_read(spark, path, f"{path}/batch={batch}", schema))


def last_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the last batch of a history, None before the first; lists one folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), default=None)


def _read(spark: SparkSession, root: str, path: str, schema: str | None) -> DataFrame:
    reader = spark.read.option("basePath", root)
    if schema is None:
        reader = reader.option("mergeSchema", "true")
    else:
        reader = reader.schema(T.StructType.fromDDL(f"{schema}, {_FOLDERS}"))
    return reader.parquet(path)


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("is_current", F.col("is_current") == "true").drop("batch")

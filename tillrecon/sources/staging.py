"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders staged since the outermost open scope began.
_open: list[list[tuple[SparkSession, str]]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Without one, a session whose executors are threads of the driver gets a local folder; any other
    session is refused, since its executors could not read what another machine has written.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tillrecon-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/tillrecon/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append((spark, path))
    return path


@contextmanager
def scope():
    """Remove, at the end, what was staged within: for runs that write their results elsewhere."""
    _open.append([])
    try:
        yield
    finally:
        for spark, path in _open.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    What follows reads stored rows: no step before is repeated, and the loss of an executor cannot
    change values that depend on the run, such as partition numbers.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def stage_bucketed(df: DataFrame, name: str, buckets: int, column: str) -> DataFrame:
    """As :func:`stage`, bucketed by ``column``: sums and windows by it need no exchange of the stored rows.

    Spark writes buckets through its catalog only; the table is unnamed again at once, its files stay.
    """
    spark = df.sparkSession
    table = f"staged_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", new_folder(spark, name)).saveAsTable(table)
    out = spark.table(table).select("*")
    spark.sql(f"DROP TABLE {table}")
    return out


def input_bytes(staged: DataFrame) -> int:
    """Bytes of the files of a table that :func:`stage` returned."""
    where = staged.sparkSession._jvm.org.apache.hadoop.fs.Path(staged.staged_at)
    file_system = where.getFileSystem(staged.sparkSession._jsc.hadoopConfiguration())
    return file_system.getContentSummary(where).getLength()

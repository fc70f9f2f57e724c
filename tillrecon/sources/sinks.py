"""Sinks: tables, CSV files, validated publication."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillrecon import fixed


def write_tables(tables: Mapping[str, DataFrame], folder: str, partition_by=None) -> dict[str, str]:
    """Write named DataFrames as Parquet below ``folder``; ``partition_by`` maps name to columns."""
    paths = {}
    for name, df in tables.items():
        writer = df.write
        columns = (partition_by or {}).get(name)
        if columns:
            writer = writer.partitionBy(*columns)
        paths[name] = f"{folder}/{name}"
        writer.parquet(paths[name])
    return paths


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables as :func:`write_tables` wrote them. Directories are text, but for the year: a shop may be called 001."""
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        found = {name: spark.read.parquet(f"{folder}/{name}") for name in names}
    finally:
        spark.conf.set(inference, before)
    whole = lambda df: df.withColumn("year", F.col("year").cast("int")) if "year" in df.columns else df
    return {name: whole(df) for name, df in found.items()}


def export_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
    separator: str = fixed.CSV_SEPARATOR,
) -> None:
    """Write ``columns`` in that order, NULL as nothing, one directory per ``partition_by`` value.

    With ``order_by`` the rows are range-partitioned first, so that the files of a directory follow
    each other in order and a directory with most of the rows is written by many tasks.
    """
    keys = [*partition_by, *order_by]
    if order_by:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = [*columns, *(c for c in partition_by if c not in columns)]
    writer = df.select(*kept).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    (
        writer.option("sep", separator)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def publish_if_valid(
    spark: SparkSession,
    root: str,
    write: Callable[[str], None],
    validate: Callable[[str], None],
    publish: bool = True,
    keep: int | None = None,
) -> str:
    """Write into a new run folder, validate it there, and make it current only if that passes.

    Readers find the current run through :func:`current_run`. A failing run is removed and leaves
    the last published one in place. Of published runs the last ``keep`` stay, all without it.
    """
    root = root.rstrip("/")
    run = f"{root}/runs/{uuid.uuid4().hex}"
    try:
        write(run)
        validate(run)
        if publish:
            publish_run(spark, root, run)
    except Exception:
        _remove(spark, run)
        raise
    if publish and keep is not None:
        retain(spark, root, keep)
    return run


def publish_run(spark: SparkSession, root: str, run: str) -> int:
    """Give ``run`` the next number; returns it.

    A number is a file that only one publisher can create, whoever else publishes at the same time; who comes
    second tries the next number. So the order of runs does not depend on any clock.
    """
    number = max(_published(spark, root), default=0) + 1
    while not _create(spark, f"{root}/published/{number:012d}", run):
        number += 1
    return number


def current_run(spark: SparkSession, root: str) -> str | None:
    """Folder of the run with the highest number."""
    root = root.rstrip("/")
    for number in sorted(_published(spark, root), reverse=True):
        if run := _run_of(spark, root, number):
            return run
    return None


def retain(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove published runs but the last ``keep``, and then their numbers; returns what was removed."""
    if keep < 1:
        raise ValueError("the current run can't be removed")
    root = root.rstrip("/")
    runs = [(n, run) for n in sorted(_published(spark, root), reverse=True) if (run := _run_of(spark, root, n))]
    staying, removed = {run for _, run in runs[:keep]}, []
    for number, run in runs[keep:]:
        if run not in staying:
            _remove(spark, run)
            removed.append(run)
        _remove(spark, f"{root}/published/{number:012d}")
    return removed


def _published(spark: SparkSession, root: str) -> list[int]:
    """Numbers given so far: as many as there are published runs."""
    folder, file_system = _file_system(spark, f"{root}/published")
    if not file_system.exists(folder):
        return []
    names = [s.getPath().getName() for s in file_system.listStatus(folder)]
    return [int(n) for n in names if n.isdigit()]


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with one line, unless there is one; only one of several callers succeeds."""
    where, file_system = _file_system(spark, path)
    file_system.mkdirs(where.getParent())
    raw = file_system.getRawFileSystem() if file_system.getUri().getScheme() == "file" else None
    if raw is not None:
        # Hadoop looks and then creates on a local disk; the JVM does both at once.
        if not raw.pathToFile(where).createNewFile():
            return False
        stream = raw.create(where, True)
    else:
        try:
            stream = file_system.create(where, False)
        except Exception as error:
            if file_system.exists(where):
                return False
            raise error
    stream.write(f"{text}\n".encode())
    stream.close()
    return True


def _run_of(spark: SparkSession, root: str, number: int) -> str | None:
    """The run behind a number; None while its publisher is still writing it, or never came to it."""
    where, file_system = _file_system(spark, f"{root}/published/{number:012d}")
    stream = file_system.open(where)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path, file_system = _file_system(spark, path)
    file_system.delete(hadoop_path, True)

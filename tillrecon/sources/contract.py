"""Staged CSV files with a contractual header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillrecon import fixed
from tillrecon.operators.checks import describe


def header_verdicts(
    spark: SparkSession, path: str, schema: T.StructType | str, separator: str = fixed.CSV_SEPARATOR
) -> DataFrame:
    """First line of every file against the schema's names: file, header, verdict.

    ``exact``, ``case`` (right but for upper and lower case) or ``wrong``. Partition columns are no
    part of a header.
    """
    lines = spark.read.text(path)
    inside = [c for c in T._parse_datatype_string(schema).names] if isinstance(schema, str) else schema.names
    names = [c for c in inside if c not in lines.columns]
    wanted = separator.join(names)
    first = F.min_by("value", "_at").alias("header")
    found = (
        lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        .filter("start = 0")
        .withColumn("_at", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(first)
    )
    header = F.rtrim(F.replace(F.col("header"), F.lit("\ufeff"), F.lit("")), F.lit("\r"))
    verdict = F.when(header == wanted, "exact").when(F.lower(header) == wanted.lower(), "case").otherwise("wrong")
    return found.select("file", header.alias("header"), verdict.alias("verdict"))


def read_contract_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, separator: str = fixed.CSV_SEPARATOR
) -> DataFrame:
    """Read staged CSV. Headers are compared first: another one than the schema's names is an error.

    A bad value fails the job that reads it, whichever columns are asked for. ``path`` may hold
    partition directories (``shop=…/year=…``), whose columns come last.
    """
    others = header_verdicts(spark, path, schema, separator).filter("verdict <> 'exact'")
    found = describe(others, "file", "header")
    if found:
        raise ValueError(f"header is not the contract's in {found}")
    rows = (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .option("nullValue", "")
        .option("escape", '"')
        .csv(path)
    )
    # Always true, and needs every column: a column that is not parsed is not checked.
    return rows.filter(F.concat_ws("", *(F.col(c).cast("string") for c in rows.columns)) >= "")

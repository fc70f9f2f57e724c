"""Counters and control totals of outputs, and where each output comes from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tillrecon import fixed
from tillrecon.functions.money import french_number
from tillrecon.operators.tables import is_sale

VALUE_TYPE = "decimal(38,2)"


def _metric(name, value) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("metric"), value.cast(VALUE_TYPE).alias("value"))


def row_counts(**tables: DataFrame) -> DataFrame:
    """One metric per table: its number of rows."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").cast(VALUE_TYPE).alias("value")).select(
            F.lit(name).alias("metric"), "value"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def volume_metrics(
    tickets: DataFrame,
    type_: str = "type",
    number: str = "ticket_no",
    shop: str = "shop",
    ttc: str = "ttc",
    types=fixed.SALE_TYPES,
    returns=fixed.RETURN_TYPES,
) -> DataFrame:
    """Long (metric, value): blocks, sales, returns and their total, sales per shop, tickets per type.

    The tickets are read once and grouped by type and shop; every metric is a sum over those groups.
    """
    sale = is_sale(F.col(type_), F.col(number), types)
    returned = sale & F.col(type_).isin(*returns)
    groups = tickets.groupBy(F.col(type_).alias("type"), F.col(shop).alias("shop")).agg(
        F.count("*").alias("n"),
        F.count_if(sale).alias("sales"),
        F.count_if(returned).alias("returns"),
        F.sum(F.when(returned, F.col(ttc))).alias("returned"),
    )
    exploded = groups.select(
        F.inline(
            F.array(
                _metric("blocks", F.col("n")),
                _metric("sales", F.col("sales")),
                _metric("not_sales", F.col("n") - F.col("sales")),
                _metric("returns", F.col("returns")),
                _metric("returns_ttc", F.coalesce("returned", F.lit(0))),
                _metric(F.concat(F.lit("sales:"), F.coalesce("shop", F.lit(""))), F.col("sales")),
                _metric(F.concat(F.lit("type:"), F.coalesce("type", F.lit(""))), F.col("n")),
            )
        )
    )
    return exploded.groupBy("metric").agg(F.sum("value").cast(VALUE_TYPE).alias("value"))


def measures_of(df: DataFrame, quantities=(), rates=()) -> list[str]:
    """Columns that have a control total: decimals are amounts unless declared as rates; quantities are declared."""
    amounts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)} - set(rates)
    return [c for c in df.columns if c in amounts or c in set(quantities)]


def numeric_totals(df: DataFrame, columns) -> DataFrame:
    """Long (field, total): sum of each measure of an output."""
    if not columns:
        return df.sparkSession.createDataFrame([], f"field string, total {VALUE_TYPE}")
    sums = df.agg(*(F.sum(F.col(f"`{c}`")).cast(VALUE_TYPE).alias(c) for c in columns))
    # A column without any value has no total.
    return sums.unpivot([], [F.col(f"`{c}`") for c in columns], "field", "total").filter(
        F.col("total").isNotNull()
    )


def numeric_totals_long(rows: DataFrame, nature: str, measures) -> DataFrame:
    """As :func:`numeric_totals` where the natures sit on rows: field is ``nature / measure``."""
    named = rows.filter(F.coalesce(F.col(nature), F.lit("")) != "")
    sums = named.groupBy(nature).agg(*(F.sum(m).cast(VALUE_TYPE).alias(m) for m in measures))
    long = sums.unpivot([nature], list(measures), "_measure", "total").filter(
        F.col("total").isNotNull()
    )
    return long.select(F.concat_ws(" / ", nature, "_measure").alias("field"), "total")


def affected(sources: Mapping[str, Sequence[str]], changed) -> set[str]:
    """Outputs that come, directly or through others, from something that changed; ``sources`` per output."""
    stale = set(changed)
    while more := {output for output, given in sources.items() if output not in stale and stale.intersection(given)}:
        stale |= more
    return stale.intersection(sources)


def _hashed(value: Column, kind: T.DataType) -> list[Column]:
    """What tells a value apart in a hash: Spark's hashes pass over nulls, also those within arrays and structs."""
    flags = [value.isNull()]
    if isinstance(kind, T.StructType):
        return flags + [c for f in kind.fields for c in _hashed(value.getField(f.name), f.dataType)]
    if isinstance(kind, T.ArrayType):
        return [*flags, F.size(value), F.transform(value, lambda x: F.struct(*_hashed(x, kind.elementType)))]
    return [*flags, value]


def table_marks(by: Sequence[str] = (), **tables: DataFrame) -> DataFrame:
    """(name, *by, n, mark) of the content of each table and part, whatever the order of its rows.

    ``n`` is the number of rows, the mark tells it and a sum of hashes.
    """
    marks = None
    for name, df in tables.items():
        values = [v for c in sorted(df.columns) for v in _hashed(F.col(f"`{c}`"), df.schema[c].dataType)]
        hashed = F.sum(F.xxhash64(*values).cast("decimal(20,0)"))
        mark = F.concat_ws("-", F.count("*").cast("string"), hashed.cast("string"))
        one = df.groupBy(*by).agg(F.count("*").alias("n"), mark.alias("mark")).select(F.lit(name).alias("name"), *by, "n", "mark")
        marks = one if marks is None else marks.unionByName(one)
    return marks


def within(df: DataFrame, columns: Sequence[str], keys) -> Column:
    """Whether a row has one of ``keys`` in ``columns``; NULL is a value like others."""
    found = F.lit(False)
    for key in sorted(keys, key=repr):
        own = F.lit(True)
        for c, value in zip(columns, key, strict=True):
            own = own & F.col(c).eqNullSafe(F.lit(value).cast(df.schema[c].dataType))
        found = found | own
    return found


@contextmanager
def observing(spark: SparkSession):
    """While this holds, Spark keeps the parts of a plan that turn out empty: with them their counts would go."""
    rules = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(rules, None)
    spark.conf.set(rules, ",".join(filter(None, (before, "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(rules)
        else:
            spark.conf.set(rules, before)


def _metrics(observation: Observation) -> dict:
    """What was observed; nothing where Spark left a part out."""
    return observation.get if observation._jo.getRow().size() else {}


class Lineage:
    """Counters and sums taken by the writes of the outputs themselves, and the sources declared for each of them.

    Every place where an output reads a source has an observation of its own, so an output that reads a
    source twice counts it twice. Spark counts again what a lost task has to do again; :meth:`recount` tells
    such a count from a wrong one.
    """

    def __init__(self):
        self._counters: dict[tuple[str, str], list[tuple[Observation, DataFrame]]] = {}
        self._sums: dict[str, tuple[Observation, list[str]]] = {}
        self._edges: list[tuple[str, str]] = []

    def declare(self, output: str, *sources: str) -> None:
        self._edges.extend((output, source) for source in sources)

    def observed(self, df: DataFrame, output: str, counter: str, sums: Sequence[str] = ()) -> DataFrame:
        """Count rows that pass here (``read``, ``selected``, ``kept`` or ``written``), and add up columns, during the write."""
        observation = Observation()
        self._counters.setdefault((output, counter), []).append((observation, df))
        if sums:
            self._sums[output] = (observation, list(sums))
        totals = (F.sum(F.col(f"`{c}`")).cast(VALUE_TYPE).alias(f"sum{i}") for i, c in enumerate(sums))
        return df.observe(observation, F.count("*").alias("n"), *totals)

    def count(self, output: str, counter: str) -> int:
        """What a write has counted."""
        return sum(_metrics(obs).get("n", 0) for obs, _ in self._counters.get((output, counter), ()))

    def counts(self, spark: SparkSession) -> DataFrame:
        """(output, counter, n) of everything written so far; one row per counter."""
        rows = [(o, c, self.count(o, c)) for o, c in self._counters]
        return spark.createDataFrame(rows, "output string, counter string, n bigint")

    def totals(self, spark: SparkSession) -> DataFrame:
        """(output, field, total) of the columns added up; a column without any value has no total."""
        found = [
            (output, field, total)
            for output, (obs, fields) in self._sums.items()
            for i, field in enumerate(fields)
            if (total := _metrics(obs).get(f"sum{i}")) is not None
        ]
        return spark.createDataFrame(found, f"output string, field string, total {VALUE_TYPE}")

    def recount(self, output: str, counter: str) -> int:
        """The rows that pass where ``counter`` is taken, counted by jobs of their own."""
        return sum(df.count() for (o, c), places in self._counters.items() if o == output and c.startswith(counter) for _, df in places)

    def edges(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._edges, "output string, source string")


def lineage(
    written: DataFrame,
    edges: DataFrame,
    selected: DataFrame | None = None,
    read: DataFrame | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Per output: rows read, selected and written, and taken over from an earlier run if ``kept`` is given.

    ``written`` (output, n); ``edges`` (output, source); ``selected`` (output, n) where an output
    filters its sources, otherwise everything read counts as selected; ``read`` (output, n) where reading
    was observed, otherwise what the immediate sources wrote. An output of which parts are ``kept`` (output, n) reads
    what was observed, even if that is nothing.
    """
    source_rows = edges.join(
        written.select(F.col("output").alias("source"), F.col("n").alias("_n")), "source", "left"
    )
    available = source_rows.groupBy("output").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_read"))
    rows = written.withColumnRenamed("n", "n_written").join(available, "output", "left")
    if read is not None:
        rows = rows.join(read.withColumnRenamed("n", "_read"), "output", "left")
        nothing = F.lit(None)
        if kept is not None:
            rows = rows.join(kept.withColumnRenamed("n", "n_kept"), "output", "left")
            nothing = F.when(F.col("n_kept").isNotNull(), 0)
        rows = rows.withColumn("n_read", F.coalesce("_read", nothing, "n_read")).drop("_read")
    if selected is not None:
        rows = rows.join(selected.withColumnRenamed("n", "_selected"), "output", "left")
    else:
        rows = rows.withColumn("_selected", F.lit(None).cast("bigint"))
    n_read = F.coalesce("n_read", F.lit(0)).cast("bigint")
    return rows.select(
        "output",
        n_read.alias("n_read"),
        F.coalesce(F.col("_selected"), n_read).cast("bigint").alias("n_selected"),
        *([F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept")] if "n_kept" in rows.columns else []),
        F.col("n_written").cast("bigint").alias("n_written"),
    )


def rows_of_year(df: DataFrame, year: int, column: str = "year") -> DataFrame:
    """What a comparison of one year selects from a source."""
    return df.filter(F.col(column) == year)


def check_lineage(counters: DataFrame, edges: DataFrame) -> DataFrame:
    """Outputs that claim to have read more rows than their immediate sources wrote."""
    written = counters.select(F.col("output").alias("source"), "n_written")
    bound = (
        edges.join(written, "source", "left")
        .groupBy("output")
        .agg(F.coalesce(F.sum("n_written"), F.lit(0)).alias("n_available"))
    )
    return (
        counters.join(bound, "output")
        .filter(F.col("n_read") > F.col("n_available"))
        .select("output", "n_read", "n_available")
    )


def run_report(counters: DataFrame, edges: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per output with sources, counters and its control totals as report text.

    ``totals`` (output, field, total). An output has a handful of sources and fields, so its report
    is one row.
    """
    sources = edges.groupBy("output").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    line = F.concat_ws(": ", "field", french_number(F.col("total")))
    fields = totals.groupBy("output").agg(F.array_sort(F.collect_list(line)).alias("totals"))
    return (
        counters.join(sources, "output", "left")
        .join(fields, "output", "left")
        .select(
            "output",
            F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
            *(c for c in counters.columns if c != "output"),
            F.coalesce("totals", F.array().cast("array<string>")).alias("totals"),
        )
    )

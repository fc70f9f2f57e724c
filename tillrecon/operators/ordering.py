"""Operators that look along an ordered sequence: previous row, fill-down, position.

A window over a shop would put the whole shop into one task. Instead the rows are range-partitioned
on (group, order), so that one big group spans many partitions ("chunks") of bounded size. The result is
written once, bucketed by chunk: Spark knows that a chunk lies in one task, so windows and sums by chunk
and group read the stored rows without moving them again. What has to cross from one chunk to
the next is one value per chunk and group, taken from a small summary. The order must end in columns
that make it unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillrecon.sources.staging import input_bytes, stage, stage_bucketed

CHUNK, PLACE = "_chunk", "_place"
# Compressed bytes of a chunk, and chunks at least.
CHUNK_BYTES, LEAST_CHUNKS = 64 << 20, 8


def lay_out(df: DataFrame, by, order, chunks: int | None = None) -> DataFrame:
    """Store ``df`` in ordered chunks: bucketed by chunk, each row with its chunk and place.

    The rows are written first. Range bounds come from a sample, so what leads to the rows would run
    twice; and their bytes tell the number of chunks, which ``chunks`` fixes instead. So the size of a chunk
    does not grow with the data.
    """
    rows = stage(df, "unordered")
    if chunks is None:
        chunks = max(LEAST_CHUNKS, -(-input_bytes(rows) // CHUNK_BYTES))
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    ordered = rows.repartitionByRange(chunks, *keys).sortWithinPartitions(*keys)
    placed = ordered.withColumns({CHUNK: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()})
    return stage_bucketed(placed, "ordered", chunks, CHUNK)


def _within(by) -> Window:
    return Window.partitionBy(CHUNK, *by).orderBy(PLACE)


def _carried(laid: DataFrame, by, summary: Column, carry) -> DataFrame:
    """Per (chunk, group) that continues an earlier chunk: what ``carry`` makes of the earlier summaries.

    ``summary`` is one value per chunk and group, found where the rows lie. Only a chunk's first group can
    continue: there is at most one row per chunk.
    """
    parts = laid.groupBy(CHUNK, *by).agg(summary.alias("_part"))
    earlier = Window.partitionBy(*by).orderBy(CHUNK)
    return (
        parts.withColumns(
            {
                "_carry": carry(F.col("_part"), earlier),
                "_follows": F.lag(F.lit(True)).over(earlier),
            }
        )
        .filter("_follows")
        .select(CHUNK, *by, "_carry")
    )


def _edge(column: str, only: Column | None = None) -> Column:
    """The row's value at the last place of a group, as a struct: a NULL there is a value as well."""
    edge = F.struct(F.col(PLACE), F.col(column).alias("value"))
    return F.max(edge if only is None else F.when(only, edge))


def _join_summary(rows: DataFrame, summary: DataFrame, by) -> DataFrame:
    """Join by chunk and group; a summary without a hint is broadcast if Spark finds it small enough."""
    small = summary.select(*(F.col(c).alias(f"_c{c}") for c in summary.columns))
    same = F.col(CHUNK) == F.col(f"_c{CHUNK}")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_c{c}"))
    return rows.join(small, same, "left")


def previous_in_order(
    df: DataFrame, by, order, column: str, alias: str, chunks: int | None = None
) -> DataFrame:
    """Add the value ``column`` has in the previous row of the same group."""
    laid = lay_out(df, by, order, chunks)
    within = _within(by)
    rows = laid.withColumns(
        {"_prev": F.lag(column).over(within), "_first": F.row_number().over(within) == 1}
    )
    carried = _carried(laid, by, _edge(column), lambda part, w: F.lag(part).over(w)["value"])
    joined = _join_summary(rows, carried, by)
    value = F.when(F.col("_first"), F.col("_c_carry")).otherwise(F.col("_prev"))
    return joined.select(*df.columns, value.alias(alias))


def fill_down(df: DataFrame, by, order, column: str, alias: str, chunks: int | None = None) -> DataFrame:
    """Add ``column`` with NULLs replaced by the last value before them in the same group."""
    laid = lay_out(df, by, order, chunks)
    upto = _within(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = laid.withColumn("_filled", F.last(column, ignorenulls=True).over(upto))
    carried = _carried(
        laid,
        by,
        _edge(column, F.col(column).isNotNull()),
        lambda part, w: F.last(part, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        )["value"],
    )
    joined = _join_summary(rows, carried, by)
    return joined.select(*df.columns, F.coalesce("_filled", "_c_carry").alias(alias))


def number_in_order(df: DataFrame, by, order, alias: str, chunks: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group.

    The rows of a group have consecutive places within a chunk, so a row's number is its place less
    the group's first place there, plus the rows of the group in earlier chunks. Both come from a
    summary of one row per chunk and group; the stored rows are not moved again.
    """
    laid = lay_out(df, by, order, chunks)
    parts = laid.groupBy(CHUNK, *by).agg(F.count("*").alias("_n"), F.min(PLACE).alias("_low"))
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_low")
    # Stored, so that Spark knows its size when it chooses the join.
    offsets = stage(parts.select(CHUNK, *by, offset.alias("_carry")), "offsets")
    joined = _join_summary(laid, offsets, by)
    return joined.select(*df.columns, (F.col(PLACE) + F.col("_c_carry")).cast("bigint").alias(alias))

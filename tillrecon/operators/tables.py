"""Selections and joins of the stored tables, and their contractual order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillrecon import fixed
from tillrecon.functions.money import amount_text, whole_text
from tillrecon.functions.periods import closing_period, iso_date
from tillrecon.functions.text import blank_to_null, holds, require_text

HEADER_ORDER = ("ticket_date", "ticket_time", "internal_no")
LINE_ORDER = (*HEADER_ORDER, "line_pos")
REPORT_ORDER = ("shop", "file_name", "line_pos")


def computed_once(df: DataFrame, keep, columns) -> DataFrame:
    """``df`` with ``keep`` and costly computed ``columns``.

    A filter on a plain projection is evaluated below it, on a second copy of the column's whole
    expression. Behind a generator that gives one row per row, later filters read the result.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def is_sale(type_: Column, ticket_no: Column, types=fixed.SALE_TYPES) -> Column:
    return type_.isin(*types) & blank_to_null(ticket_no).isNotNull()


def sales_only(
    tickets: DataFrame, type_col: str = "type", number: str = "ticket_no", types=fixed.SALE_TYPES
) -> DataFrame:
    """Tickets that are exported: a sale or a return with a ticket number."""
    return tickets.filter(is_sale(F.col(type_col), F.col(number), types))


def for_shop_year(df: DataFrame, shop=None, year=None, shop_col="shop", year_col="year") -> DataFrame:
    """Rows of one shop and one closing year; prunes partitions of tables laid out by them."""
    if shop is not None:
        df = df.filter(F.col(shop_col) == shop)
    if year is not None:
        df = df.filter(F.col(year_col) == year)
    return df


def ticket_lines_wide(lines: DataFrame, tickets: DataFrame, key: str = "block_id") -> DataFrame:
    """Every line with its ticket's header. Adaptive execution splits a ticket with too many lines."""
    return lines.join(tickets, key)


def report_rows(lines: DataFrame, headers: DataFrame, key: str = "report_id") -> DataFrame:
    """Every report row with its report's header."""
    return lines.join(headers, key)


def with_closing_period(reports: DataFrame, file_name: str = "file_name", on_missing="fail") -> DataFrame:
    """Add ``year`` and ``period`` of the closing named in the file name."""
    found = closing_period(F.col(file_name), "null")
    if on_missing == "fail":
        message = F.concat(F.lit("no closing period in file name: "), F.col(file_name))
        reports = reports.filter(holds(found["period"].isNotNull(), message))
    # The struct is a projection of its own, so the file name is searched once.
    return reports.withColumn("_closing", found).select(
        *reports.columns, F.col("_closing.year").alias("year"), F.col("_closing.period").alias("period")
    )


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Totally ordered output; NULLs first, as in the staged files."""
    return df.orderBy(*(F.col(c).asc_nulls_first() for c in columns))


def contract_text(
    df: DataFrame, identifiers=(), dates=(), amounts=(), quantities=()
) -> DataFrame:
    """Rows in the text form of the staged files: ISO dates, two-decimal amounts, whole quantities.

    Identifiers must still be text. NULL becomes empty text, a value without such a form fails the job.
    """
    require_text(df, identifiers)
    as_date = lambda c: F.coalesce(iso_date(F.col(c).cast("string")).cast("string"), F.lit(""))
    return df.withColumns(
        {
            **{c: as_date(c) for c in dates},
            **{c: amount_text(F.col(c)) for c in amounts},
            **{c: whole_text(F.col(c)) for c in quantities},
        }
    )

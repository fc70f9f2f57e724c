"""Closing reports: keyed header, blank line, quoted rows. Parsed inside the file's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillrecon import fixed
from tillrecon.functions.money import money, whole_number
from tillrecon.functions.periods import printed_date
from tillrecon.functions.text import fail_unless, strip, text_lines, unix_lines
from tillrecon.operators.tables import computed_once

HEADER = (
    "model",
    "machine",
    "report",
    "file_code",
    "mode",
    "counter",
    "report_date",
    "report_time",
)
LINE = ("line_pos", "record_no", "designation", "qty", "amount")
# One field of a row: quoted with doubled inner quotes, or plain up to the comma.
_FIELD = r'(?:"((?:[^"]|"")*)"|(?!")([^,]*))'
_ROW = r"\A" + ",".join([_FIELD] * len(fixed.REPORT_COLUMNS)) + r"\z"


def _unquote(text: Column) -> Column:
    return F.regexp_replace(text, r'^[ "]+|[ "]+$', "")


def _row_fields(line: Column) -> list[Column]:
    """The four fields of a row; each of them sits in one of two groups, the other one is empty."""
    both = lambda i: F.concat(
        F.replace(F.regexp_extract(line, _ROW, 2 * i + 1), F.lit('""'), F.lit('"')),
        F.regexp_extract(line, _ROW, 2 * i + 2),
    )
    return [strip(both(i)) for i in range(len(fixed.REPORT_COLUMNS))]


def parse_reports(reports: DataFrame, text: str = "text") -> DataFrame:
    """Parse whole report texts into header columns, ``lines`` (array of struct) and ``errors``."""
    names = [c for c in reports.columns if c != text]
    cut = reports.select(
        *names, F.split(unix_lines(F.col(text)), r"\n\s*\n", 2).alias("_parts")
    ).select(
        *names,
        F.size("_parts").alias("_size"),
        text_lines(F.get("_parts", 0)).alias("_head"),
        text_lines(F.coalesce(F.get("_parts", 1), F.lit(""))).alias("_rows"),
    )
    head = cut.select(
        *names,
        "_size",
        F.size("_head").alias("_head_size"),
        F.transform(F.slice("_head", 1, len(HEADER)), lambda l: F.split(l, ",")).alias("_pairs"),
        F.get("_rows", 0).alias("_titles"),
        F.transform(
            F.slice("_rows", 2, F.greatest(F.size("_rows"), F.lit(1))),
            lambda l: F.struct(
                l.rlike(_ROW).alias("fits"),
                *(f.alias(n) for f, n in zip(_row_fields(l), ("record_no", "designation", "q", "m"))),
            ),
        ).alias("_fields"),
    )
    pair = lambda i: F.get(F.col("_pairs"), i)
    value = lambda i: _unquote(F.get(pair(i), 1))
    key_errors = [
        F.when(F.size(pair(i)) != 2, f"header:{key}:words").when(
            _unquote(F.get(pair(i), 0)) != key, f"header:{key}:key"
        )
        for i, key in enumerate(fixed.REPORT_HEADER_KEYS)
    ]
    columns = {n: value(i) for i, n in enumerate(HEADER)}
    columns["report_date"] = printed_date(columns["report_date"])
    titles = _row_fields(F.col("_titles"))
    titles_fit = F.col("_titles").rlike(_ROW)
    for found, expected in zip(titles, fixed.REPORT_COLUMNS):
        titles_fit = titles_fit & (found == expected)
    row_error = (
        lambda x: F.when(~x["fits"], "line:columns")
        .when(x["qty"].isNull(), "line:quantity")
        .when(x["amount"].isNull(), "line:amount")
    )
    read = head.select(
        *names,
        *(c.alias(n) for n, c in columns.items()),
        F.transform(
            "_fields",
            lambda x, i: F.struct(
                (i + 1).cast("int").alias("line_pos"),
                x["record_no"].alias("record_no"),
                x["designation"].alias("designation"),
                whole_number(x["q"]).alias("qty"),
                money(x["m"]).alias("amount"),
                x["fits"].alias("fits"),
            ),
        ).alias("_lines"),
        F.array_compact(
            F.array(
                F.when(F.col("_size") < 2, "separator:missing"),
                F.when(F.col("_head_size") < len(HEADER), "header:short"),
                *key_errors,
                F.when(~F.coalesce(titles_fit, F.lit(False)), "titles"),
            )
        ).alias("_broken"),
    )
    errors = F.array_distinct(
        F.concat(
            "_broken",
            F.when(
                (F.size("_broken") == 0) & F.col("report_date").isNull(),
                F.array(F.lit("header:DATE:date")),
            ).otherwise(F.array().cast("array<string>")),
            F.array_compact(F.transform("_lines", row_error)),
        )
    )
    lines = F.transform("_lines", lambda x: F.struct(*(x[n].alias(n) for n in LINE)))
    return computed_once(read, names, [*HEADER, lines.alias("lines"), errors.alias("errors")])


def reject_reports(parsed: DataFrame, mode: str = "fail", name: str = "file_name"):
    """As :func:`tillrecon.operators.journal.reject_blocks`, for reports."""
    valid = F.size("errors") == 0
    if mode == "quarantine":
        return parsed.filter(valid), parsed.filter(~valid)
    if mode != "fail":
        raise ValueError(f"unknown mode: {mode}")
    message = F.concat_ws(" ", F.lit("invalid report"), F.col(name), F.array_join("errors", ", "))
    return parsed.filter(fail_unless(valid, F.lit(True), message))


def parse_report_headers(parsed: DataFrame) -> DataFrame:
    return parsed.drop("lines")


def parse_report_lines(parsed: DataFrame, ids=("report_id",), carry=()) -> DataFrame:
    """Rows of parsed reports; ``carry`` keeps header columns, which replaces a join."""
    return parsed.select(*ids, *carry, F.inline("lines"))

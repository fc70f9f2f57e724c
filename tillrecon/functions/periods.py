"""Date, month and closing-period expressions. A period is text of the form ``yyyy-MM``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillrecon import fixed
from tillrecon.functions.text import fail_unless, full_match, strip

_DAY = r"(?: (?=[1-9](?!\d)))?(3[01]|[12]\d|0[1-9]|[1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_YEAR = r"(?!0000)(\d{4})"


def _date_by(text: Column, pattern: str, year_month_day: str) -> Column:
    whole = rf"\A{pattern}\z"
    return F.when(
        text.rlike(whole), F.try_to_date(F.regexp_replace(text, whole, year_month_day), "yyyy-M-d")
    )


def printed_date(text: Column) -> Column:
    """``dd-MM-yyyy`` to DATE, NULL when no such day exists."""
    return _date_by(strip(text), f"{_DAY}-{_MONTH}-{_YEAR}", "$3-$2-$1")


def iso_date(text: Column) -> Column:
    """ISO, compact or printed date text to DATE; anything else fails the job, blank is NULL."""
    cleaned = strip(text)
    found = F.coalesce(
        _date_by(cleaned, f"{_YEAR}-{_MONTH}-{_DAY}", "$1-$2-$3"),
        _date_by(cleaned, f"{_YEAR}{_MONTH}{_DAY}", "$1-$2-$3"),
        printed_date(cleaned),
    )
    blank = cleaned.isNull() | (cleaned == "")
    return fail_unless(
        blank | found.isNotNull(), found, F.concat(F.lit("not a date: "), cleaned)
    )


def clock_time(text: Column) -> Column:
    """``HH:mm`` kept as text, NULL when it is not a time of day."""
    return F.when(full_match(text, r"(?:[01]\d|2[0-3]):[0-5]\d"), text)


def period_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def closing_period(file_name: Column, on_missing: str = "fail") -> Column:
    """Struct (year, period) from the last ``_MMyyyy`` of a report's file name."""
    last = F.try_element_at(
        F.regexp_extract_all(file_name, F.lit(fixed.CLOSING_PERIOD), F.lit(0)), F.lit(-1)
    )
    if on_missing == "fail":
        last = fail_unless(
            last.isNotNull(), last, F.concat(F.lit("no closing period in file name: "), file_name)
        )
    year, month = F.substring(last, 4, 4), F.substring(last, 2, 2)
    return F.struct(
        year.cast("int").alias("year"),
        F.when(last.isNotNull(), F.concat_ws("-", year, month)).alias("period"),
    )


def _integer(text: Column) -> Column:
    number = strip(text.cast("string")).try_cast("decimal(28,10)")
    return F.when(number == F.floor(number), number.try_cast("int"))


def strict_year(value: Column) -> Column:
    """Whole-number year; anything else fails the job."""
    year = _integer(value)
    shown = F.coalesce(value.cast("string"), F.lit("NULL"))
    return fail_unless(year.isNotNull(), year, F.concat(F.lit("not a year: "), shown))


def integer_text(value: Column) -> Column:
    """Whole numbers as plain digits, other text unchanged; a fraction or a blank fails the job."""
    text = strip(value.cast("string"))
    number = text.try_cast("decimal(28,10)")
    fits = (text != "") & (number.isNull() | (number == F.floor(number)))
    plain = F.coalesce(number.cast("decimal(28,0)").cast("string"), text)
    shown = F.coalesce(text, F.lit("NULL"))
    return fail_unless(fits, plain, F.concat(F.lit("not a whole number: "), shown))


def strict_month(value: Column, year: Column) -> Column:
    """Month number from ``1``..``12`` or from ``yyyy-MM`` of the same year; else the job fails."""
    text = strip(value.cast("string"))
    dashed = F.contains(text, F.lit("-"))
    month = F.when(
        dashed,
        F.when(_integer(F.split_part(text, F.lit("-"), F.lit(1))) == year,
               _integer(F.regexp_extract(text, r"\A[^-]*-(.*)\z", 1))),
    ).otherwise(_integer(text))
    shown = F.coalesce(text, F.lit("NULL"))
    return fail_unless(
        month.between(1, 12), month, F.concat(F.lit("not a month of that year: "), shown)
    )

"""Amount and quantity expressions. Money is DECIMAL(18,2) from end to end."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tillrecon import fixed
from tillrecon.functions.text import fail_unless, full_match, strip

MONEY_TYPE = T.DecimalType(18, 2)
WIDE_TYPE = T.DecimalType(38, 10)


def money(text: Column) -> Column:
    """Printed amount to DECIMAL(18,2); NULL when the text is not an amount.

    ``_`` and ``*`` are padding, the euro sign is optional, thousands may carry commas and there
    are always two decimals.
    """
    return bare_money(strip(text))


def bare_money(text: Column) -> Column:
    """:func:`money` of text without white space around it."""
    unpadded = F.translate(text, "_*", "")
    digits = F.translate(text, "_*€,", "")
    return F.when(full_match(unpadded, fixed.MONEY), digits.try_cast(MONEY_TYPE))


def signed(amount: Column, ticket_type: Column, returns=fixed.RETURN_TYPES) -> Column:
    """Returns are printed positive and stored negative."""
    return F.when(ticket_type.isin(*returns), -F.abs(amount)).otherwise(amount)


def as_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast(MONEY_TYPE))


def amount_text(amount: Column) -> Column:
    """Two-decimal text, empty for NULL."""
    rounded = F.bround(amount.cast(WIDE_TYPE), 2).cast(MONEY_TYPE)
    return F.coalesce(rounded.cast("string"), F.lit(""))


def whole_text(quantity: Column) -> Column:
    """Integer text, empty for NULL or blank; a fraction fails the job."""
    text = strip(quantity.cast("string"))
    number = text.try_cast(WIDE_TYPE)
    whole = fail_unless(
        number == F.floor(number),
        number.cast("decimal(28,0)").cast("string"),
        F.concat(F.lit("quantity is not a whole number: "), text),
    )
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(whole)


def whole_number(text: Column) -> Column:
    """Whole number written as text to BIGINT, NULL when it is something else."""
    cleaned = strip(text)
    digits = F.regexp_replace(cleaned, "_", "")
    return F.when(full_match(cleaned, r"[+-]?\d+(?:_\d+)*"), digits.try_cast("bigint"))


def number_or_null(text: Column) -> Column:
    """Value of a numeric identifier, NULL for anything that is not one."""
    return F.when(full_match(strip(text), r"[+-]?\d+"), strip(text).try_cast("decimal(20,0)"))


def strict_amount(amount: Column, name: str) -> Column:
    """Amount that has to be there."""
    return fail_unless(amount.isNotNull(), amount, f"amount {name} is missing")


def french_number(value: Column, monetary: bool = True) -> Column:
    """Report text: comma as decimal mark, two decimals for money, no needless zeros otherwise."""
    if monetary:
        text = F.bround(value.cast(WIDE_TYPE), 2).cast("decimal(28,2)").cast("string")
    else:
        plain = value.cast(WIDE_TYPE).cast("string")
        text = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.translate(text, ".", ",")

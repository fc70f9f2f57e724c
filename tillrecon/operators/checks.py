"""Checks on tickets and lines: coherence, gaps, occurrences, duplicates, orphans, expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillrecon.functions.money import MONEY_TYPE, as_zero, number_or_null
from tillrecon.operators.ordering import previous_in_order

SEQUENCE_COLUMNS = ("file_name", "internal_no", "ticket_no", "ticket_date", "ticket_time")


def header_coherence(
    tickets: DataFrame, ht="ht1", vat="vat1", ttc="ttc", card="pay_card", cheque="pay_cheque", rate="0.20"
) -> DataFrame:
    """Recompute tax and total of a ticket from its net amount, and what is left to pay.

    Blank amounts count as zero. The balance leaves cash out.
    """
    net, tax, total = (as_zero(F.col(c)) for c in (ht, vat, ttc))
    expected_tax = net * F.lit(rate).cast("decimal(5,4)")
    return tickets.withColumns(
        {
            "vat_expected": expected_tax.cast("decimal(20,4)"),
            "vat_gap": (tax - expected_tax).cast("decimal(20,4)"),
            "ttc_expected": (net + tax).cast(MONEY_TYPE),
            "ttc_gap": (total - (net + tax)).cast(MONEY_TYPE),
            "balance_due": (total - (as_zero(F.col(card)) + as_zero(F.col(cheque)))).cast(MONEY_TYPE),
        }
    )


def sequence_gaps(
    tickets: DataFrame,
    columns=SEQUENCE_COLUMNS,
    by=("shop",),
    internal_no: str = "internal_no",
    number: str = "ticket_no",
    ties=("block_id",),
    chunks: int | None = None,
) -> DataFrame:
    """Step from one ticket number to the next, in the order of the internal numbers of a shop.

    NULL for a shop's first ticket and where one of the two numbers is blank or not numeric.
    """
    needed = list(dict.fromkeys([*by, *columns, internal_no, number, *ties]))
    previous = previous_in_order(
        tickets.select(*needed), by, (internal_no, *ties), number, "_previous", chunks
    )
    gap = number_or_null(F.col(number)) - number_or_null(F.col("_previous"))
    return previous.select(*dict.fromkeys([*by, *columns]), gap.cast("decimal(20,0)").alias("gap"))


def occurrences(
    df: DataFrame, *keys: str, alias: str = "occurrences", counted: str | None = None
) -> DataFrame:
    """How often each key occurs; blank keys form a group but are not counted, as in a pivot.

    Of several keys every row is counted, unless ``counted`` names the one that has to be filled.
    """
    if counted is None and len(keys) == 1:
        counted = keys[0]
    return df.groupBy(*keys).agg(F.count(counted or "*").alias(alias))


def duplicates(df: DataFrame, *keys: str, alias: str = "occurrences") -> DataFrame:
    """Keys that occur more than once."""
    return occurrences(df, *keys, alias=alias).filter(F.col(alias) > 1)


def describe(failures: DataFrame, *keys: str, shown: int = 20) -> str:
    """How many failures there are, and the first of them in order as examples; empty without any."""
    n = failures.count()
    if not n:
        return ""
    first = failures.select(*keys).orderBy(*keys).limit(shown).collect()
    examples = "; ".join(", ".join(map(str, r)) for r in first)
    return f"{n} cases: {examples}" if n <= shown else f"{n} cases, the first {shown} of them: {examples}"


def assert_unique(df: DataFrame, *keys: str, what: str = "key") -> DataFrame:
    """Fail now if a key occurs twice; returns ``df`` unchanged."""
    found = describe(duplicates(df, *keys), *keys)
    if found:
        raise ValueError(f"duplicate {what}: {found}")
    return df


def ticket_line_totals(
    lines: DataFrame,
    keys=("ticket_no", "ttc"),
    label: str = "label",
    amount: str = "amount",
    correction: str = "correction",
) -> DataFrame:
    """Per ticket number and total: labelled lines, sum of amounts, sum of corrections."""
    return lines.groupBy(*keys).agg(
        F.count(label).alias("labels"),
        F.sum(amount).alias("sum_amount"),
        F.sum(correction).alias("sum_correction"),
    )


def ticket_totals_by_join(
    lines: DataFrame, tickets: DataFrame, key: str = "block_id", keys=("ticket_no", "ttc"), **columns
) -> DataFrame:
    """:func:`ticket_line_totals` of lines and tickets stored apart.

    The lines are added up per ticket before the join, so a ticket with very many lines crosses the
    network as a few partial sums.
    """
    per_ticket = ticket_line_totals(lines, keys=(key,), **columns)
    return (
        per_ticket.join(tickets.select(key, *keys), key)
        .groupBy(*keys)
        .agg(*(F.sum(c).alias(c) for c in ("labels", "sum_amount", "sum_correction")))
    )


def header_vs_lines(totals: DataFrame, ttc: str = "ttc") -> DataFrame:
    """Ticket total minus the sum of its lines; blanks count as zero."""
    lines = as_zero(F.col("sum_amount")) + as_zero(F.col("sum_correction"))
    return totals.withColumn("ttc_gap", as_zero(F.col(ttc)) - lines)


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Children whose parent does not exist. Without a key value there is no parent to look for."""
    known = parents.select(F.col(parent_key or key).alias(key)).filter(F.col(key).isNotNull())
    return children.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def unknown_values(df: DataFrame, column: str, known) -> DataFrame:
    """Distinct values outside the known ones."""
    return df.filter(~F.col(column).isin(*known)).select(column).distinct()


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def check_expectations(metrics: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected metrics (metric, expected) that the measured ones (metric, value) do not meet."""
    measured = metrics.select("metric", F.col("value").alias("actual"))
    joined = expected.join(measured, "metric", "left")
    return joined.filter(~F.col("actual").eqNullSafe(F.col("expected")))


def assert_expectations(metrics: DataFrame, expected: DataFrame) -> None:
    """Raise one error that names every expectation not met."""
    failed = check_expectations(metrics, expected).orderBy("metric").collect()
    if failed:
        raise ValueError(
            "validation failed: "
            + "; ".join(f"{r['metric']}: expected {r['expected']}, found {r['actual']}" for r in failed)
        )

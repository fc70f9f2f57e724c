"""The staged files of a run: tickets and lines per shop, report rows per shop and year, as text by contract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillrecon import fixed
from tillrecon.operators import tables
from tillrecon.sources import contract, sinks

AMOUNTS = ("ht1", "ht2", "ht3", "ht4", "vat1", "vat2", "vat3", "vat4", "ht_exempt", "ttc", "pay_card", "pay_cash", "pay_cheque")
LINE = fixed.STAGED_TICKET | fixed.STAGED_LINE
#: Name of a set of files: columns, directories, order of its rows.
SETS = {
    "tickets": (fixed.STAGED_TICKET, ("shop",), tables.HEADER_ORDER),
    "ticket_lines": (LINE, ("shop",), tables.LINE_ORDER),
    "z1": (fixed.STAGED_REPORT, ("shop", "year"), tables.REPORT_ORDER[1:]),
    "z2": (fixed.STAGED_REPORT, ("shop", "year"), tables.REPORT_ORDER[1:]),
}


def staged_rows(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows of each set, with the columns that lay them out and order them."""
    sales = tables.sales_only(stored["tickets"])
    own = [c for c in fixed.STAGED_TICKET.values()]
    lines = tables.ticket_lines_wide(
        stored["ticket_lines"].drop("shop", "file_name", "event"), sales.select("block_id", "shop", "event", *own)
    )
    headers = stored["report_headers"]
    found = {"tickets": sales, "ticket_lines": lines}
    for family in ("z1", "z2"):
        kept = headers.filter(F.col("family") == family).drop("family")
        rows = stored["report_lines"].drop(*(set(kept.columns) - {"report_id"}))
        found[family] = tables.report_rows(rows, kept)
    return found


def as_text(name: str, rows: DataFrame) -> DataFrame:
    """Rows of a set in the text form of its files, under the names of the contract."""
    columns, by, order = SETS[name]
    amounts = [c for c in columns.values() if c in (*AMOUNTS, "amount", "correction")]
    dates = [c for c in columns.values() if c in ("ticket_date", "report_date")]
    texts = [c for c in columns.values() if c in ("internal_no", "ticket_no", "counter", "record_no")]
    # Rows keep the order of dates and numbers, not of their text.
    ordered = rows.withColumns({f"_{c}": F.col(c) for c in order})
    text = tables.contract_text(ordered, texts, dates, amounts, [c for c in ("qty",) if c in columns.values()])
    return text.select(*by, *(F.col(c).alias(n) for n, c in columns.items()), *(f"_{c}" for c in order))


def export_staged(stored: Mapping[str, DataFrame], folder: str, expected: Mapping[tuple[str, str], int] | None = None) -> dict:
    """Write every set below ``folder`` and return its rows per shop; other volumes than ``expected`` are an error.

    ``expected`` maps (set, shop) to a number of rows.
    """
    counts = {}
    for name, rows in staged_rows(stored).items():
        columns, by, order = SETS[name]
        sinks.export_csv(as_text(name, rows), f"{folder}/{name}", list(columns), by, [f"_{c}" for c in order])
        back = read_staged(rows.sparkSession, folder, name)
        # One row per shop.
        counts |= {(name, r["shop"]): r["n"] for r in back.groupBy("shop").agg(F.count("*").alias("n")).collect()}
    wrong = {k: (n, counts.get(k, 0)) for k, n in (expected or {}).items() if counts.get(k, 0) != n}
    if wrong:
        raise ValueError("staged volumes (expected, written): " + ", ".join(f"{s} {shop} {n}" for (s, shop), n in sorted(wrong.items())))
    return counts


def read_staged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A set as it was written, all text; the header is compared with the contract."""
    columns, by, _ = SETS[name]
    kinds = {"year": "int"}
    schema = ", ".join([f"`{c}` string" for c in columns] + [f"{c} {kinds.get(c, 'string')}" for c in by])
    return contract.read_contract_csv(spark, f"{folder}/{name}", schema)

"""One query per operator on the driver tables. Amounts come out as whole cents, dates as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillrecon.functions import money as M, periods as P, text as X
from tillrecon.operators import (
    checks,
    compare,
    journal,
    lineage as lin,
    monthly,
    ordering,
    report,
    tables,
)
from tillrecon.plans import samples as S
from tillrecon.session import apply_settings
from tillrecon.sources import contract, files, sinks
from tillrecon.sources.staging import new_folder, stage

QUERIES = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_settings(spark), sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


# --- monthly totals and their comparison -------------------------------------------------------


def _shipped_rows(spark, sf_dir) -> DataFrame:
    """Line items as the report side: date, net, tax and total."""
    items = S.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), S.decimal("l_extendedprice").alias("ttc")
    )
    split = items.withColumn("total_ht", S.net_of("ttc"))
    return split.withColumn("total_vat20", F.col("ttc") - F.col("total_ht"))


def _shipped(spark, sf_dir) -> DataFrame:
    """The report side per month."""
    return monthly.monthly_totals(_shipped_rows(spark, sf_dir), monthly.REVENUE, date="date")


def _ordered_rows(spark, sf_dir, by=()) -> DataFrame:
    """Orders as the journal side."""
    return S.tickets(spark, sf_dir).select(
        *by,
        F.col("ticket_date").alias("date"),
        "ttc",
        F.col("ht1").alias("total_ht"),
        F.col("vat1").alias("total_vat20"),
    )


def _ordered(spark, sf_dir, by=()) -> DataFrame:
    return monthly.monthly_totals(_ordered_rows(spark, sf_dir, by), monthly.REVENUE, by=by, date="date")


def _revenue_gaps(spark, sf_dir) -> DataFrame:
    return compare.reconcile_sums(
        _shipped_rows(spark, sf_dir),
        _ordered_rows(spark, sf_dir),
        {"gap_ttc": ("ttc", "ttc"), "gap_ht": ("total_ht",) * 2, "gap_vat": ("total_vat20",) * 2},
        missing="null",
        strict=True,
        date="date",
    )


@query
def reconcile_null(spark, sf_dir):
    """Report revenue against journal revenue, exact, blank where a side lacks the month."""
    gaps = _revenue_gaps(spark, sf_dir)
    return tables.in_order(gaps, "year", "period").select(
        "year", "period", S.cents("gap_ttc"), S.cents("gap_ht"), S.cents("gap_vat"), "status"
    )


@query
def missing_periods(spark, sf_dir):
    """Months that one of the two sources lacks."""
    return compare.missing_periods(_revenue_gaps(spark, sf_dir))


@query
def monthly_revenue(spark, sf_dir):
    """Net, tax and total per shop and month."""
    rows = monthly.with_totals_and_period(
        S.tickets(spark, sf_dir), nets=("ht1",), date="ticket_date"
    )
    totals = monthly.monthly_totals(rows, monthly.REVENUE, by=("shop",))
    return totals.select("shop", "year", "period", *(S.cents(m) for m in monthly.REVENUE))


@query
def monthly_payments(spark, sf_dir):
    """Total and means of payment per shop and month."""
    totals = monthly.monthly_totals(
        S.tickets(spark, sf_dir), monthly.PAYMENTS, by=("shop",), date="ticket_date"
    )
    return totals.select("shop", "year", "period", *(S.cents(m) for m in monthly.PAYMENTS))


@query
def reconcile_payments(spark, sf_dir):
    """Report amounts in the mode kept per shop against the journal's means of payment."""
    natures = {"A": "card", "N": "cheque", "R": "cash"}
    items = S.table(spark, sf_dir, "lineitem")
    rows = items.select(
        (F.col("l_suppkey") % 2).cast("string").alias("shop"),
        F.col("l_linestatus").alias("mode"),
        F.to_date("l_shipdate").alias("date"),
        *(F.when(F.col("l_returnflag") == flag, S.decimal("l_extendedprice")).alias(flag) for flag in natures),
    )
    gaps = compare.reconcile_sums(
        monthly.retained_mode(rows, {"0": "F", "1": "O"}),
        S.tickets(spark, sf_dir).withColumnRenamed("ticket_date", "date"),
        {f"gap_{means}": (flag, f"pay_{means}") for flag, means in natures.items()},
        missing="null",
        keys=("shop", "year", "period"),
        date="date",
    )
    return gaps.select(
        "shop", "year", "period", *(S.cents(f"gap_{m}") for m in natures.values()), "status"
    )


QTY_TYPE = {"qty": "bigint"}


def _in_cents(df: DataFrame, keys, plain=()) -> DataFrame:
    """Amounts of a pivot in cents; counts stay."""
    kept = {*keys, *plain, *(c for c in df.columns if c.endswith("_qty"))}
    return df.select(*(c if c in kept else S.cents(c) for c in df.columns))


@query
def z2_mode_totals(spark, sf_dir):
    """Count and amount per nature and period of one mode."""
    rows = S.report_lines(spark, sf_dir)
    totals = monthly.mode_totals(rows, "ZZ1", S.EVENT_TYPES, sum_type=QTY_TYPE)
    return _in_cents(totals, compare.KEYS)


@query
def reconcile_zero(spark, sf_dir):
    """Mode against mode; a period without rows in a mode counts as zero."""
    rows = S.report_lines(spark, sf_dir)
    both = rows.filter(F.col("mode").isin("ZZ1", "ZZ2"))
    totals = monthly.mode_totals(both, None, S.EVENT_TYPES, by=("mode",), sum_type=QTY_TYPE)
    names = [f"{nature}_{m}" for nature in S.EVENT_TYPES for m in ("qty", "amount")]
    tagged = totals.withColumn("_side", F.when(F.col("mode") == "ZZ1", "left").otherwise("right"))
    gaps = compare.reconcile_tagged(tagged, {n: (n, n) for n in names}, missing="zero")
    return _in_cents(gaps, compare.KEYS, plain=("status",))


@query
def pivot_control(spark, sf_dir):
    """Pivoted totals per mode with the verdict of the independent control beside them."""
    rows = S.report_lines(spark, sf_dir)
    keys = ("mode", "year", "period")
    pivot = monthly.mode_totals(rows, None, S.EVENT_TYPES, by=("mode",), sum_type=QTY_TYPE)
    control = monthly.conditional_totals(rows, S.EVENT_TYPES, by=("mode",), sum_type=QTY_TYPE)
    wrong = compare.differing_totals(pivot, control, keys).select(*keys, F.lit(1).alias("differs"))
    marked = pivot.join(wrong, list(keys), "left").withColumn(
        "differs", F.coalesce("differs", F.lit(0))
    )
    return _in_cents(marked, keys, plain=("differs",))


@query
def control_differs(spark, sf_dir):
    """Periods and modes in which a control that misses rows of one nature differs from the pivot."""
    rows = S.report_lines(spark, sf_dir)
    keys = ("mode", "year", "period")
    pivot = monthly.mode_totals(rows, None, S.EVENT_TYPES, by=("mode",), sum_type=QTY_TYPE)
    fewer = rows.filter(~((F.col("designation") == "view") & (F.substring("period", 9, 2) <= "10")))
    control = monthly.conditional_totals(fewer, S.EVENT_TYPES, by=("mode",), sum_type=QTY_TYPE)
    return compare.differing_totals(pivot, control, keys).select(*keys)


@query
def consolidate_strict(spark, sf_dir):
    """Months that every shop has, consolidated with the check that each has them once."""
    by_shop = _ordered(spark, sf_dir, ("shop",)).withColumn("shop", F.concat(F.lit("s"), "shop"))
    complete = by_shop.groupBy(*compare.KEYS).agg(F.count("*").alias("n")).filter("n = 2").drop("n")
    months = by_shop.join(complete, list(compare.KEYS), "left_semi")
    return _in_cents(compare.consolidate(months, ("s0", "s1"), monthly.REVENUE), compare.KEYS)


@query
def consolidate(spark, sf_dir):
    """Months of both shops and their total."""
    totals = compare.consolidate(
        _ordered(spark, sf_dir, ("shop",)).withColumn("shop", F.concat(F.lit("s"), "shop")),
        ("s0", "s1"),
        monthly.REVENUE,
        strict=False,
    )
    return _in_cents(totals, compare.KEYS)


@query
def compare_declared(spark, sf_dir):
    """Consolidated months against declared ones; the second half of each year is not declared."""
    own = compare.consolidate(
        _ordered(spark, sf_dir, ("shop",)), ("0", "1"), monthly.REVENUE, strict=False, keep_shops=False
    )
    finished = F.col("type") == "F"
    rows = S.tickets(spark, sf_dir).select(
        "ticket_date",
        F.when(finished, F.col("ht1")).alias("ht20_declared"),
        F.when(finished, F.col("vat1")).alias("vat20_declared"),
    )
    names = ("ht20_declared", "vat20_declared")
    declared = monthly.monthly_totals(rows, names, date="ticket_date").select(
        *compare.KEYS,
        *(F.when(F.substring("period", 6, 2) <= "06", F.col(n)).alias(n) for n in names),
    )
    compared = compare.compare_declared(
        own,
        declared,
        {
            "gap_ht20": ("total_total_ht", "ht20_declared"),
            "gap_vat20": ("total_total_vat20", "vat20_declared"),
        },
    )
    return _in_cents(compared, compare.KEYS)


# (mode, shop, year) that the queries leave out.
NOT_PRODUCED = [("Z", "A", 1994), ("ZZ2", "B", 1996)]


@query
def applicable_modes(spark, sf_dir):
    """Requested modes per shop and year, without the excluded ones, with overrides."""
    rows = S.synthesis_lines(spark, sf_dir).select("mode", "shop", "year").distinct()
    return monthly.applicable_modes(
        rows,
        excluded=NOT_PRODUCED,
        overrides={("Z", "A", 1998): "ZZ2"},
    )


@query
def z1_mode_totals(spark, sf_dir):
    """Synthesis amounts per designation for every applicable mode; both spellings count as one."""
    rows = S.synthesis_lines(spark, sf_dir).withColumn(
        "designation", monthly.canonical_designation(F.col("designation"))
    )
    excluded = monthly.small_table(
        spark,
        NOT_PRODUCED,
        "mode string, shop string, year int",
    )
    rows = rows.join(excluded, ["mode", "shop", "year"], "left_anti")
    totals = monthly.mode_totals(
        rows,
        None,
        ("CA BRUT", "CA NET", "ESP.TIROIR", "HORS TAXES 1", "TVA 1"),
        measures=("amount",),
        by=("mode", "shop"),
    )
    return _in_cents(totals, ("mode", "shop", *compare.KEYS))


@query
def occurrence_matrix(spark, sf_dir):
    """Rows per month, spread over flag and status."""
    rows = S.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), "l_returnflag", "l_linestatus"
    )
    dated = rows.select(
        F.year("date").alias("year"), P.period_of(F.col("date")).alias("period"), "l_returnflag", "l_linestatus"
    )
    return monthly.occurrence_matrix(
        dated,
        compare.KEYS,
        ("l_returnflag", "l_linestatus"),
        ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O"),
    )


@query
def totals_and_period(spark, sf_dir):
    """Total net, standard tax, year and period of every ticket."""
    tickets = S.tickets(spark, sf_dir)
    parts = tickets.select(
        "block_id",
        "ticket_date",
        "vat1",
        *(
            F.when(F.col("block_id") % 5 == i, F.col("ht1")).alias(name)
            for i, name in enumerate(("ht1", "ht2", "ht3", "ht4", "ht_exempt"))
        ),
    )
    found = monthly.with_totals_and_period(parts)
    return found.select("block_id", S.cents("total_ht"), S.cents("total_vat20"), "year", "period")


# --- selections, order, checks -------------------------------------------------------------------


@query
def sales_only(spark, sf_dir):
    """Tickets of the sale types with a number, with their shop and year."""
    dated = S.tickets(spark, sf_dir).withColumn("year", F.year("ticket_date"))
    sold = tables.sales_only(dated, types=("F", "P"))
    return tables.for_shop_year(sold).select("block_id", "shop", "year", "type", "ticket_no")


@query
def sales_shop_year(spark, sf_dir):
    """Exported tickets of one shop and one year."""
    dated = S.tickets(spark, sf_dir).withColumn("year", F.year("ticket_date"))
    sold = tables.sales_only(dated, types=("F", "P"))
    return tables.for_shop_year(sold, "1", 1995).select("block_id", "shop", "year", "type", "ticket_no")


@query
def ordered_headers(spark, sf_dir):
    """Position of every ticket in its shop by date, time and internal number."""
    tickets = S.tickets(spark, sf_dir).select("block_id", "shop", *tables.HEADER_ORDER)
    numbered = ordering.number_in_order(tickets, ("shop",), tables.HEADER_ORDER, "position")
    return numbered.select("shop", "position", "block_id")


@query
def ordered_lines(spark, sf_dir):
    """Position of every ticket line in its shop by date, time, internal number and line."""
    lines = S.ticket_lines(spark, sf_dir, row_id=True).select(
        "block_id", "line_pos", "part", "supplier", "qty", "amount", "ship_date", "row_id"
    )
    tickets = S.tickets(spark, sf_dir).select("block_id", "shop", *tables.HEADER_ORDER)
    wide = tables.ticket_lines_wide(lines, tickets)
    order = (*tables.LINE_ORDER, "part", "supplier", "amount", "qty", "ship_date", "row_id")
    numbered = ordering.number_in_order(wide, ("shop",), order, "position")
    return numbered.select("shop", "position", "block_id", "line_pos", "part", S.cents("amount"))


@query
def ordered_reports(spark, sf_dir):
    """Position of every report row by mode, day and row."""
    rows = S.report_lines(spark, sf_dir).select("mode", "period", "event_id")
    numbered = ordering.number_in_order(rows, (), ("mode", "period", "event_id"), "position")
    return numbered.select("position", "mode", "period", "event_id")


@query
def report_rows(spark, sf_dir):
    """Rows of line items with the header they belong to."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("report_id"), "l_linenumber", S.decimal("l_extendedprice").alias("amount")
    )
    headers = S.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("report_id"), F.col("o_orderpriority").alias("mode")
    )
    rows = tables.report_rows(lines, headers)
    return rows.select("report_id", "l_linenumber", S.cents("amount"), "mode")


@query
def header_coherence(spark, sf_dir):
    """Recomputed tax and total, and what is left to pay, with the sign of returns."""
    tickets = S.tickets(spark, sf_dir)
    sign = lambda c: M.signed(F.col(c), F.col("type"), ("P",))
    amounts = ("ht1", "vat1", "ttc", "pay_card", "pay_cheque")
    checked = checks.header_coherence(tickets.withColumns({c: sign(c) for c in amounts}))
    fine = lambda c: (F.col(c) * 10000).cast("bigint").alias(c)
    return checked.select(
        "block_id", S.cents("ttc"), fine("vat_expected"), fine("vat_gap"),
        S.cents("ttc_expected"), S.cents("ttc_gap"), S.cents("balance_due"),
    )


@query
def sequence_gaps(spark, sf_dir):
    """Steps between ticket numbers in the order of internal numbers."""
    gaps = checks.sequence_gaps(S.tickets(spark, sf_dir))
    return gaps.select("shop", "internal_no", "ticket_no", F.col("gap").cast("bigint").alias("gap"))


@query
def fill_down(spark, sf_dir):
    """Blank labels filled with the last one before them in the shop."""
    tickets = S.tickets(spark, sf_dir)
    label = F.when(F.col("block_id") % 5 == 0, F.col("means"))
    rows = tickets.select("shop", "ticket_date", "internal_no", label.alias("label"))
    return ordering.fill_down(
        rows, ("shop",), ("ticket_date", "internal_no"), "label", "filled"
    ).select("shop", "internal_no", "label", "filled")


@query
def occurrences_ticket(spark, sf_dir):
    """Lines per ticket number."""
    return checks.occurrences(S.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def occurrences_label(spark, sf_dir):
    """Articles per label."""
    return checks.occurrences(S.table(spark, sf_dir, "part"), "p_name")


@query
def occurrences_vat(spark, sf_dir):
    """Lines per tax code; lines without a code are listed and not counted."""
    code = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("T"), F.col("l_linenumber").cast("string")))
    return checks.occurrences(S.table(spark, sf_dir, "lineitem").select(code.alias("vat_code")), "vat_code")


@query
def duplicates(spark, sf_dir):
    """Ticket lines whose key occurs more than once."""
    return checks.duplicates(S.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def ticket_line_totals(spark, sf_dir):
    """Labels, amounts and corrections per ticket number and total."""
    tickets = S.tickets(spark, sf_dir).select("block_id", F.col("internal_no").alias("ticket_no"), "ttc")
    totals = checks.ticket_totals_by_join(S.ticket_lines(spark, sf_dir), tickets)
    return totals.select(
        "ticket_no", S.cents("ttc"), "labels", S.cents("sum_amount"), S.cents("sum_correction")
    )


@query
def header_vs_lines(spark, sf_dir):
    """Ticket total minus the sum of its lines."""
    tickets = S.tickets(spark, sf_dir).select("block_id", F.col("internal_no").alias("ticket_no"), "ttc")
    totals = checks.ticket_totals_by_join(S.ticket_lines(spark, sf_dir), tickets)
    return checks.header_vs_lines(totals).select("ticket_no", S.cents("ttc_gap"))


@query
def orphans(spark, sf_dir):
    """Lines whose order is not among the finished and open ones."""
    kept = S.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    lines = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return checks.orphans(lines, kept, "l_orderkey", "o_orderkey")


@query
def unknown_values(spark, sf_dir):
    """Types outside the known ones."""
    return checks.unknown_values(S.table(spark, sf_dir, "orders"), "o_orderstatus", ("F", "O"))


def _metrics(spark, sf_dir) -> DataFrame:
    tickets = S.tickets(spark, sf_dir)
    signed = tickets.withColumn("ttc", M.signed(F.col("ttc"), F.col("type"), ("P",)))
    metrics = lin.volume_metrics(signed, types=("F", "P"), returns=("P",))
    return metrics.unionByName(
        lin.row_counts(
            details=S.table(spark, sf_dir, "lineitem"), report_rows=S.table(spark, sf_dir, "events")
        )
    )


@query
def volume_metrics(spark, sf_dir):
    """Volumes of tickets, lines and report rows."""
    return _metrics(spark, sf_dir).select("metric", S.cents("value"))


@query
def expectations(spark, sf_dir):
    """Expected volumes that are not met: one measured otherwise, one not measured at all."""
    expected = spark.createDataFrame(
        [("returns", 0), ("nowhere", 1), ("sales:9", 2)], "metric string, expected bigint"
    ).withColumn("expected", F.col("expected").cast(lin.VALUE_TYPE))
    own = lin.row_counts(details=S.table(spark, sf_dir, "lineitem")).withColumnRenamed(
        "value", "expected"
    )
    failed = checks.check_expectations(_metrics(spark, sf_dir), expected.unionByName(own))
    return failed.select("metric", S.cents("expected"), S.cents("actual"))


# --- scalar functions ---------------------------------------------------------------------------


@query
def money_parse(spark, sf_dir):
    """Printed amounts read back; a form that is no amount gives NULL."""
    orders = S.table(spark, sf_dir, "orders").select(
        "o_orderkey", S.decimal("o_totalprice").alias("price")
    )
    shown = F.format_number("price", 2)
    plain = F.col("price").cast("string")
    form = F.col("o_orderkey") % 6
    text = (
        F.when(form == 0, F.concat(F.lit("€"), shown))
        .when(form == 1, F.concat(F.lit("  "), plain, F.lit("\t")))
        .when(form == 2, F.concat(F.lit("**€"), F.replace(shown, F.lit(","), F.lit("_"))))
        .when(form == 3, F.concat(F.lit("€-"), shown))
        .when(form == 4, F.concat(plain, F.lit("0")))
        .otherwise(F.concat(F.lit("-€"), plain))
    )
    read = orders.select("o_orderkey", M.money(text).alias("amount"))
    return read.select(
        "o_orderkey", S.cents("amount"), M.french_number(F.col("amount")).alias("shown")
    )


@query
def period_from_name(spark, sf_dir):
    """Closing year and month of files that name one, two or three months."""
    date = F.to_date("o_orderdate")
    month = lambda back: F.date_format(F.add_months(date, -back), "MMyyyy")
    key = F.col("o_orderkey")
    name = F.concat_ws(
        "_",
        F.lit("Z102_02"),
        F.when(key % 3 == 2, month(2)),
        F.when(key % 3 >= 1, month(1)),
        month(0),
        F.when(key % 2 == 0, F.lit("SHOP A")),
    )
    files_ = S.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(name, F.lit(".CSV")).alias("file_name")
    )
    return tables.with_closing_period(files_).select("o_orderkey", "year", "period")


@query
def normalise_scalars(spark, sf_dir):
    """Text forms of amounts, quantities, dates, years and months brought to their contract form."""
    orders = S.table(spark, sf_dir, "orders")
    key, date = F.col("o_orderkey"), F.to_date("o_orderdate")
    forms = F.element_at(
        F.array(*(F.date_format(date, f) for f in ("yyyy-MM-dd", "yyyyMMdd", "dd-MM-yyyy"))),
        (key % 3 + 1).cast("int"),
    )
    rows = orders.select(
        "o_orderkey",
        S.decimal("o_totalprice").alias("price"),
        F.when(key % 7 != 0, forms).alias("date_text"),
        F.concat((key % 90).cast("string"), F.when(key % 2 == 0, ".00").otherwise("")).alias("qty_text"),
        F.concat(F.lit(" "), F.year(date).cast("string"), F.when(key % 2 == 0, ".0").otherwise("")).alias("year_text"),
        F.when(key % 2 == 0, P.period_of(date)).otherwise(F.month(date).cast("string")).alias("month_text"),
        F.when(key % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("label"),
        F.when(key % 3 == 0, S.digits("o_orderkey")).otherwise(F.col("o_orderpriority")).alias("number_text"),
    )
    year = P.strict_year(F.col("year_text"))
    return rows.select(
        "o_orderkey",
        M.amount_text(F.when(key % 5 != 0, F.col("price"))).alias("amount_text"),
        P.iso_date(F.col("date_text")).cast("string").alias("iso_date"),
        M.whole_text(F.col("qty_text")).alias("whole_text"),
        year.alias("year"),
        P.strict_month(F.col("month_text"), year).alias("month"),
        X.blank_to_null(F.col("label")).alias("label"),
        X.label_key(F.col("label")).alias("label_key"),
        M.number_or_null(F.col("number_text")).cast("bigint").alias("number"),
    )


@query
def contract_text(spark, sf_dir):
    """Tickets in the text form of the staged files."""
    tickets = S.tickets(spark, sf_dir).select(
        "internal_no", F.date_format("ticket_date", "dd-MM-yyyy").alias("ticket_date"), "ttc", "pay_card",
        (F.col("block_id") % 50).cast("decimal(10,2)").alias("qty"),
    )
    return tables.contract_text(
        tickets, ["internal_no"], ["ticket_date"], ["ttc", "pay_card"], ["qty"]
    )


# --- texts ------------------------------------------------------------------------------------------


@query
def journal_roundtrip(spark, sf_dir):
    """Tickets printed as journal blocks and parsed back."""
    tickets = S.dealt(S.tickets(spark, sf_dir))
    blocks = tickets.select("block_id", S.block_text().alias("block"))
    parsed = journal.parse_tickets(journal.parse_blocks(blocks))
    return parsed.select(
        "block_id", "type", "event", "signature", "internal_no", "ticket_no",
        F.col("ticket_date").cast("string").alias("ticket_date"), "ticket_time",
        *(S.cents(c) for c in ("ht1", "vat1", "ttc", "pay_card", "pay_cash", "pay_cheque")),
        F.size("errors").alias("n_errors"),
    )


@query
def journal_lines_roundtrip(spark, sf_dir):
    """Ticket lines printed as articles and corrections and parsed back."""
    printed = S.dealt(S.ticket_lines(spark, sf_dir))
    parsed = journal.parse_blocks(S.line_blocks(printed))
    lines = journal.parse_ticket_lines(parsed, ids=("block_id", "item", "part"))
    return lines.select(
        "block_id", "item", "part", "line_pos", "qty", "label", "vat_code",
        S.cents("amount"), S.cents("correction"),
    )


def _printed_tickets(spark, sf_dir) -> DataFrame:
    return journal.parse_blocks(S.dealt(S.ticket_blocks(S.tickets(spark, sf_dir), S.ticket_lines(spark, sf_dir))))


@query
def journal_full_headers(spark, sf_dir):
    """Headers of tickets with all their lines, four tax codes, an untaxed amount and two invoice lines."""
    codes = [f"{kind}{code}" for kind in ("ht", "vat") for code in "1234"]
    return _printed_tickets(spark, sf_dir).select(
        "block_id", "type", "ticket_no", *(S.cents(c) for c in (*codes, "ht_exempt", "ttc")),
        F.size("lines").alias("n_lines"), F.size("errors").alias("n_errors"),
    )


@query
def journal_full_lines(spark, sf_dir):
    """Lines of the same tickets, in the order in which they are printed."""
    lines = journal.parse_ticket_lines(_printed_tickets(spark, sf_dir))
    return lines.select("block_id", "line_pos", "qty", "label", "vat_code", S.cents("amount"), S.cents("correction"))


@query
def journal_rejects(spark, sf_dir):
    """Blocks that are broken, with the error found in each of them."""
    printed = S.dealt(S.tickets(spark, sf_dir))
    parsed = journal.parse_blocks(S.damaged_blocks(printed))
    _, rejected = journal.reject_blocks(parsed, "quarantine")
    return rejected.select("block_id", F.array_join("errors", ",").alias("error"))


@query
def report_roundtrip(spark, sf_dir):
    """Report rows printed as closing reports and parsed back."""
    parsed = report.parse_reports(S.report_texts(S.report_lines(spark, sf_dir)))
    lines = report.parse_report_lines(
        parsed, carry=("mode", "machine", "file_code", "counter", "report_date", "errors")
    )
    return lines.select(
        "report_id", "mode", "machine", "file_code", "counter",
        F.col("report_date").cast("string").alias("report_date"),
        "line_pos", "record_no", "designation", "qty", S.cents("amount"),
        F.size("errors").alias("n_errors"),
    )


@query
def shop_from_path(spark, sf_dir):
    """Shop named below the source root; none where no shop or both are named."""
    root = "/srv/ALPHA/src"
    folders = F.array(*map(F.lit, ("EXPORT_alpha", "EXPORT_BETA", "alpha/beta", "other")))
    path = F.concat_ws(
        "/",
        F.lit(f"file:{root}"),
        F.element_at(folders, (F.col("c_nationkey") % 4 + 1).cast("int")),
        F.concat(F.lit("EJ"), F.col("c_custkey").cast("string"), F.lit(".TXT")),
    )
    return S.table(spark, sf_dir, "customer").select(
        "c_custkey", files.shop_from_path(path, root, ("ALPHA", "BETA")).alias("shop")
    )


@query
def fingerprint_diff(spark, sf_dir):
    """Texts added, removed, changed and kept between two states."""
    documents = S.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    before = documents.filter(F.col("source") != "src0").select(
        "doc_id", F.sha2("text", 256).alias("sha256")
    )
    edited = F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    after = documents.filter(F.col("lang") != "de").select(
        "doc_id", F.sha2(edited, 256).alias("sha256")
    )
    return files.diff_fingerprints(before, after, key="doc_id")


# --- totals and lineage ----------------------------------------------------------------------------


@query
def numeric_totals(spark, sf_dir):
    """Totals of the amounts and of the declared quantities of an output."""
    lines = S.ticket_lines(spark, sf_dir).drop("ship_date")
    return lin.numeric_totals(lines, lin.measures_of(lines, ("qty",))).select("field", S.cents("total"))


@query
def numeric_totals_long(spark, sf_dir):
    """Totals per nature and measure."""
    rows = S.report_lines(spark, sf_dir)
    return lin.numeric_totals_long(rows, "designation", ("qty", "amount")).select(
        "field", S.cents("total")
    )


EDGES = (
    ("report_monthly", "lineitem"),
    ("journal_monthly", "orders"),
    ("reconciled", "report_monthly"),
    ("reconciled", "journal_monthly"),
)


def _lineage(spark, sf_dir):
    """Counters of a small run: outputs are written, and the writes count what they read, select and write."""
    log = lin.Lineage()
    for output, source in EDGES:
        log.declare(output, source)

    def written(name: str, df: DataFrame) -> DataFrame:
        return stage(log.observed(df, name, "written"), name)

    with lin.observing(spark):
        shipped = log.observed(_shipped_rows(spark, sf_dir), "report_monthly", "read")
        report_side = written("report_monthly", monthly.monthly_totals(shipped, monthly.REVENUE, date="date"))
        tickets = log.observed(S.tickets(spark, sf_dir), "journal_monthly", "read")
        sold = log.observed(tables.sales_only(tickets, types=("F", "P")), "journal_monthly", "selected")
        journal_side = written("journal_monthly", monthly.monthly_totals(sold, ("ttc",), date="ticket_date"))
        sides = (log.observed(df, "reconciled", "read") for df in (report_side, journal_side))
        written("reconciled", compare.reconcile(*sides, {"gap_ttc": ("ttc", "ttc")}, missing="null"))
    counts = log.counts(spark)
    of = lambda counter: counts.filter(F.col("counter") == counter).select("output", "n")
    stored = lin.row_counts(lineitem=S.table(spark, sf_dir, "lineitem"), orders=S.table(spark, sf_dir, "orders"))
    stored = stored.select(F.col("metric").alias("output"), F.col("value").cast("bigint").alias("n"))
    edges = log.edges(spark)
    return lin.lineage(of("written").unionByName(stored), edges, of("selected"), of("read")), edges


@query
def lineage(spark, sf_dir):
    """Rows read, selected and written by each output of a comparison."""
    counters, _ = _lineage(spark, sf_dir)
    return counters


@query
def check_lineage(spark, sf_dir):
    """Outputs that claim more rows read than their sources wrote, after one count was tampered with."""
    counters, edges = _lineage(spark, sf_dir)
    tampered = counters.withColumn(
        "n_read", F.col("n_read") + F.when(F.col("output") == "journal_monthly", 1).otherwise(0)
    )
    return lin.check_lineage(tampered, edges)


@query
def run_report(spark, sf_dir):
    """Report per output: sources, counters and control totals as text."""
    counters, edges = _lineage(spark, sf_dir)
    totals = lin.numeric_totals(_shipped(spark, sf_dir), ("ttc", "total_ht")).withColumn(
        "output", F.lit("report_monthly")
    )
    rows = lin.run_report(counters, edges, totals)
    joined = lambda c: F.array_join(c, "; ").alias(c)
    return rows.select("output", joined("sources"), "n_read", "n_selected", "n_written", joined("totals"))


# --- files ------------------------------------------------------------------------------------------


@query
def file_roundtrip(spark, sf_dir):
    """Tickets written as journal files, one folder per shop, scanned and parsed back."""
    folder = new_folder(spark, "journals")
    # The text sink writes UTF-8, so the euro sign, one byte in the tills' code page, is left to a test.
    text = F.concat(F.lit("1-----------------------"), S.block_text(euro=False))
    S.dealt(S.tickets(spark, sf_dir)).select("shop", text.alias("value")).write.partitionBy("shop").option(
        "lineSep", "\n"
    ).text(folder)
    blocks = files.read_journals(spark, folder, ("SHOP=0", "SHOP=1"), pattern="part-*.txt")
    parsed = journal.reject_blocks(journal.parse_blocks(blocks), "fail", ("block_id",))
    return journal.parse_tickets(parsed).select(
        "shop", "internal_no", "type", F.col("ticket_date").cast("string").alias("ticket_date"), S.cents("ttc")
    )


@query
def contract_header(spark, sf_dir):
    """Files of one nation each, with the contract's header, one in another case, or another one."""
    folder = new_folder(spark, "headers")
    key = F.col("n_nationkey")
    header = F.when(key % 3 == 0, "key|name").when(key % 3 == 1, "Key|NAME").otherwise("name|key")
    row = F.concat_ws("|", key.cast("string"), "n_name")
    S.table(spark, sf_dir, "nation").select("n_nationkey", F.concat_ws("\n", header, row).alias("value")).write.partitionBy(
        "n_nationkey"
    ).text(folder)
    found = contract.header_verdicts(spark, folder, "key string, name string")
    nation = F.regexp_extract("file", r"n_nationkey=(\d+)", 1).cast("bigint")
    return found.select(nation.alias("n_nationkey"), "header", "verdict")


TICKET_CSV = {
    "internal_no": "string",
    "ticket_no": "string",
    "ticket_date": "date",
    "ticket_time": "string",
    "ht1": "decimal(18,2)",
    "vat1": "decimal(18,2)",
    "ttc": "decimal(18,2)",
    "pay_card": "decimal(18,2)",
}


@query
def csv_roundtrip(spark, sf_dir):
    """Sales exported as contract CSV per shop and year and read back."""
    folder = new_folder(spark, "csv")
    sold = tables.sales_only(S.tickets(spark, sf_dir), types=("F", "P")).withColumn(
        "year", F.year("ticket_date")
    )
    sinks.export_csv(
        sold, folder, list(TICKET_CSV), partition_by=("shop", "year"), order_by=tables.HEADER_ORDER
    )
    columns = {**TICKET_CSV, "shop": "string", "year": "int"}
    back = contract.read_contract_csv(
        spark, folder, ", ".join(f"{name} {kind}" for name, kind in columns.items())
    )
    return back.select(
        "shop", "year", "internal_no", "ticket_no", F.col("ticket_date").cast("string").alias("ticket_date"),
        "ticket_time", *(S.cents(c) for c in ("ht1", "vat1", "ttc", "pay_card")),
    )

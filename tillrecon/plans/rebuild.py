"""Full run: source files to validated tables to the monthly outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillrecon import fixed
from tillrecon.operators import checks, compare, journal, lineage, monthly, report, tables
from tillrecon.plans import staged
from tillrecon.sources import files, sinks
from tillrecon.sources.staging import scope, stage

TABLES = ("tickets", "ticket_lines", "report_headers", "report_lines")
# Columns that lay the tables out: what is asked for one family, shop or year reads its own files only.
PARTS = ("shop", "year")
LAYOUT = {"tickets": PARTS, "ticket_lines": PARTS, "report_headers": ("family", *PARTS), "report_lines": ("family", *PARTS)}
TICKET_COLUMNS = ("block_id", "file_name", "shop", *journal.HEADER, "year")
REPORT_COLUMNS = ("report_id", "family", "file_name", "shop", *report.HEADER, "year", "period")


@dataclass(frozen=True)
class Settings:
    """What differs from one set of tills to the next."""

    shops: Sequence[str]
    # Mode compared with the journal, per shop.
    retained_modes: Mapping[str, str] = field(default_factory=dict)
    # (mode, shop, year) that are not produced.
    excluded_modes: Sequence[tuple[str, str, int]] = ()
    # (mode, shop, year) -> mode that counts instead; modes that may occur at all.
    mode_overrides: Mapping[tuple[str, str, int], str] = field(default_factory=dict)
    modes: Sequence[str] = fixed.MODES
    natures: Sequence[str] = fixed.NATURES
    designations: Sequence[str] = fixed.DESIGNATIONS


def source_tables(spark: SparkSession, root: str, settings: Settings) -> dict[str, DataFrame]:
    """Parse journals and reports below ``root`` into the four tables.

    Every source text is parsed once: the parsed rows are written to the shared folder, and tickets
    and lines are both taken from there. An invalid block or report fails the job.
    """
    blocks = files.read_journals(spark, root, settings.shops)
    parsed = journal.parse_blocks(blocks)
    valid = journal.reject_blocks(parsed, "fail", ("rel_path", "block_pos"))
    dated = valid.drop("path", "rel_path", "block_pos", "errors").withColumn("year", F.year("ticket_date"))
    parsed_blocks = stage(dated, "blocks")

    texts = files.read_reports(spark, root, settings.shops)
    reports = report.reject_reports(report.parse_reports(texts), "fail", "rel_path")
    dated = tables.with_closing_period(reports.drop("path", "rel_path", "errors"))
    parsed_reports = stage(dated, "reports")
    return {
        "tickets": journal.parse_tickets(parsed_blocks).select(*TICKET_COLUMNS),
        "ticket_lines": journal.parse_ticket_lines(parsed_blocks, carry=PARTS),
        "report_headers": report.parse_report_headers(parsed_reports).select(*REPORT_COLUMNS),
        "report_lines": report.parse_report_lines(parsed_reports, carry=("family", *PARTS)),
    }


def measured_volumes(stored: Mapping[str, DataFrame]) -> DataFrame:
    """Every metric a rebuilt set of tables is validated by."""
    metrics = lineage.volume_metrics(stored["tickets"])
    orphans = checks.orphans(stored["ticket_lines"], stored["tickets"], "block_id")
    rows_without_report = checks.orphans(stored["report_lines"], stored["report_headers"], "report_id")
    twice = checks.duplicates(stored["tickets"], "shop", "internal_no")
    families = stored["report_headers"].groupBy("family").agg(F.count("*").alias("n"))
    rows = stored["report_lines"].groupBy("family").agg(F.count("*").alias("n"))
    named = lambda df, suffix: df.select(
        F.concat("family", F.lit(suffix)).alias("metric"), F.col("n").cast(lineage.VALUE_TYPE).alias("value")
    )
    return (
        metrics.unionByName(
            lineage.row_counts(
                details=stored["ticket_lines"],
                lines_without_ticket=orphans,
                rows_without_report=rows_without_report,
                repeated_internal_no=twice,
            )
        )
        .unionByName(named(families, "_files"))
        .unionByName(named(rows, "_lines"))
    )


# What holds for every set of tills.
INVARIANTS = (("lines_without_ticket", 0), ("rows_without_report", 0), ("repeated_internal_no", 0))


def rebuild(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    settings: Settings,
    expected: Sequence[tuple[str, object]] = (),
    publish: bool = True,
    staged_volumes: Mapping[tuple[str, str], int] | None = None,
    keep: int | None = None,
) -> str:
    """Parse, write aside, validate, publish; returns the folder of the run.

    ``expected`` holds (metric, value) pairs that have to be met besides the invariants. Sources that
    change during the run fail it. With ``staged_volumes`` (set, shop) -> rows, the staged files are written into the
    run as well, and other volumes than these fail it. ``keep`` published runs stay, all without it.
    """
    def write(folder: str) -> None:
        sinks.write_tables(source_tables(spark, source_root, settings), folder, LAYOUT)

    def validate(folder: str) -> None:
        wanted = spark.createDataFrame(
            [(m, str(v)) for m, v in (*INVARIANTS, *expected)], "metric string, expected string"
        ).withColumn("expected", F.col("expected").cast(lineage.VALUE_TYPE))
        stored = sinks.read_tables(spark, folder, TABLES)
        checks.assert_expectations(measured_volumes(stored), wanted)
        after = files.content_digests(spark, source_root)
        moved = files.diff_fingerprints(before, after, mark="digest").filter("status != 'same'")
        changed = checks.describe(moved, "rel_path")
        if changed:
            raise ValueError(f"sources changed during the run: {changed}")
        if staged_volumes is not None:
            staged.export_staged(stored, f"{folder}/staged", staged_volumes)

    # What is staged on the way is removed, whether the run is published or fails.
    with scope():
        before = stage(files.content_digests(spark, source_root), "digests")
        return sinks.publish_if_valid(spark, target_root, write, validate, publish, keep)


# Columns of the outputs that are quantities, and decimals that are no amounts.
QUANTITIES = ("labels", "occurrences")
RATES = ("gap",)

# Immediate sources of every output.
OUTPUT_SOURCES = {
    "coherence": ("tickets",),
    "sequence": ("tickets",),
    "internal_no_occurrences": ("tickets",),
    "ticket_no_occurrences": ("tickets",),
    "header_vs_lines": ("tickets", "ticket_lines"),
    "label_occurrences": ("tickets", "ticket_lines"),
    "vat_occurrences": ("tickets", "ticket_lines"),
    "z1_totals": ("report_lines", "report_headers"),
    "z2_totals": ("report_lines", "report_headers"),
    "z1_matrix": ("report_lines", "report_headers"),
    "z2_control": ("report_lines", "report_headers"),
    "revenue": ("tickets",),
    "payments": ("tickets",),
    "internal_no_duplicates": ("internal_no_occurrences",),
    "ticket_no_duplicates": ("ticket_no_occurrences",),
    "modes_compared": ("z2_totals",),
    "z2_against_journal": ("z2_totals", "payments"),
    "z1_against_journal": ("z1_totals", "revenue"),
    "revenue_all_shops": ("revenue",),
    "declared": ("revenue_all_shops",),
}
KEYS = ("shop", "year", "period")
# A control output: rows in it are differences that must not be.
CONTROLS = ("z2_control",)
# The parts an output can be computed for by themselves: by shop and year, all of a shop, all shops of a year.
SCOPES = {name: PARTS for name in OUTPUT_SOURCES} | {
    name: ("shop",)
    for name in (
        "sequence", "internal_no_occurrences", "ticket_no_occurrences", "header_vs_lines", "label_occurrences",
        "vat_occurrences", "internal_no_duplicates", "ticket_no_duplicates",
    )
} | {"revenue_all_shops": ("year",), "declared": ("year",)}


def _unwatched(df: DataFrame, output: str, counter: str) -> DataFrame:
    return df


def _everything(df: DataFrame, output: str) -> DataFrame:
    return df


def base_outputs(
    stored: Mapping[str, DataFrame], settings: Settings, watch: Callable = _unwatched, only: Callable = _everything
) -> dict[str, Callable[[], DataFrame]]:
    """The outputs that come straight from the stored tables, for all shops at once: name -> what builds it.

    Nothing runs until an output is built; ``sequence`` stores its order then. ``only(df, output)`` leaves the
    parts that the output is computed for, ``watch(df, output, counter)`` marks the rows it reads and
    selects. A mode outside the settings' modes fails the job.
    """

    def source(output: str, name: str, *columns: str, family: str | None = None) -> DataFrame:
        rows = stored[name] if family is None else stored[name].filter(F.col("family") == family)
        rows = only(rows, output)
        return watch(rows.select(*columns) if columns else rows, output, f"read:{name}")

    def sales(output: str) -> DataFrame:
        return watch(tables.sales_only(source(output, "tickets")), output, "selected")

    def rows(output: str, family: str) -> DataFrame:
        """Report rows of a family in the modes that apply, both spellings of a designation as one."""
        lines = source(output, "report_lines", family=family).drop("family", *PARTS)
        own = source(output, "report_headers", "report_id", "family", "mode", "file_code", *KEYS, family=family)
        found = tables.report_rows(lines, _resolved(own, settings))
        return watch(found, output, "selected").withColumn(
            "designation", monthly.canonical_designation(F.col("designation"))
        )

    def line_values(output: str, column: str) -> DataFrame:
        lines = source(output, "ticket_lines").drop(*PARTS)
        sold = tables.sales_only(source(output, "tickets")).select("block_id", "shop")
        wide = tables.ticket_lines_wide(lines, sold)
        return checks.occurrences(watch(wide, output, "selected"), "shop", column, counted=column)

    def matrix(output: str) -> DataFrame:
        """Every pair of file and mode that occurs is a key of the map."""
        lines = source(output, "report_lines", "report_id", family="z1")
        own = source(output, "report_headers", "report_id", *KEYS, "report_date", "file_code", "mode", family="z1")
        return monthly.occurrence_map(
            watch(tables.report_rows(lines, own), output, "selected"), (*KEYS, "report_date"), ("file_code", "mode")
        )

    def of_modes(output: str, family: str, values, how=monthly.mode_totals, **options) -> DataFrame:
        return how(rows(output, family), None, values, by=("shop", "mode"), **options)

    def month_sums(output: str, measures) -> DataFrame:
        return monthly.monthly_totals(monthly.with_totals_and_period(sales(output)), measures, by=("shop",))

    quantities = {"qty": "bigint"}
    return {
        "coherence": lambda: checks.header_coherence(sales("coherence")),
        "sequence": lambda: checks.sequence_gaps(sales("sequence")),
        "internal_no_occurrences": lambda: checks.occurrences(sales("internal_no_occurrences"), "shop", "internal_no"),
        "ticket_no_occurrences": lambda: checks.occurrences(sales("ticket_no_occurrences"), "shop", "ticket_no"),
        "header_vs_lines": lambda: checks.header_vs_lines(
            checks.ticket_totals_by_join(
                source("header_vs_lines", "ticket_lines"), sales("header_vs_lines"), keys=("shop", "ticket_no", "ttc")
            )
        ),
        "label_occurrences": lambda: line_values("label_occurrences", "label"),
        "vat_occurrences": lambda: line_values("vat_occurrences", "vat_code"),
        "z1_totals": lambda: of_modes("z1_totals", "z1", settings.designations, measures=("amount",)),
        "z2_totals": lambda: of_modes("z2_totals", "z2", settings.natures, sum_type=quantities),
        "z1_matrix": lambda: matrix("z1_matrix"),
        "z2_control": lambda: compare.differing_totals(
            of_modes("z2_control", "z2", settings.natures, sum_type=quantities),
            monthly.conditional_totals(
                # The control reads for itself, unwatched.
                base_rows({n: only(df, "z2_control") for n, df in stored.items()}, settings, "z2"),
                settings.natures, by=("shop", "mode"), sum_type=quantities,
            ),
            ("shop", "mode", "year", "period"),
        ),
        "revenue": lambda: month_sums("revenue", monthly.REVENUE),
        "payments": lambda: month_sums("payments", monthly.PAYMENTS),
    }


def _resolved(headers: DataFrame, settings: Settings) -> DataFrame:
    """Report headers in the modes that apply, under the mode that counts."""
    own = monthly.applicable_modes(headers, settings.excluded_modes, settings.mode_overrides, settings.modes)
    return own.withColumn("mode", F.col("resolved_mode")).drop("resolved_mode")


def base_rows(stored: Mapping[str, DataFrame], settings: Settings, family: str) -> DataFrame:
    """Report rows of a family in the modes that apply."""
    columns = ("report_id", "family", "shop", "mode", "year", "period")
    own = stored["report_headers"].select(*columns).filter(F.col("family") == family)
    lines = stored["report_lines"].filter(F.col("family") == family).drop("family", *PARTS)
    found = tables.report_rows(lines, _resolved(own, settings))
    return found.withColumn("designation", monthly.canonical_designation(F.col("designation")))


def derived_outputs(
    base: Mapping[str, DataFrame],
    settings: Settings,
    year: int | None = None,
    watch: Callable = _unwatched,
    only: Callable = _everything,
) -> dict[str, Callable[[], DataFrame]]:
    """The outputs that come from other outputs (``base``): name -> what builds it.

    ``year`` restricts the comparisons; it is applied to both sides before they meet. ``base`` is looked into when
    an output is built. ``watch`` and ``only`` are as in :func:`base_outputs`.
    """

    def read(output: str, source: str) -> DataFrame:
        return watch(only(base[source], output), output, f"read:{source}")

    def of_year(output: str, source: str, choose=None) -> DataFrame:
        rows = read(output, source)
        rows = rows if choose is None else choose(rows)
        rows = rows if year is None else lineage.rows_of_year(rows, year)
        return watch(rows, output, f"selected:{source}")

    def in_mode(rows: DataFrame, mode: str) -> DataFrame:
        return rows.filter(F.col("mode") == mode).drop("mode")

    def repeated(output: str, source: str) -> DataFrame:
        return watch(read(output, source).filter("occurrences > 1"), output, "selected")

    def modes_compared() -> DataFrame:
        """Both modes come from one read of the totals."""
        name = "modes_compared"
        both = of_year(name, "z2_totals", lambda rows: rows.filter(F.col("mode").isin("ZZ1", "ZZ2")))
        measures = [f"{monthly.safe_name(n)}_{m}" for n in settings.natures for m in ("qty", "amount")]
        return compare.reconcile_tagged(
            both.withColumn("_side", F.when(F.col("mode") == "ZZ1", "left").otherwise("right")),
            {m: (m, m) for m in measures}, "zero", KEYS,
        )

    kept = lambda totals: monthly.retained_mode(totals, dict(settings.retained_modes)).drop("mode")
    found = {
        "internal_no_duplicates": lambda: repeated("internal_no_duplicates", "internal_no_occurrences"),
        "ticket_no_duplicates": lambda: repeated("ticket_no_duplicates", "ticket_no_occurrences"),
        "modes_compared": modes_compared,
        "revenue_all_shops": lambda: compare.consolidate(
            read("revenue_all_shops", "revenue"), settings.shops, monthly.REVENUE
        ),
    }
    if settings.retained_modes:
        found["z2_against_journal"] = lambda: compare.reconcile(
            of_year("z2_against_journal", "z2_totals", kept),
            of_year("z2_against_journal", "payments"),
            {
                "card_qty": None,
                "card_gap": ("CARTES_amount", "pay_card"),
                "cheque_qty": None,
                "cheque_gap": ("CHEQUES_amount", "pay_cheque"),
                "cash_qty": None,
                "cash_gap": ("ESPECES_amount", "pay_cash"),
            },
            "null",
            KEYS,
        )
        found["z1_against_journal"] = lambda: compare.reconcile(
            of_year("z1_against_journal", "z1_totals", kept),
            of_year("z1_against_journal", "revenue"),
            {
                "ttc_gap": ("CA_NET", "ttc"),
                "ht_gap": ("HORS_TAXES_1", "total_ht"),
                "vat_gap": ("TVA_1", "total_vat20"),
            },
            "null",
            KEYS,
            strict=True,
        )
    return found


def declared_output(all_shops: DataFrame, declared: DataFrame, watch: Callable = _unwatched) -> DataFrame:
    """Months of all shops beside declared ones (year, period, ht20_declared, vat20_declared)."""
    return compare.compare_declared(
        watch(all_shops, "declared", "read:revenue_all_shops"),
        declared,
        {
            "gap_ht20": ("total_total_ht", "ht20_declared"),
            "gap_vat20": ("total_total_vat20", "vat20_declared"),
        },
    )


def outputs(
    stored: Mapping[str, DataFrame],
    settings: Settings,
    year: int | None = None,
    declared: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All outputs by name; what depends on another output is computed from it."""
    found = {name: build() for name, build in base_outputs(stored, settings).items()}
    found |= {name: build() for name, build in derived_outputs(found, settings, year).items()}
    if declared is not None:
        found["declared"] = declared_output(found["revenue_all_shops"], declared)
    return found


def base_tables_of(output: str) -> set[str]:
    """Stored tables that an output comes from, directly or through others."""
    found: set[str] = set()
    for source in OUTPUT_SOURCES[output]:
        found |= {source} if source in TABLES else base_tables_of(source)
    return found


def changed_parts(spark: SparkSession, folder: str, previous: str | None) -> dict[str, set[tuple] | None]:
    """For each output the parts (values of its scope) that have to be computed again; None: all of it.

    A part that comes or goes has changed as well.
    """
    if previous is None:
        return dict.fromkeys(OUTPUT_SOURCES)
    keys = ["name", *PARTS]
    before, after = (spark.read.parquet(f"{f}/marks") for f in (previous, folder))
    pairs = before.select(*keys, F.col("mark").alias("_was")).alias("b").join(
        after.select(*keys, F.col("mark").alias("_is")).alias("a"),
        [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer",
    )
    pick = lambda k: F.when(F.col("a._is").isNotNull(), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k)
    # One row per table, shop and year.
    moved = pairs.filter(~F.col("_was").eqNullSafe(F.col("_is"))).select(*map(pick, keys)).collect()
    if any(r["name"] == "settings" for r in moved):
        return dict.fromkeys(OUTPUT_SOURCES)
    found: dict[str, set[tuple] | None] = {}
    for output, scope in SCOPES.items():
        given = base_tables_of(output)
        found[output] = {tuple(r[c] for c in scope) for r in moved if r["name"] in given}
    # What is declared is not marked.
    return found | {"declared": None}


def write_outputs(
    stored: Mapping[str, DataFrame],
    settings: Settings,
    folder: str,
    year: int | None = None,
    declared: DataFrame | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Write every output below ``folder`` and a report on them; returns the report.

    ``previous`` is the folder of an earlier call. Parts of outputs (a shop and year, a shop, a year) whose
    tables have not changed there since are taken over from it, unless the settings or the year are others; only
    the others are read and computed.

    Outputs that others depend on are written first and read back by these. Rows are counted, and columns
    added up, by the write itself, where it reads, selects and writes them. The report has one row per output:
    its sources, the rows read, selected, taken over and written, and its control totals. A control that
    finds a difference, and more rows read than the sources hold, are errors.
    """
    spark = next(iter(stored.values())).sparkSession
    told = spark.range(1).select(
        F.lit("settings").alias("name"), F.lit(None).cast("string").alias("shop"), F.lit(None).cast("int").alias("year"),
        F.lit(0).cast("bigint").alias("n"), F.lit(repr((settings, year))).alias("mark"),
    )
    lineage.table_marks(PARTS, **{name: stored[name] for name in TABLES}).unionByName(told).write.parquet(f"{folder}/marks")
    parts = changed_parts(spark, folder, previous)
    log = lineage.Lineage()
    written: dict[str, DataFrame] = {}

    def only(df: DataFrame, output: str) -> DataFrame:
        """The parts of a source that an output is computed for; whole files are left out by them."""
        return df if parts[output] is None else df.filter(lineage.within(df, SCOPES[output], parts[output]))

    def write(name: str, build: Callable[[], DataFrame]) -> None:
        log.declare(name, *OUTPUT_SOURCES[name])
        # Nothing of an output that is taken over as a whole is planned or run.
        df = build() if parts[name] is None or parts[name] else None
        if parts[name] is not None:
            before = spark.read.parquet(f"{previous}/{name}")
            kept = log.observed(before.filter(~lineage.within(before, SCOPES[name], parts[name])), name, "kept")
            df = kept if df is None else kept.unionByName(df)
        quantities = [c for c in df.columns if c in QUANTITIES or c.endswith("_qty")]
        log.observed(df, name, "written", lineage.measures_of(df, quantities, RATES)).write.parquet(f"{folder}/{name}")
        written[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        if name in CONTROLS and log.count(name, "written"):
            raise ValueError(f"{name} finds differences: {checks.describe(written[name], 'shop', 'mode', 'year', 'period')}")

    with scope(), lineage.observing(spark):
        for name, build in base_outputs(stored, settings, log.observed, only).items():
            write(name, build)
        for name, build in derived_outputs(written, settings, year, log.observed, only).items():
            write(name, build)
        if declared is not None:
            write("declared", lambda: declared_output(written["revenue_all_shops"], declared, log.observed))
    edges = log.edges(spark)
    # As many rows as the tables had when the run began.
    base = spark.read.parquet(f"{folder}/marks").filter("name <> 'settings'").groupBy(F.col("name").alias("output")).agg(F.sum("n").alias("n"))
    counts = log.counts(spark)
    of = lambda counter: counts.filter(F.split_part("counter", F.lit(":"), F.lit(1)) == counter).groupBy("output").agg(F.sum("n").alias("n"))
    counters = lineage.lineage(of("written").unionByName(base), edges, of("selected"), of("read"), of("kept"))
    # A task that was lost and run again counts twice; rows that are really read twice stay too many.
    too_many = [r for r in lineage.check_lineage(counters, edges).collect() if log.recount(r["output"], "read") > r["n_available"]]
    if too_many:
        shown = "; ".join(f"{r['output']} {r['n_read']} of {r['n_available']}" for r in too_many)
        raise ValueError(f"more rows read than the sources hold: {shown}")
    report_rows = lineage.run_report(counters, edges, log.totals(spark))
    tables.in_order(report_rows, "output").write.json(f"{folder}/report")
    return spark.read.schema(report_rows.schema).json(f"{folder}/report")

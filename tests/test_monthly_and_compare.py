from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillrecon.operators import checks, compare, monthly, tables


def frame(spark, columns, *rows):
    """Rows of (year, period, amounts…); amounts are decimals."""
    schema = "year int, period string, " + ", ".join(f"{c} decimal(28,2)" for c in columns.split())
    data = [(r[0], r[1], *(None if v is None else D(str(v)) for v in r[2:])) for r in rows]
    return spark.createDataFrame(data, schema)


def test_missing_counts_as_zero(spark):
    left = frame(spark, "q a", (2021, "2021-05", 4, 12.5), (2021, "2021-07", 9, 81))
    right = frame(spark, "q a", (2021, "2021-05", 4, 12.75), (2021, "2021-06", 2, 6.4))
    gaps = compare.reconcile(left, right, {"q": ("q", "q"), "a": ("a", "a")}, "zero")
    assert [tuple(r) for r in tables.in_order(gaps, "year", "period").collect()] == [
        (2021, "2021-05", D("0.00"), D("-0.25"), "both"),
        (2021, "2021-06", D("-2.00"), D("-6.40"), "right_only"),
        (2021, "2021-07", D("9.00"), D("81.00"), "left_only"),
    ]


def test_missing_stays_blank(spark):
    z2 = frame(spark, "CARTES CHEQUES", (2024, "2024-01", 11, 2), (2024, "2024-02", 48.2, None), (2022, "2022-09", 3, 3))
    ej = frame(spark, "card cheque", (2024, "2024-02", 40, 6.1), (2024, "2024-03", 8, 9), (2022, "2022-09", 4, 4))
    gaps = compare.reconcile(
        z2, ej, {"qty": None, "card": ("CARTES", "card"), "cheque": ("CHEQUES", "cheque")}, "null", year=2024
    )
    assert [tuple(r) for r in tables.in_order(gaps, "period").collect()] == [
        (2024, "2024-01", None, None, None, "left_only"),
        (2024, "2024-02", None, D("8.20"), D("-6.10"), "both"),
        (2024, "2024-03", None, None, None, "right_only"),
    ]
    absent = compare.missing_periods(gaps).collect()
    assert {(r.period, r.absent_from) for r in absent} == {("2024-01", "right"), ("2024-03", "left")}


def test_strict_measures_and_repeated_periods_fail(spark):
    one = frame(spark, "a", (2024, "2024-01", None))
    other = frame(spark, "a", (2024, "2024-01", 1))
    with pytest.raises(Exception, match="amount a is missing"):
        compare.reconcile(one, other, {"g": ("a", "a")}, "null", strict=True).collect()
    twice = other.unionByName(other)
    for missing in ("zero", "null"):
        with pytest.raises(Exception, match="duplicate period in right: 2024, 2024-01"):
            compare.reconcile(other, twice, {"g": ("a", "a")}, missing).collect()
    # A check holds whichever columns are read.
    gaps = {"g": ("a", "a")}
    for job in (lambda df: df.count(), lambda df: df.select("period", "status").collect(), lambda df: compare.missing_periods(df).count()):
        with pytest.raises(Exception, match="amount a is missing"):
            job(compare.reconcile(one, other, gaps, "null", strict=True))
        with pytest.raises(Exception, match="duplicate period in right"):
            job(compare.reconcile(other, twice, gaps, "null"))
    alone = spark.createDataFrame([("N", 2024, "2024-02", 3)], "shop string, year int, period string, ttc long")
    for job in (lambda df: df.count(), lambda df: df.select("period", "N_ttc").collect()):
        with pytest.raises(Exception, match="not in every shop exactly once"):
            job(compare.consolidate(alone, ("N", "S"), ("ttc",)))
    nameless = spark.createDataFrame([("Z001_x.CSV", 1)], "file_name string, n int")
    with pytest.raises(Exception, match="no closing period"):
        tables.with_closing_period(nameless).select("n").collect()
    with pytest.raises(ValueError, match="missing columns: b"):
        compare.reconcile(one, other, {"g": ("a", "b")}, "null")
    with pytest.raises(ValueError):
        compare.reconcile(one, other, {"g": ("a", "a")}, "maybe")


def test_consolidate(spark):
    rows = [("N", 2024, "2024-02", 3), ("S", 2024, "2024-02", 4), ("N", 2024, "2024-01", 1), ("S", 2024, "2024-01", 2)]
    df = spark.createDataFrame(rows, "shop string, year int, period string, ttc long")
    found = tables.in_order(compare.consolidate(df, ("N", "S"), ("ttc",)), "period").collect()
    assert [tuple(r) for r in found] == [(2024, "2024-01", 1, 2, 3), (2024, "2024-02", 3, 4, 7)]
    short = df.filter("NOT (shop = 'S' AND period = '2024-01')")
    with pytest.raises(Exception, match="not in every shop exactly once: 2024, 2024-01"):
        compare.consolidate(short, ("N", "S"), ("ttc",)).collect()
    with pytest.raises(Exception, match="not in every shop"):
        compare.consolidate(df.unionByName(df.limit(1)), ("N", "S"), ("ttc",)).collect()
    lax = compare.consolidate(short, ("N", "S"), ("ttc",), strict=False, keep_shops=False)
    assert {(r.period, r.total_ttc) for r in lax.collect()} == {("2024-01", None), ("2024-02", 7)}


def test_compare_declared(spark):
    own = frame(spark, "ht vat", (2024, "2024-01", 100, 20), (2024, "2024-02", 50, 10), (2024, "2024-03", 1, 1))
    declared = frame(spark, "ht20 vat20", (2024, "2024-01", 90, None), (2024, "2024-02", None, 11))
    found = compare.compare_declared(own, declared, {"gap_ht": ("ht", "ht20"), "gap_vat": ("vat", "vat20")})
    assert [(r.period, r.gap_ht, r.gap_vat) for r in tables.in_order(found, "period").collect()] == [
        ("2024-01", D("10.00"), None), ("2024-02", None, D("-1.00")), ("2024-03", None, None),
    ]


def test_same_totals(spark):
    left = frame(spark, "a b", (2024, "2024-01", 1, 2), (2024, "2024-02", 0, 0))
    right = frame(spark, "a b", (2024, "2024-01", 1, 2))
    assert compare.assert_same_totals(left, right) is left
    with pytest.raises(ValueError, match="2024, 2024-01"):
        compare.assert_same_totals(left, frame(spark, "a b", (2024, "2024-01", 1, 3)))


@pytest.fixture
def rows(spark):
    data = [
        ("N", "ZZ1", 2024, "2024-01", "CARTES", 2, "10.00"), ("N", "ZZ1", 2024, "2024-01", "CARTES", 1, "5.00"),
        ("N", "ZZ1", 2024, "2024-01", "REF./TIROIR", 4, "0.00"), ("N", "ZZ1", 2024, "2024-02", "OTHER", 9, "9.00"),
        ("N", "Z", 2024, "2024-01", "CARTES", 7, "70.00"), ("S", "Z", 2024, "2024-01", "ESPECES", 1, "1.00"),
    ]
    df = spark.createDataFrame(data, "shop string, mode string, year int, period string, designation string, qty long, amount string")
    return df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def test_mode_totals_and_control(rows):
    natures = ("CARTES", "REF./TIROIR")
    totals = monthly.mode_totals(rows, "ZZ1", natures, sum_type={"qty": "bigint"})
    found = {r.period: tuple(r)[2:] for r in totals.collect()}
    # A month with rows of that mode but none of the natures keeps its place, with zeros.
    assert found == {
        "2024-01": (3, D("15.00"), 4, D("0.00")), "2024-02": (0, D("0.00"), 0, D("0.00")),
    }
    assert totals.columns[2:] == ["CARTES_qty", "CARTES_amount", "REF__TIROIR_qty", "REF__TIROIR_amount"]
    control = monthly.conditional_totals(
        monthly.for_mode(rows, "ZZ1"), natures, sum_type={"qty": "bigint"}
    )
    assert compare.differing_totals(totals, control).count() == 0
    # Building the plan asks nothing of the data; any job on it fails, whatever it reads.
    absent = monthly.mode_totals(rows, "ZZ2", natures)
    for job in (absent.count, absent.select("period").collect):
        with pytest.raises(Exception, match="mode not in the data: ZZ2"):
            job()
    assert monthly.mode_totals(rows, "ZZ2", natures, on_missing_mode="empty").count() == 0


def test_modes(spark, rows):
    requested = spark.createDataFrame([("ZZ1", "N", 2024), ("Z", "N", 2024), ("Z", "S", 2024)], "mode string, shop string, year int")
    found = monthly.applicable_modes(requested, [("Z", "N", 2024)], {("Z", "S", 2024): "ZZ2"}).collect()
    assert {tuple(r) for r in found} == {("ZZ1", "N", 2024, "ZZ1"), ("Z", "S", 2024, "ZZ2")}
    unknown = requested.withColumn("mode", F.lit("Q"))
    with pytest.raises(Exception, match="unknown mode: Q"):
        monthly.applicable_modes(unknown).collect()
    kept = monthly.retained_mode(rows, {"N": "ZZ1", "S": "Z"}).collect()
    assert len(kept) == 5 and {(r.shop, r.mode) for r in kept} == {("N", "ZZ1"), ("S", "Z")}


def test_natures_designations_matrix(rows, value):
    assert monthly.for_natures(rows).count() == 5
    assert value(monthly.canonical_designation, "HORS TAXE 1", "HORS TAXES 1", "TVA 1", None) == [
        "HORS TAXES 1", "HORS TAXES 1", "TVA 1", None,
    ]
    matrix = monthly.occurrence_matrix(rows, ("shop", "period"), ("shop", "mode"), ("N_Z", "N_ZZ1"))
    assert {tuple(r) for r in matrix.collect()} == {
        ("N", "2024-01", 1, 3), ("N", "2024-02", None, 1), ("S", "2024-01", None, None),
    }


def test_totals_periods_and_sums(spark):
    tickets = spark.sql(
        "SELECT DATE'2024-01-05' ticket_date, 1.00BD ht1, 2.00BD ht2, CAST(NULL AS DECIMAL(18,2)) ht3,"
        " 4.00BD ht4, 5.00BD ht_exempt, CAST(NULL AS DECIMAL(18,2)) vat1, 12.50BD ttc"
    )
    t = monthly.with_totals_and_period(tickets)
    assert tuple(t.select("total_ht", "total_vat20", "year", "period").first()) == (D("12.00"), D("0.00"), 2024, "2024-01")
    by_rows = monthly.monthly_totals(t, monthly.REVENUE).first()
    by_date = monthly.monthly_totals(t, monthly.REVENUE, date="ticket_date").first()
    assert by_rows == by_date and by_date.ttc == D("12.50")


def test_header_coherence(spark):
    df = spark.sql("SELECT 108.31BD ht1, 21.67BD vat1, 129.98BD ttc, CAST(NULL AS DECIMAL(18,2)) pay_card, 40BD pay_cheque")
    row = checks.header_coherence(df).first()
    assert (row.vat_expected, row.vat_gap, row.ttc_expected, row.ttc_gap, row.balance_due) == tuple(
        map(D, ("21.6620", "0.0080", "129.98", "0.00", "89.98"))
    )


def test_sales_and_shop_year(spark):
    df = spark.createDataFrame(
        [("REG", "1", "N", 2023), ("REG", " ", "N", 2023), ("_R_F", "2", "S", 2024), ("Z", "3", "N", 2023), ("REG", None, "N", 2023)],
        "type string, ticket_no string, shop string, year int",
    )
    sales = tables.sales_only(df)
    assert {r.ticket_no for r in sales.collect()} == {"1", "2"}
    assert {r.ticket_no for r in tables.for_shop_year(sales, "N", 2023).collect()} == {"1"}


def test_occurrences_and_lines(spark):
    data = [("1", "9.00", "A", "5.00", None), ("1", "9.00", None, "3.00", None), ("1", "9.00", None, None, "-1.00"), ("2", "4.00", "B", "4.00", None)]
    lines = spark.createDataFrame(data, "ticket_no string, ttc string, label string, amount string, correction string")
    lines = lines.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("ttc", "amount", "correction")})
    assert {(r.label, r.occurrences) for r in checks.occurrences(lines, "label").collect()} == {("A", 1), ("B", 1), (None, 0)}
    assert [(r.ticket_no, r.occurrences) for r in checks.duplicates(lines, "ticket_no").collect()] == [("1", 3)]
    with pytest.raises(ValueError, match="duplicate key: 1"):
        checks.assert_unique(lines, "ticket_no")
    totals = checks.header_vs_lines(checks.ticket_line_totals(lines))
    assert {(r.ticket_no, r.labels, r.ttc_gap) for r in totals.collect()} == {("1", 1, D("2.00")), ("2", 1, D("0.00"))}


def test_orphans_unknown_columns(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r.v for r in checks.orphans(child, parent, "k", "id").collect()] == ["b"]
    assert {r.v for r in checks.unknown_values(child, "v", ("a", "b")).collect()} == {"c"}
    assert checks.require_columns(child, "k", "v") is child
    with pytest.raises(ValueError, match="missing columns: x, y"):
        checks.require_columns(child, "y", "k", "x")


def test_expectations(spark):
    metrics = spark.createDataFrame([("a", D(1)), ("b", D(2)), ("z", D(3))], "metric string, value decimal(38,2)")
    wanted = spark.createDataFrame([("a", D(1)), ("b", D(5)), ("c", D(0))], "metric string, expected decimal(38,2)")
    with pytest.raises(ValueError, match="b: expected 5.00, found 2.00; c: expected 0.00, found None"):
        checks.assert_expectations(metrics, wanted)
    checks.assert_expectations(metrics, wanted.filter("metric = 'a'"))


def test_contract_text(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('0407', '19-08-2022', 1180BD, '12.00'), ('7', NULL, NULL, NULL) v(no, day, amount, qty)"
    )
    text = tables.contract_text(df, ["no"], ["day"], ["amount"], ["qty"])
    assert [tuple(r) for r in text.collect()] == [("0407", "2022-08-19", "1180.00", "12"), ("7", "", "", "")]
    with pytest.raises(TypeError):
        tables.contract_text(df, ["amount"])


def test_reconcile_sums_of_rows_in_one_shuffle(spark):
    left = spark.sql("SELECT * FROM VALUES (DATE'2024-01-05', 5.00BD), (DATE'2024-01-31', 1.00BD), (DATE'2024-02-01', 2.00BD) v(day, a)")
    right = spark.sql("SELECT * FROM VALUES (DATE'2024-01-09', 4.00BD), (DATE'2024-03-01', 7.00BD) v(day, b)")
    for missing in ("null", "zero"):
        found = compare.reconcile_sums(left, right, {"gap": ("a", "b"), "blank": None}, missing, date="day", keep_measures=True)
        sums = [monthly.monthly_totals(df, (m,), date="day") for df, m in ((left, "a"), (right, "b"))]
        other = compare.reconcile(*sums, {"gap": ("a", "b"), "blank": None}, missing, keep_measures=True)
        assert found.dtypes == other.dtypes and sorted(found.collect()) == sorted(other.collect()) and found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    none = left.withColumn("a", F.when(F.col("a") > 2, F.col("a")))
    compare.reconcile_sums(none, right, {"gap": ("a", "b")}, "null", date="day").collect()
    with pytest.raises(Exception, match="amount a is missing"):
        compare.reconcile_sums(none, right, {"gap": ("a", "b")}, "null", date="day", strict=True).collect()

import dataclasses
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillrecon.operators import monthly
from tillrecon.plans import rebuild as R, staged
from tillrecon.sources import sinks

SEP = "1-----------------------"
SETTINGS = R.Settings(
    shops=("NORTH", "SOUTH"), retained_modes={"NORTH": "ZZ1", "SOUTH": "Z"}, excluded_modes=[("ZZ2", "SOUTH", 2024)]
)


def block(kind, number, body):
    return f"{SEP}\r\n{kind}  05-01-2024 16:42\r\n {number}\r\n{body}2-----------------------\r\nS\r\n"


def sale(number, ttc, means="CARTES", kind="REG"):
    return block(
        kind, number,
        f"1 BAG T1 €{ttc}.00\r\nHORS TAXE 1 €{ttc}.00\r\nTVA 1 €0.00\r\nTOTAL €{ttc}.00\r\n{means} €{ttc}.00\r\nFACTURE No. {number}\r\n",
    )


def z_report(code, mode, rows):
    head = {"MODELE": "", "MACHINE": "MC", "RAPPORT": "R", "FICHIER": code, "MODE": mode, "COMPTEUR Z": "0001", "DATE": "01-02-2024", "HEURE": "13:48"}
    lines = [f'"{k:16}","{v:8}"' for k, v in head.items()] + ["", '"ENREGISTREMENT  ","DESIGNATION     ","QUANTITE/No     ","MONTANT         "']
    lines += [f'"{i:04d}","{name:12}","{q}","{amount}"' for i, (name, q, amount) in enumerate(rows, 1)]
    return "\r\n".join(lines) + "\r\n"


@pytest.fixture
def sources(tmp_path):
    return made_sources(tmp_path / "sources")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables of one run, for tests that only read them."""
    root = tmp_path_factory.mktemp("stored")
    run = R.rebuild(spark, str(made_sources(root / "sources")), str(root / "target"), SETTINGS)
    return sinks.read_tables(spark, run, R.TABLES)


def made_sources(root):
    z2 = lambda card, cash: [("CARTES", 1, card), ("ESPECES", 1, cash), ("CHEQUES", 0, "0.00")]
    z1 = lambda ttc: [("CA NET", 1, ttc), ("HORS TAXE 1", 1, ttc), ("TVA 1", 1, "0.00")]
    files = {
        "NORTH/EJ1.TXT": sale("001", 30) + sale("002", 10, "ESPECES") + sale("003", 5, "ESPECES", "_R_F") + block("Z", "004", "x\r\n"),
        "SOUTH/EJ2.TXT": sale("001", 7),
        "NORTH/Z101_01_012024_N.CSV": z_report("FILE101", "ZZ1", z1("36.00")),
        "NORTH/Z102_01_012024_N.CSV": z_report("FILE102", "ZZ1", z2("31.00", "5.00")),
        "NORTH/Z202_01_012024_N.CSV": z_report("FILE202", "ZZ2", z2("30.00", "5.00")),
        "SOUTH/Z001_01_012024_S.CSV": z_report("FILE001", "Z", z1("7.00")),
        "SOUTH/Z002_01_012024_S.CSV": z_report("FILE002", "Z", z2("7.00", "0.00")),
        "SOUTH/Z202_01_012024_S.CSV": z_report("FILE202", "ZZ2", z2("9.00", "9.00")),
        "SOUTH/Z005_01_012024_S.CSV": "not a report that is read",
    }
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode("cp1252"))
    return root


EXPECTED = [("blocks", 5), ("sales", 4), ("returns", 1), ("returns_ttc", D("-5.00")), ("details", 4),
            ("z1_files", 2), ("z1_lines", 6), ("z2_files", 4), ("z2_lines", 12), ("sales:SOUTH", 1)]


def test_rebuild_and_outputs(spark, sources, tmp_path):
    target = str(tmp_path / "target")
    run = R.rebuild(spark, str(sources), target, SETTINGS, EXPECTED)
    assert sinks.current_run(spark, target) == run
    stored = sinks.read_tables(spark, run, R.TABLES)
    out = R.outputs(stored, SETTINGS, 2024)
    rows = {name: [r.asDict() for r in df.collect()] for name, df in out.items()}

    assert rows["z2_control"] == []
    pay = {r["shop"]: r for r in rows["z2_against_journal"]}
    assert (pay["NORTH"]["card_gap"], pay["NORTH"]["cash_gap"], pay["NORTH"]["card_qty"]) == (D("1.00"), D("0.00"), None)
    assert (pay["SOUTH"]["card_gap"], pay["SOUTH"]["status"]) == (D("0.00"), "both")
    own = {r["shop"]: r for r in rows["z1_against_journal"]}
    assert (own["NORTH"]["ttc_gap"], own["NORTH"]["ht_gap"]) == (D("1.00"), D("1.00"))
    assert own["SOUTH"]["ttc_gap"] == D("0.00")
    (modes,) = rows["modes_compared"]
    assert (modes["shop"], modes["CARTES_amount"], modes["ESPECES_amount"]) == ("NORTH", D("1.00"), D("0.00"))
    (both,) = rows["revenue_all_shops"]
    assert (both["NORTH_ttc"], both["SOUTH_ttc"], both["total_ttc"]) == (D("35.00"), D("7.00"), D("42.00"))
    assert len(rows["z1_matrix"]) == 2 and len(rows["coherence"]) == 4


def test_written_outputs_and_their_report(spark, stored, tmp_path):
    declared = spark.createDataFrame(
        [(2024, "2024-01", D("40.00"), None)], "year int, period string, ht20_declared decimal(18,2), vat20_declared decimal(18,2)"
    )
    folder = str(tmp_path / "out")
    report = {r.output: r for r in R.write_outputs(stored, SETTINGS, folder, 2024, declared).collect()}
    assert set(report) == {*R.OUTPUT_SOURCES, *R.TABLES}
    counters = lambda name: (report[name].n_read, report[name].n_selected, report[name].n_written)
    assert report["z2_against_journal"].sources == ["payments", "z2_totals"]
    # Of three monthly totals the two in their shop's mode are selected; the payments are read beside them.
    assert counters("z2_against_journal") == (5, 4, 2)
    # Five tickets, four of them sales; of eighteen report rows and six headers only the files of z1 are read.
    assert counters("coherence") == (5, 4, 4)
    assert counters("z1_totals") == (8, 6, 2)
    assert {r.n_kept for r in report.values()} == {0}
    assert counters("internal_no_duplicates") == (4, 0, 0)
    assert "ttc: 42,00" in report["revenue"].totals
    (row,) = spark.read.parquet(f"{folder}/declared").collect()
    assert (row.gap_ht20, row.gap_vat20) == (D("2.00"), None)
    lines = {r.ticket_no: r.ttc_gap for r in spark.read.parquet(f"{folder}/header_vs_lines").collect() if r.shop == "NORTH"}
    assert lines == {"001": 0, "002": 0, "003": 0}
    gaps = spark.read.parquet(f"{folder}/sequence").filter("shop = 'NORTH'").orderBy("internal_no").collect()
    assert [r.gap for r in gaps] == [None, 1, 1]
    assert spark.read.parquet(f"{folder}/internal_no_duplicates").count() == 0


def test_staged_files(spark, sources, tmp_path):
    stored = sinks.read_tables(spark, R.rebuild(spark, str(sources), str(tmp_path / "target"), SETTINGS), R.TABLES)
    volumes = {("tickets", "NORTH"): 3, ("tickets", "SOUTH"): 1, ("ticket_lines", "NORTH"): 3, ("ticket_lines", "SOUTH"): 1,
               ("z1", "NORTH"): 3, ("z1", "SOUTH"): 3, ("z2", "NORTH"): 6, ("z2", "SOUTH"): 6}
    folder = str(tmp_path / "staged")
    assert staged.export_staged(stored, folder, volumes) == volumes
    rows = staged.read_staged(spark, folder, "ticket_lines").filter("shop = 'NORTH'").orderBy("E_NUM_INTERNE").collect()
    assert len(rows[0]) == 25 and len(staged.LINE) == 24
    assert [(r.E_NUM_TICKET, r.E_DATE_TICKET, r.E_TTC, r.E_MDP_ESPECES, r.D_QUANTITE_ARTICLE, r.D_MONTANT_ARTICLE) for r in rows] == [
        ("001", "2024-01-05", "30.00", None, "1", "30.00"), ("002", "2024-01-05", "10.00", "10.00", "1", "10.00"),
        ("003", "2024-01-05", "-5.00", "-5.00", "1", "-5.00"),
    ]
    reports = staged.read_staged(spark, folder, "z2").filter("shop = 'SOUTH' AND year = 2024 AND E_MODE = 'Z'").collect()
    assert {(r.D_DESIGNATION, r.D_QUANTITE, r.D_MONTANT) for r in reports} == {("CARTES", "1", "7.00"), ("ESPECES", "1", "0.00"), ("CHEQUES", "0", "0.00")}
    # A run writes them as well, and other volumes fail it.
    run = R.rebuild(spark, str(sources), str(tmp_path / "other"), SETTINGS, staged_volumes=volumes)
    assert staged.read_staged(spark, f"{run}/staged", "z2").count() == 12
    with pytest.raises(ValueError, match=r"tickets SOUTH \(2, 1\)"):
        R.rebuild(spark, str(sources), str(tmp_path / "other"), SETTINGS, staged_volumes=volumes | {("tickets", "SOUTH"): 2})
    assert sinks.current_run(spark, str(tmp_path / "other")) == run
    with pytest.raises(ValueError, match=r"z1 NORTH \(4, 3\)"):
        staged.export_staged(stored, str(tmp_path / "again"), {("z1", "NORTH"): 4})


def test_another_year_selects_nothing(spark, stored, tmp_path):
    report = {r.output: r for r in R.write_outputs(stored, SETTINGS, str(tmp_path / "out"), 2023).collect()}
    assert (report["z1_against_journal"].n_read, report["z1_against_journal"].n_selected) == (4, 0)
    # An unexpected pair of file and mode has its key, and its column where columns are asked for.
    mapped = spark.read.parquet(str(tmp_path / "out" / "z1_matrix"))
    assert {r.shop: r.counts for r in mapped.collect()} == {"NORTH": {"FILE101_ZZ1": 3}, "SOUTH": {"FILE001_Z": 3}}
    wide = {r.shop: r for r in monthly.as_columns(mapped).collect()}
    assert (wide["SOUTH"].FILE001_Z, wide["SOUTH"].FILE101_ZZ1) == (3, None)
    with pytest.raises(ValueError, match="more than 1 values"):
        monthly.as_columns(mapped, widest=1)


def test_unchanged_outputs_are_taken_over(spark, stored, tmp_path):
    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    first = {r.output: r for r in R.write_outputs(stored, SETTINGS, one, 2024).collect()}
    mark(spark, one, "label_occurrences", "z1_totals")
    moved = dict(stored, report_lines=stored["report_lines"].filter("designation <> 'TVA 1'"))
    R.write_outputs(moved, SETTINGS, two, 2024, previous=one)
    assert spark.read.parquet(f"{two}/label_occurrences").count() == 2 * first["label_occurrences"].n_written
    assert spark.read.parquet(f"{two}/z1_totals").count() == first["z1_totals"].n_written
    R.write_outputs(stored, SETTINGS, three, 2023, previous=one)
    assert spark.read.parquet(f"{three}/label_occurrences").count() == first["label_occurrences"].n_written


def mark(spark, folder, *names):
    """Every row of an output twice, to see which rows come from this folder."""
    for name in names:
        df = spark.read.parquet(f"{folder}/{name}")
        df.unionByName(df).write.parquet(f"{folder}/{name}_more")
        os.rename(f"{folder}/{name}", f"{folder}/{name}_old")
        os.rename(f"{folder}/{name}_more", f"{folder}/{name}")


def test_only_the_parts_that_changed_are_computed(spark, stored, tmp_path, monkeypatch):
    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    R.write_outputs(stored, SETTINGS, one, 2024)
    mark(spark, one, "payments", "coherence", "internal_no_occurrences")
    dearer = F.when(F.col("shop") == "SOUTH", F.col("ttc") + 1).otherwise(F.col("ttc")).cast("decimal(18,2)")
    moved = dict(stored, tickets=stored["tickets"].withColumn("ttc", dearer))
    marks = lambda tables: R.lineage.table_marks(R.PARTS, **{n: tables[n] for n in R.TABLES})
    assert marks(moved).exceptAll(marks(stored)).select("name", "shop", "year").collect() == [("tickets", "SOUTH", 2024)]
    report = {r.output: r for r in R.write_outputs(moved, SETTINGS, two, 2024, previous=one).collect()}
    # The rows of NORTH come from the earlier folder, where each stands twice; those of SOUTH are new.
    for name, north, south in (("payments", 2, 1), ("coherence", 6, 1), ("internal_no_occurrences", 6, 1)):
        found = spark.read.parquet(f"{two}/{name}").groupBy("shop").count().collect()
        assert {r.shop: r["count"] for r in found} == {"NORTH": north, "SOUTH": south}, name
        assert (report[name].n_read, report[name].n_kept, report[name].n_written) == (1, north, north + south)
    assert spark.read.parquet(f"{two}/revenue").filter("shop = 'SOUTH'").first().ttc == D("8.00")
    assert report["z1_totals"].n_read == 0 and report["z1_totals"].n_kept == 2
    # Nothing changed: nothing is built, and neither order nor members are looked for.
    monkeypatch.setattr(R.checks, "sequence_gaps", None)
    monkeypatch.setattr(R.monthly, "occurrence_map", None)
    again = R.write_outputs(moved, SETTINGS, three, 2024, previous=two).collect()
    assert {(r.n_read, r.n_selected) for r in again} == {(0, 0)} and sum(r.n_kept for r in again) > 0


def test_files_of_other_parts_are_not_read(spark, stored, tmp_path):
    assert dict(stored["tickets"].dtypes)["year"] == "int" and dict(stored["report_lines"].dtypes)["shop"] == "string"
    only = lambda df, output: df.filter(R.lineage.within(df, R.SCOPES[output], {("NORTH", 2024)}))
    build = R.base_outputs(stored, SETTINGS, only=only)
    for name, files in (("z1_totals", "family"), ("coherence", "year"), ("revenue", "shop")):
        plan = build[name]()._jdf.queryExecution().executedPlan().toString()
        for scan in (p for p in plan.split("FileScan parquet")[1:]):
            assert files in scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0], scan


def test_counters_are_those_of_the_write(spark, sources, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    run = R.rebuild(spark, str(sources), target, SETTINGS)
    stored = sinks.read_tables(spark, run, R.TABLES)
    derived = R.derived_outputs

    def grown(*a):
        # The table grows after the base outputs are written.
        stored["tickets"].limit(3).write.mode("append").partitionBy("shop", "year").parquet(f"{run}/tickets")
        stored["tickets"] = sinks.read_tables(spark, run, ["tickets"])["tickets"]
        assert stored["tickets"].count() == 8
        return derived(*a)

    monkeypatch.setattr(R, "derived_outputs", grown)
    report = {r.output: r for r in R.write_outputs(dict(stored), SETTINGS, str(tmp_path / "out"), 2024).collect()}
    assert (report["coherence"].n_read, report["coherence"].n_selected, report["tickets"].n_written) == (5, 4, 5)


def test_reading_a_source_twice_stops_the_run(spark, stored, tmp_path, monkeypatch):
    base = R.base_outputs

    def twice(*a):
        found = base(*a)
        return found | {"coherence": lambda: found["coherence"]().unionByName(found["coherence"]())}

    monkeypatch.setattr(R, "base_outputs", twice)
    with pytest.raises(ValueError, match="more rows read than the sources hold: coherence 10 of 5"):
        R.write_outputs(stored, SETTINGS, str(tmp_path / "out"), 2024)


def test_an_amount_that_moves_to_a_null_column_is_not_taken_over(spark, stored, tmp_path):
    one, two = (str(tmp_path / n) for n in ("one", "two"))
    R.write_outputs(stored, SETTINGS, one, 2024)
    only = F.col("pay_card").isNotNull() & F.col("pay_cash").isNull()
    assert stored["tickets"].filter(only).count() > 0
    moved = stored["tickets"].withColumns({"pay_card": F.when(~only, F.col("pay_card")), "pay_cash": F.when(only, F.col("pay_card")).otherwise(F.col("pay_cash"))})
    R.write_outputs(dict(stored, tickets=moved), SETTINGS, two, 2024, previous=one)
    rows = lambda folder: sorted(map(str, spark.read.parquet(f"{folder}/payments").collect()))
    assert rows(one) != rows(two)


def test_mode_rules_and_control_stop_the_run(spark, stored, tmp_path, monkeypatch):
    narrow = dataclasses.replace(SETTINGS, modes=("ZZ1", "Z"))
    with pytest.raises(Exception, match="unknown mode: ZZ2"):
        R.outputs(stored, narrow)["z2_totals"].collect()
    moved = dataclasses.replace(SETTINGS, mode_overrides={("ZZ2", "NORTH", 2024): "Z"})
    assert {r.mode for r in R.outputs(stored, moved)["z2_totals"].filter("shop = 'NORTH'").collect()} == {"ZZ1", "Z"}
    control = R.base_rows
    monkeypatch.setattr(R, "base_rows", lambda *a: control(*a).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)")))
    with pytest.raises(ValueError, match="z2_control finds differences: 3 cases: NORTH, ZZ1, 2024, 2024-01"):
        R.write_outputs(stored, SETTINGS, str(tmp_path / "out"))


def test_a_failing_run_leaves_the_published_one(spark, sources, tmp_path):
    target = str(tmp_path / "target")
    first = R.rebuild(spark, str(sources), target, SETTINGS)
    with pytest.raises(ValueError, match="blocks: expected 6.00, found 5.00; sales: expected 5.00, found 4.00"):
        R.rebuild(spark, str(sources), target, SETTINGS, [("blocks", 6), ("sales", 5)])
    journal = sources / "SOUTH" / "EJ2.TXT"
    text = journal.read_bytes()
    journal.write_bytes(text + text)
    with pytest.raises(ValueError, match="repeated_internal_no: expected 0.00, found 1.00"):
        R.rebuild(spark, str(sources), target, SETTINGS)
    journal.write_bytes(text + f"{SEP}\nbroken\n".encode())
    with pytest.raises(Exception, match="invalid ticket block sources/SOUTH/EJ2.TXT 1 header:format"):
        R.rebuild(spark, str(sources), target, SETTINGS)
    assert sinks.current_run(spark, target) == first and len(os.listdir(f"{target}/runs")) == 1


@pytest.mark.skipif("TILL_SOURCES" not in os.environ, reason="no folder with real till files given")
def test_real_report_files(spark, tmp_path):
    """Volumes of a real source tree: TILL_SOURCES names it, TILL_SHOPS its shops, comma-separated."""
    settings = R.Settings(shops=os.environ["TILL_SHOPS"].split(","))
    expected = [("z1_files", 96), ("z1_lines", 3936), ("z2_files", 96), ("z2_lines", 4800)]
    R.rebuild(spark, os.environ["TILL_SOURCES"], str(tmp_path / "t"), settings, expected)

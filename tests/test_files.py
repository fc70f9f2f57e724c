import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tillrecon.sources import contract, files, sinks

SEP = "1-----------------------"


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "NORTH above" / "sources"
    for name, blocks in {
        "EXPORT_north/2023/EJ 1é.TXT": ["A\x80", "B"],
        "EXPORT_SOUTH/EJ2.TXT": ["C"],
        "other/EJ3.TXT": ["D"],
        "north/south/EJ4.TXT": ["E"],
        "EXPORT_SOUTH/XX.TXT": ["F"],
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = "lost\r\n" + "".join(f"{SEP}\r\n{b}\r\n" for b in blocks)
        path.write_bytes(text.encode("latin-1"))
    return str(root)


SHOPS = ("NORTH", "SOUTH")


def test_journals(spark, tree):
    rows = files.read_journals(spark, tree, SHOPS).collect()
    found = sorted((r.shop, r.file_name, r.block_pos, r.block, r.block_id) for r in rows)
    assert found == [
        ("NORTH", "EJ 1é.TXT", 0, "\r\nA€\r\n", "sources/EXPORT_north/2023/EJ 1é.TXT#0"),
        ("NORTH", "EJ 1é.TXT", 1, "\r\nB\r\n", "sources/EXPORT_north/2023/EJ 1é.TXT#1"),
        ("SOUTH", "EJ2.TXT", 0, "\r\nC\r\n", "sources/EXPORT_SOUTH/EJ2.TXT#0"),
    ]
    kept = files.read_journals(spark, tree, SHOPS, on_unclear="keep").filter("shop IS NULL").collect()
    assert sorted(r.file_name for r in kept) == ["EJ3.TXT", "EJ4.TXT"]
    with pytest.raises(Exception, match="not exactly one shop"):
        files.read_journals(spark, tree, SHOPS, on_unclear="fail").collect()
    with pytest.raises(ValueError, match="absolute"):
        files.shop_from_path(F.col("path"), "sources", SHOPS)


def test_journals_of_many_splits(spark, tree):
    """The same blocks with the same ids however a file is split, and when settings change before the rows are read."""
    big = os.path.join(tree, "EXPORT_SOUTH", "EJ+ 9.TXT")
    bodies = [f"\r\nblock {i} €{'x' * (i % 90)}\r\n" for i in range(3000)]
    texts = {
        "EJ+ 9.TXT": "".join(SEP + b for b in bodies),
        "EJ ends.TXT": "head" + "".join(SEP + b for b in bodies[:700]) + SEP,  # a last block without text
        "EJ none.TXT": "no block at all", "EJ empty.TXT": "", "EJ only.TXT": SEP,
    }
    for name, text in texts.items():
        with open(os.path.join(os.path.dirname(big), name), "wb") as f:
            f.write(text.encode("cp1252"))
    expected = {(f"sources/EXPORT_SOUTH/{n}#{i}", i, b) for n, t in texts.items() for i, b in enumerate(t.split(SEP)[1:])}
    assert len(expected) == 3702
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    for build, run in ((("128m", "1"), ("9000", "40")), (("10000", "3"), ("128m", "1")), (("50", "1"), ("7000", "2"))):
        if build[0] == "50":  # many tiny splits: one small file only
            os.remove(big)
            expected = {e for e in expected if "EJ+ 9" not in e[0]}
            build = ("400", "1")
        try:
            for k, v in zip(settings, build):
                spark.conf.set(k, v)
            df = files.read_journals(spark, tree, SHOPS).filter("file_name NOT IN ('EJ 1é.TXT', 'EJ2.TXT')")
            for k, v in zip(settings, run):
                spark.conf.set(k, v)
            rows = [tuple(r) for r in df.select("block_id", "block_pos", "block").collect()]
            assert len(rows) == len(expected) and set(rows) == expected
        finally:
            for k in settings:
                spark.conf.unset(k)


def test_unclear_shop_fails_whichever_columns_are_read(spark, tree):
    with pytest.raises(Exception, match="not exactly one shop"):
        files.read_journals(spark, tree, SHOPS, on_unclear="fail").select("block_id").count()


def test_content_digests(spark, tmp_path, monkeypatch):
    root = tmp_path / "sources"
    root.mkdir()
    text = {"a.TXT": "".join(f"line {i}\n" for i in range(3000)), "b.csv": "x\ny", "c.txt": "x\ny\n", "d.txt": "", "e é+.txt": "y\nx", "f.TXT": "\n\n"}
    for name, t in text.items():
        (root / name).write_text(t)
    monkeypatch.setattr(files, "LEAF_LINES", 100)
    digests = lambda: {r.rel_path.split("/")[-1]: r.digest for r in files.content_digests(spark, str(root)).collect()}
    one = digests()
    assert set(one) == set(text) - {"d.txt"} and len(set(one.values())) == 5
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for bytes_ in ("1000", "7777"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            assert digests() == one
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    before = spark.createDataFrame(files.content_digests(spark, str(root)).collect())
    lines = text["a.TXT"].splitlines(keepends=True)
    lines[5], lines[2000] = lines[2000], lines[5]  # places in one file change, its lines and size do not
    (root / "a.TXT").write_text("".join(lines))
    (root / "c.txt").unlink()
    (root / "g.txt").write_text("new")
    diff = files.diff_fingerprints(before, files.content_digests(spark, str(root)), mark="digest").collect()
    status = {r.rel_path.split("/")[-1]: r.status for r in diff}
    assert status == {"a.TXT": "changed", "b.csv": "same", "c.txt": "removed", "e é+.txt": "same", "f.TXT": "same", "g.txt": "added"}


def test_staged_folders(spark, tmp_path, monkeypatch):
    from tillrecon.sources import staging

    try:
        with staging.scope():
            table = staging.stage(spark.range(5), "t")
            (path,) = {os.path.dirname(f).removeprefix("file://") for f in table.inputFiles()}
            assert os.path.isdir(path)
            raise KeyError
    except KeyError:
        pass
    assert not os.path.exists(path)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_reports(spark, tmp_path):
    names = ["Z001_1.CSV", "z101_2.csv", "Z201A.CSV", "Z002_3.CSV", "Z005_4.CSV", "Z001_5.TXT"]
    folder = tmp_path / "in" / "south"
    folder.mkdir(parents=True)
    for n in names:
        (folder / n).write_text("x")
    rows = files.read_reports(spark, str(tmp_path / "in"), SHOPS).collect()
    assert sorted((r.file_name, r.family, r.shop, r.text) for r in rows) == [
        ("Z001_1.CSV", "z1", "SOUTH", "x"), ("Z002_3.CSV", "z2", "SOUTH", "x"),
        ("Z201A.CSV", "z1", "SOUTH", "x"), ("z101_2.csv", "z1", "SOUTH", "x"),
    ]
    (tmp_path / "in" / "Z001_9.CSV").write_text("x")
    with pytest.raises(Exception, match="not exactly one shop"):
        files.read_reports(spark, str(tmp_path / "in"), SHOPS).collect()


def test_fingerprints(spark, tmp_path):
    import hashlib

    root = tmp_path / "s"
    root.mkdir()
    for name, text in (("a.TXT", "1"), ("b.csv", "2"), ("c.Csv", "3"), ("d.ods", "4")):
        (root / name).write_text(text)
    before = files.source_fingerprints(spark, str(root)).collect()
    assert {r.rel_path: r.sha256 for r in before} == {
        f"s/{n}": hashlib.sha256(t).hexdigest() for n, t in (("a.TXT", b"1"), ("b.csv", b"2"), ("c.Csv", b"3"))
    }
    df = spark.createDataFrame(before)
    (root / "a.TXT").write_text("9")
    (root / "b.csv").unlink()
    (root / "e.txt").write_text("5")
    diff = files.diff_fingerprints(df, files.source_fingerprints(spark, str(root))).collect()
    assert {r.rel_path: r.status for r in diff} == {
        "s/a.TXT": "changed", "s/b.csv": "removed", "s/c.Csv": "same", "s/e.txt": "added",
    }


SCHEMA = "id string, label string, d date, amount decimal(18,2)"


def test_contract_csv(spark, tmp_path):
    path = tmp_path / "staged.csv"
    path.write_text('id|label|d|amount\n0021|"a|""b"""|2023-04-01|299.00\n7|||\n', encoding="utf-8-sig")
    rows = contract.read_contract_csv(spark, str(path), SCHEMA).collect()
    assert [(r.id, r.label, str(r.d), str(r.amount)) for r in rows] == [
        ("0021", 'a|"b"', "2023-04-01", "299.00"), ("7", None, "None", "None"),
    ]
    for header in ("id|name|d|amount", "ID|label|d|amount", "id|label|d", "id|label|d|amount|more"):
        path.write_text(f"{header}\n1|a|2023-04-01|1.00\n")
        with pytest.raises(ValueError, match="header is not the contract's in 1 cases"):
            contract.read_contract_csv(spark, str(path), SCHEMA)
    path.write_text("id|label|d|amount\n1|a|04/01/2023|1.00\n")
    for job in (lambda df: df.collect(), lambda df: df.select("id").collect()):
        with pytest.raises(Exception):
            job(contract.read_contract_csv(spark, str(path), SCHEMA))


def test_export_csv(spark, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES ('A', 2023, '01', NULL, DATE'2023-04-01', 2.50BD, 1),"
        " ('A', 2023, '00', 'x|\"y', NULL, 3BD, 2), ('B', 2024, '02', '', NULL, NULL, 3)"
        " v(shop, year, id, label, d, amount, extra)"
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    out = str(tmp_path / "csv")
    sinks.export_csv(df, out, ["id", "label", "d", "amount"], ("shop", "year"), ("id",))
    text = sorted(p.read_text() for p in (tmp_path / "csv" / "shop=A" / "year=2023").glob("*.csv"))
    body = [line for t in text for line in t.splitlines() if line != "id|label|d|amount"]
    assert sorted(body) == ["00|\"x|\"\"y\"||3.00", "01||2023-04-01|2.50"]
    back = contract.read_contract_csv(spark, out, SCHEMA + ", shop string, year int").collect()
    assert sorted((r.shop, r.year, r.id) for r in back) == [("A", 2023, "00"), ("A", 2023, "01"), ("B", 2024, "02")]


def test_publish_if_valid(spark, tmp_path):
    root = str(tmp_path / "target")
    write = lambda folder: sinks.write_tables({"t": spark.range(3)}, folder)
    assert sinks.current_run(spark, root) is None
    first = sinks.publish_if_valid(spark, root, write, lambda folder: None)
    assert sinks.current_run(spark, root) == first
    assert sinks.read_tables(spark, first, ["t"])["t"].count() == 3

    def refuse(folder):
        assert os.path.isdir(f"{folder}/t")
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish_if_valid(spark, root, write, refuse)
    assert sinks.current_run(spark, root) == first and len(os.listdir(f"{root}/runs")) == 1
    kept_aside = sinks.publish_if_valid(spark, root, write, lambda folder: None, publish=False)
    assert sinks.current_run(spark, root) == first and os.path.isdir(kept_aside)
    runs = [sinks.publish_if_valid(spark, root, write, lambda folder: None, keep=2) for _ in range(3)]
    assert sinks.current_run(spark, root) == runs[-1] and not os.path.exists(first) and not os.path.exists(runs[0])
    assert sorted(n for n in os.listdir(f"{root}/published") if n.isdigit()) == ["000000000003", "000000000004"]
    with pytest.raises(ValueError, match="current run"):
        sinks.retain(spark, root, 0)


def test_two_publishers_get_two_numbers(spark, tmp_path):
    root = str(tmp_path / "target")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: sinks.publish_run(spark, root, f"run {i}"), range(24)))
    assert sorted(numbers) == list(range(1, 25))
    assert sinks.current_run(spark, root) == f"run {numbers.index(24)}"
    # A publisher that ended between number and run, clocks that are wrong: neither counts.
    (tmp_path / "target/published/000000000025").touch()
    os.utime(tmp_path / "target/published/000000000003", (2**33, 2**33))
    assert sinks.current_run(spark, root) == f"run {numbers.index(24)}"
    assert sinks.publish_run(spark, root, "next") == 26 and sinks.current_run(spark, root) == "next"
    assert len(sinks.retain(spark, root, 2)) == 23

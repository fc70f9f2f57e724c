from decimal import Decimal as D

from tillrecon.operators import lineage


def test_measures_follow_the_schema(spark):
    df = spark.sql("SELECT 1 year, '2024-01' period, 2L qty, 3L internal_no, 1.50BD paid, 0.2BD share, 'x' label")
    assert lineage.measures_of(df) == ["paid", "share"]
    assert lineage.measures_of(df, quantities=("qty",), rates=("share",)) == ["qty", "paid"]


def test_numeric_totals(spark):
    df = spark.sql("SELECT * FROM VALUES (2024, 1, 2.50BD, 7, 'x'), (2024, 2, -1.00BD, 8, 'y') v(year, qty, amount, internal_no, gap)")
    assert {(r.field, r.total) for r in lineage.numeric_totals(df, lineage.measures_of(df, ("qty",))).collect()} == {("qty", D("3.00")), ("amount", D("1.50"))}
    assert lineage.numeric_totals(df.select("year"), []).count() == 0
    rows = spark.sql("SELECT * FROM VALUES ('A', 1, 2.00BD), ('A', 1, 3.00BD), ('', 9, 9BD), (NULL, 9, 9BD) v(n, qty, amount)")
    assert {(r.field, r.total) for r in lineage.numeric_totals_long(rows, "n", ("qty", "amount")).collect()} == {
        ("A / qty", D("2.00")), ("A / amount", D("5.00")),
    }


def test_what_a_change_affects(spark):
    sources = {"a": ("t", "u"), "b": ("a",), "c": ("u",), "d": ("b", "c")}
    assert lineage.affected(sources, {"t"}) == {"a", "b", "d"}
    assert lineage.affected(sources, set()) == set() and lineage.affected(sources, {"c"}) == {"c", "d"}
    df = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    marks = {r.name: r.mark for r in lineage.table_marks(one=df, two=df.repartition(3), three=df.distinct(), none=df.limit(0)).collect()}
    assert marks["one"] == marks["two"] != marks["three"] and marks["none"].startswith("0")
    parts = {(r.name, r.i): (r.n, r.mark) for r in lineage.table_marks(["i"], one=df, four=df.filter("i = 2")).collect()}
    assert parts["one", 2] == parts["four", 2] and parts["one", 1] != parts["one", 2] and parts["one", 2][0] == 2
    assert df.filter(lineage.within(df, ("i", "s"), {(2, None), (1, "y")})).count() == 2
    assert df.filter(~lineage.within(df, ("s",), set())).count() == 3


def test_marks_see_a_value_that_moves_to_a_null(spark):
    rows = "SELECT 1 id, {}BD pay_card, {}BD pay_cash, array({}) a, named_struct('x', {}, 'y', {}) s"
    given = {
        "one": ("5.00", "NULL", "NULL, 1", "'v'", "NULL"), "card": ("NULL", "5.00", "NULL, 1", "'v'", "NULL"),
        "array": ("5.00", "NULL", "1, NULL", "'v'", "NULL"), "struct": ("5.00", "NULL", "NULL, 1", "NULL", "'v'"),
    }
    frames = {n: spark.sql(rows.format(*v).replace("NULLBD", "CAST(NULL AS DECIMAL(18,2))").replace("5.00BD", "CAST(5 AS DECIMAL(18,2))")) for n, v in given.items()}
    marks = {r.name: r.mark for r in lineage.table_marks(**frames, again=frames["one"]).collect()}
    assert marks["one"] == marks["again"] and len(set(marks.values())) == 4


def test_counters_follow_the_declared_sources(spark):
    edges = spark.createDataFrame([("out", "a"), ("out", "b"), ("next", "out")], "output string, source string")
    written = spark.createDataFrame([("a", 12), ("b", 32), ("out", 8), ("next", 8)], "output string, n long")
    selected = spark.createDataFrame([("out", 24)], "output string, n long")
    counters = lineage.lineage(written, edges, selected)
    assert {tuple(r) for r in counters.collect()} == {
        ("a", 0, 0, 12), ("b", 0, 0, 32), ("out", 44, 24, 8), ("next", 8, 8, 8),
    }
    assert lineage.check_lineage(counters, edges).count() == 0
    # Observed reads count as they are.
    seen = spark.createDataFrame([("out", 45), ("next", 7)], "output string, n long")
    observed = lineage.lineage(written, edges, selected, seen)
    assert {r.output: r.n_read for r in observed.collect()} == {"a": 0, "b": 0, "out": 45, "next": 7}
    assert [tuple(r) for r in lineage.check_lineage(observed, edges).collect()] == [("out", 45, 44)]
    claimed = counters.withColumn("n_read", counters.n_read + 1)
    assert {r.output for r in lineage.check_lineage(claimed, edges).collect()} == {"out", "next"}
    totals = spark.createDataFrame([("out", "ttc", D("1234.50")), ("out", "ht", D("-0.001"))], "output string, field string, total decimal(20,3)")
    report = {r.output: r for r in lineage.run_report(counters, edges, totals).collect()}
    assert report["out"].sources == ["a", "b"] and report["out"].totals == ["ht: 0,00", "ttc: 1234,50"]
    assert report["next"].totals == [] and len(report) == 4


def test_observed_while_writing(spark, tmp_path):
    log = lineage.Lineage()
    log.declare("big", "numbers")
    df = log.observed(spark.range(100), "big", "read")
    df = log.observed(df.filter("id >= 90"), "big", "written")
    df.write.parquet(str(tmp_path / "big"))
    assert {tuple(r) for r in log.counts(spark).collect()} == {("big", "read", 100), ("big", "written", 10)}
    assert [tuple(r) for r in log.edges(spark).collect()] == [("big", "numbers")]
    # Two places that read count one by one, sums come with the count.
    again = log.observed(spark.range(5), "two", "read").unionByName(log.observed(spark.range(7), "two", "read"))
    amounts = again.selectExpr("id", "CAST(id AS DECIMAL(18,2)) amount", "CAST(NULL AS DECIMAL(18,2)) nothing")
    log.observed(amounts, "two", "written", ["amount", "nothing"]).write.parquet(str(tmp_path / "two"))
    assert log.count("two", "read") == log.count("two", "written") == log.recount("two", "read") == 12
    assert [tuple(r) for r in log.totals(spark).collect()] == [("two", "amount", D("31.00"))]


def test_volume_metrics(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('REG','1','N',5BD), ('_R_F','2','S',-3BD), ('_R_F',' ','S',-9BD), ('Z',NULL,'N',NULL) v(type, ticket_no, shop, ttc)"
    )
    found = {r.metric: r.value for r in lineage.volume_metrics(df).collect()}
    assert found == {
        "blocks": 4, "sales": 2, "not_sales": 2, "returns": 1, "returns_ttc": -3, "sales:N": 1, "sales:S": 1,
        "type:REG": 1, "type:_R_F": 2, "type:Z": 1,
    }
    assert lineage.rows_of_year(spark.sql("SELECT 2023 year UNION ALL SELECT 2024"), 2024).count() == 1

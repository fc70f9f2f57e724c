from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillrecon.functions import money as M, periods as P, text as X


def test_money_accepts(value):
    texts = ["€299.00", "299.00", "€1,233.50", "€1_233.50", "€1*233.50", "€-12.00", "-8,301.00", " 1.00 ", "1234567.89"]
    expected = ["299.00", "299.00", "1233.50", "1233.50", "1233.50", "-12.00", "-8301.00", "1.00", "1234567.89"]
    assert value(M.money, *texts) == [Decimal(e) for e in expected]


def test_money_rejects(value):
    texts = ["", "€abc", "€12.3", "-€12.00", "1,23.00", "12.345", "$3.00", "1 000.00", None, "€", "99999999999999999999.00"]
    assert value(M.money, *texts) == [None] * len(texts)


def test_signed(spark):
    df = spark.sql("SELECT t, CAST(a AS DECIMAL(18,2)) a FROM VALUES ('_R_F', 5), ('_R_F', -5), ('REG', 5), ('_R_F', NULL) v(t, a)")
    rows = df.select(M.signed(F.col("a"), F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [Decimal("-5.00"), Decimal("-5.00"), Decimal("5.00"), None]


def test_amount_and_whole_text(value):
    assert value(lambda x: M.amount_text(x.cast("decimal(20,3)")), "75", "2.125", None) == ["75.00", "2.12", ""]
    assert value(M.whole_text, "75.00", "75", "", None, "0") == ["75", "75", "", "", "0"]
    with pytest.raises(Exception, match="not a whole number: 7.5"):
        value(M.whole_text, "7.5")


def test_french_number(value):
    amounts = ["1234.5", "-0.001", "0", "12", None]
    assert value(lambda x: M.french_number(x.cast("decimal(20,3)")), *amounts) == [
        "1234,50", "0,00", "0,00", "12,00", None,
    ]
    assert value(lambda x: M.french_number(x.cast("decimal(20,3)"), monetary=False), "75", "7.50", "100", "0") == [
        "75", "7,5", "100", "0",
    ]


def test_number_or_null(value):
    assert value(M.number_or_null, "0035", " 7 ", "", "x", "3.5", None) == [Decimal(35), Decimal(7), None, None, None, None]


def test_iso_date(value):
    assert value(P.iso_date, "01-04-2023", "2023-04-01", "20230401", "1-4-2023", "", None) == [date(2023, 4, 1)] * 4 + [None] * 2
    assert value(P.iso_date, "202311", "2023111", "2023-1- 1") == [date(2023, 1, 1), date(2023, 11, 1), date(2023, 1, 1)]
    assert value(P.printed_date, "2023-04-01", "29-02-2023", "29-02-2024", " 1-4-2023 ", "01-01-0000") == [
        None, None, date(2024, 2, 29), date(2023, 4, 1), None,
    ]
    for wrong in ("2023-02-31", "04/01/2023", "2023-04-01 00:00"):
        with pytest.raises(Exception, match="not a date"):
            value(P.iso_date, wrong)


def test_clock_time(value):
    assert value(P.clock_time, "11:25", "24:00", "23:59", "7:00", None) == ["11:25", None, "23:59", None, None]


def test_closing_period(value):
    names = ["Z102_02_082025_A.CSV", "Z002_01_062025_072025_B.CSV", "Z002_042025_052025_062025.csv", "z1_122023 .CSV"]
    found = value(P.closing_period, *names)
    assert [(r.year, r.period) for r in found] == [(2025, "2025-08"), (2025, "2025-07"), (2025, "2025-06"), (2023, "2023-12")]
    with pytest.raises(Exception, match="no closing period"):
        value(P.closing_period, "Z102_A.CSV")
    assert value(lambda x: P.closing_period(x, "null"), "Z102_A.CSV")[0].period is None


def test_year_and_month(value):
    assert value(P.strict_year, "2024", " 2024.0 ") == [2024, 2024]
    year = lambda x: P.strict_month(x, F.lit(2024))
    assert value(year, "1", "12.0", "2024-03") == [1, 12, 3]
    for wrong in ("13", "0", "2023-03", "2024-", "x"):
        with pytest.raises(Exception, match="not a month"):
            value(year, wrong)
    for wrong in ("2024.5", "", "year"):
        with pytest.raises(Exception, match="not a year"):
            value(P.strict_year, wrong)
    assert value(P.integer_text, "2024.0", "abc", "007") == ["2024", "abc", "7"]


def test_text(value):
    assert value(X.blank_to_null, "  ", " a ", "", None) == [None, "a", None, None]
    assert value(X.label_key, "Somme - D_MONTANT_ARTICLE", "é-1") == ["SOMMEDMONTANTARTICLE", "É1"]
    assert value(X.text_lines, "a\r\nb\rc\n", "a\n\n") == [["a", "b", "c"], ["a", ""]]


def test_decode_cp1252(spark):
    raw = bytes(range(256))
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(X.decode_cp1252(F.col("b"))).first()[0] == raw.decode("cp1252", errors="replace")


def test_require_text(spark):
    df = spark.createDataFrame([("0021", 1)], "a string, b int")
    assert X.require_text(df, ["a"]) is df
    with pytest.raises(TypeError):
        X.require_text(df, ["b"])

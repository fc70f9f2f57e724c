from datetime import date
from decimal import Decimal

import pytest

from tillrecon.operators import report

REPORT = "\r\n".join(
    [
        '"MODELE          ","                "', '"MACHINE         ","DESK 9  "', '"RAPPORT         ","TOTALS      "',
        '"FICHIER         ","FILE230"', '"MODE            ","Z   "', '"COMPTEUR Z      ","0388"',
        '"DATE            ","30-11-2022"', '"HEURE           ","20:15"', "",
        '"ENREGISTREMENT  ","DESIGNATION     ","QUANTITE/No     ","MONTANT         "',
        '"0001","CA BRUT     ","12","1,904.50"', '"0002","CA NET      ","3","-17.25"', "",
    ]
)


@pytest.fixture
def parse(spark):
    def run(text):
        df = spark.createDataFrame([("r", text)], "report_id string, text string")
        return report.parse_reports(df).first()

    return run


def test_valid(parse):
    r = parse(REPORT)
    assert (r.model, r.machine, r.report, r.file_code, r.mode, r.counter) == ("", "DESK 9", "TOTALS", "FILE230", "Z", "0388")
    assert (r.report_date, r.report_time, r.errors) == (date(2022, 11, 30), "20:15", [])
    assert [tuple(l) for l in r.lines] == [
        (1, "0001", "CA BRUT", 12, Decimal("1904.50")),
        (2, "0002", "CA NET", 3, Decimal("-17.25")),
    ]


def test_plain_line_ends_and_quotes_in_a_field(parse):
    r = parse(REPORT.replace("\r\n", "\n").replace('"CA NET      "', '"CA ""NET"", X"'))
    assert r.lines[1].designation == 'CA "NET", X' and r.errors == []


BROKEN = [
    ('"HEURE           ","20:15"\r\n', "", "header:short"),
    ('"DESK 9  "', '"DESK 9","x"', "header:MACHINE:words"),
    ('"FICHIER         "', '"FILE"', "header:FICHIER:key"),
    ("30-11-2022", "31-02-2023", "header:DATE:date"),
    ('"DESIGNATION     "', '"LABEL"', "titles"),
    (',"1,904.50"', "", "line:columns"),
    ('"12"', '"x"', "line:quantity"),
    ('"12"', '"1,000"', "line:quantity"),
    ("1,904.50", "19045", "line:amount"),
    ('"-17.25"\r\n', '"-17.25"\r\n\r\n', "line:columns"),
    ("\r\n\r\n", "\r\n", "separator:missing"),
]


def test_rejects(spark):
    texts = [(i, REPORT.replace(old, new)) for i, (old, new, _) in enumerate(BROKEN)]
    df = spark.createDataFrame(texts, "report_id int, text string")
    errors = {r.report_id: r.errors for r in report.parse_reports(df).collect()}
    assert [(b, errors[i]) for i, b in enumerate(BROKEN) if b[2] not in errors[i]] == []


def test_reject_modes(spark):
    df = spark.createDataFrame([("a", REPORT), ("b", REPORT.replace('"12"', '"x"'))], "file_name string, text string")
    parsed = report.parse_reports(df)
    good, bad = report.reject_reports(parsed, "quarantine")
    assert [r.file_name for r in good.collect()] == ["a"] and [r.file_name for r in bad.collect()] == ["b"]
    with pytest.raises(Exception, match="invalid report b line:quantity"):
        report.reject_reports(parsed).collect()

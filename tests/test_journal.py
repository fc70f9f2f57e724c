from datetime import date
from decimal import Decimal

import pytest

from tillrecon.operators import journal

HEAD = "\nREG  17-06-2021 09:08\n81006\n"
FULL = HEAD + (
    "3 TEAPOT T2 €87.60\nHORS TAXE 1 €73.00\nTVA 1 €14.60\nTOTAL €87.60\nCARTES €87.60\n"
    "FACTURE No. A-19\n2-----------------------\nsealed by\ntill seven\n"
)


@pytest.fixture
def parse(spark):
    def run(*blocks):
        df = spark.createDataFrame(list(enumerate(blocks)), "block_id int, block string")
        rows = journal.parse_blocks(df).collect()
        return [r for r in sorted(rows, key=lambda r: r.block_id)]

    return run


def lines_of(row):
    return [(l.line_pos, l.qty, l.label, l.vat_code, l.amount, l.correction) for l in row.lines]


def test_full_ticket(parse):
    (t,) = parse(FULL)
    assert (t.type, t.internal_no, t.ticket_no, t.ticket_date, t.ticket_time) == (
        "REG", "81006", "A-19", date(2021, 6, 17), "09:08",
    )
    assert (t.ht1, t.vat1, t.ttc, t.pay_card) == tuple(map(Decimal, ("73.00", "14.60", "87.60", "87.60")))
    assert t.ht2 is t.vat2 is t.ht_exempt is t.pay_cash is t.pay_cheque is t.event is None
    assert t.signature == "sealed by\ntill seven" and t.errors == []
    assert lines_of(t) == [(1, 3, "TEAPOT", "T2", Decimal("87.60"), None)]


def test_two_equal_lines_without_label(parse):
    (t,) = parse(HEAD + " 1           T1  €41.30\n 1           T1  €41.30\n")
    assert lines_of(t) == [(i, 1, None, "T1", Decimal("41.30"), None) for i in (1, 2)]
    assert t.signature is None and t.errors == []


def test_return_is_negative(parse):
    block = (
        "\r\n_R_F 23-11-2020 18:41\r\n77012\r\n2 BAG\r\n  T1 €20.00\r\n1 BELT T2 €5.00\r\nCORRECTION -10.00\r\n"
        "HORS TAXE 1\r\n€20.83\r\nTOTAL\r\n€25.00\r\nNON TAXABLE\r\n1.00\r\n"
    )
    (t,) = parse(block)
    assert (t.ttc, t.ht1, t.ht_exempt) == tuple(map(Decimal, ("-25.00", "-20.83", "-1.00")))
    assert lines_of(t) == [
        (1, 2, "BAG", "T1", Decimal("-20.00"), None),
        (2, 1, "BELT", "T2", Decimal("-5.00"), None),
        (3, None, None, None, None, Decimal("-10.00")),
    ]
    assert t.errors == []


def test_amount_on_next_line_is_no_article(parse):
    (t,) = parse(HEAD + "TOTAL\n61.00\nCORRECTION\n-1.00\n1 A T1 2.00\n")
    assert t.ttc == Decimal("61.00") and [l.line_pos for l in t.lines] == [1, 2] and t.errors == []


def test_drawer_event_and_last_invoice(parse):
    (t,) = parse(HEAD + "REF./TIROIR .........\nFACTURE No. 1\nFACTURE No. 2\n")
    assert t.event == "REF./TIROIR" and t.ticket_no == "2" and t.lines == [] and t.errors == []


def test_other_types_keep_header_and_signature(parse):
    kinds = ("Z", "XZ", "X")
    body = " 14-09-2022 23:58\n  90210\nTOTAL\n1 anything\n2-----------------------\nabc\n"
    for kind, t in zip(kinds, parse(*(f"\n{k}{body}" for k in kinds))):
        assert (t.type, t.internal_no, t.signature, t.lines, t.ttc, t.errors) == (kind, "90210", "abc", [], None, [])


def test_words_behind_the_amount_are_ignored_on_the_line_only(parse):
    same_line, next_line = parse(HEAD + "TOTAL 3.00 EUR\n", HEAD + "TOTAL\n3.00 EUR\n")
    assert same_line.ttc == Decimal("3.00") and same_line.errors == []
    assert next_line.errors == ["total:amount"]


def test_tax_codes(parse):
    (t,) = parse(HEAD + "".join(f"HORS TAXE {i} {i}.00\nTVA {i} 0.{i}0\n" for i in range(1, 5)))
    assert [t[f"ht{i}"] for i in range(1, 5)] == [Decimal(f"{i}.00") for i in range(1, 5)]
    assert [t[f"vat{i}"] for i in range(1, 5)] == [Decimal(f"0.{i}0") for i in range(1, 5)]


BROKEN = [
    ("", "header:format"),
    ("\nREG 23/11/2020 18:41\n1\n", "header:format"),
    ("\nREG 31-02-2020 18:41\n1\n", "header:date"),
    ("\nREG 02-01-0000 11:25\n1\n", "header:date"),
    ("\nREG 23-11-2020 25:41\n1\n", "header:time"),
    ("\nREG 23-11-2020 18:41", "header:internal_no"),
    ("\nREG 23-11-2020 18:41\n   \nTOTAL 1.00\n", "header:internal_no"),
    (HEAD + "HORS TAXE", "ht:amount"),
    (HEAD + "HORS TAXE 1", "ht:amount"),
    (HEAD + "HORS TAXE\n1", "ht:amount"),
    (HEAD + "HORS TAXE 5 1.00", "ht:code"),
    (HEAD + "HORS TAXE 1 1.00\nHORS TAXE 1 1.00", "ht1:repeated"),
    (HEAD + "TVA 1\n1.00", "vat:amount"),
    (HEAD + "TVA 9 1.00", "vat:code"),
    (HEAD + "TOTAL", "total:amount"),
    (HEAD + "TOTAL\n\n1.00", "total:amount"),
    (HEAD + "TOTAL 1.00\nTOTAL 1.00", "total:repeated"),
    (HEAD + "NON TAXABLE", "exempt:amount"),
    (HEAD + "CORRECTION", "correction:amount"),
    (HEAD + "CARTES", "card:amount"),
    (HEAD + "CARTES 1.00\nCARTES 1.00", "card:repeated"),
    (HEAD + "FACTURE No.", "invoice:number"),
    (HEAD + "REF./TIROIR\nREF./TIROIR ...", "event:repeated"),
    (HEAD + "1 ARTICLE", "article:format"),
    (HEAD + "1 A T1 $3.00", "article:amount"),
    (HEAD + "1 A T1 1 000.00", "article:amount"),
    (HEAD + "99999999999999999999 A T1 1.00", "article:quantity"),
    (HEAD + "²", "article:format"),
    (HEAD + "2-----------------------", "signature:missing"),
    (HEAD + "2-----------------------\na\n2-----------------------\nb", "signature:separator"),
]


def test_rejects(parse):
    found = parse(*(block for block, _ in BROKEN))
    wrong = [(b, e, t.errors) for (b, e), t in zip(BROKEN, found) if e not in t.errors]
    assert wrong == []


def test_doubled_signature_separator_is_tolerated(parse):
    (t,) = parse(HEAD + "2-----------------------\n2-----------------------\nabc\n")
    assert t.signature == "abc" and t.errors == []


def test_split_drops_text_before_the_first_separator(spark):
    text = "lost\n1-----------------------\nA\n1-----------------------\nB"
    df = spark.createDataFrame([("f", text)], "file string, text string")
    rows = journal.journal_blocks(df).collect()
    assert [(r.file, r.block_pos, r.block) for r in rows] == [("f", 0, "\nA\n"), ("f", 1, "\nB")]


def test_reject_modes(spark):
    df = spark.createDataFrame([(1, FULL), (2, HEAD + "TOTAL")], "block_id int, block string")
    parsed = journal.parse_blocks(df)
    good, bad = journal.reject_blocks(parsed, "quarantine")
    assert [r.block_id for r in good.collect()] == [1] and [r.block_id for r in bad.collect()] == [2]
    with pytest.raises(Exception, match="invalid ticket block 2 total:amount"):
        journal.reject_blocks(parsed, "fail", ("block_id",)).collect()
    lines = journal.parse_ticket_lines(good, carry=("internal_no",)).collect()
    assert [(l.block_id, l.internal_no, l.amount) for l in lines] == [(1, "81006", Decimal("87.60"))]


def test_a_filter_does_not_repeat_the_parsing(spark):
    df = spark.createDataFrame([(1, FULL)], "block_id int, block string")
    parsed = journal.parse_blocks(df).filter("type = 'REG' AND size(errors) = 0 AND ttc > 0")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(\d{2}:\d{2})") == 1

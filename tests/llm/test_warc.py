"""Archives: framing, reassembly, damage, revisits."""

import base64
import gzip
import hashlib
import random

import pytest

from tillrecon.llm import warc
from tillrecon.llm.warc import chunked, http_payload, pieces, read_archives, records_of, unchunked, write_archives

SCHEMA = "page_id long, url string, html string, payload string"


def test_framing_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 5, 5000):
        data = "".join(rng.choice("aé漢😀\r\n") for _ in range(n)).encode()
        assert unchunked(chunked(data, 7)) == data
        cut = list(pieces(data, 5))
        assert b"".join(cut) == data and all(len(p) <= 5 and p.decode() is not None for p in cut)
    assert unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    assert http_payload(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"


@pytest.mark.parametrize("body", [b"", b"3\r\nab\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n0\r\n"])
def test_broken_framing(body):
    with pytest.raises(ValueError):
        unchunked(body)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(last.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        to = last.get(html or "")
        revisit = i is not None and to > i
        out.append((i, len((html or "").encode()), sha(html), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_write_and_read(spark, tmp_path):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nend"
    rows = [(i, f"http://a/{i}", f"<p>{'é漢😀x' * (i * i)}</p>") for i in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "u\r\nWARC-Type: x", tricky), (53, "u", tricky), (54, "u", "r\n" * 30_000), (10, "v", rows[20][2]), (20, "w", rows[20][2])]
    rows += [(None, "n", "alone"), (None, "n", rows[20][2]), (55, "m", "alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    write_archives(df, f"{tmp_path}/a", segment_bytes=700)
    out = read_archives(spark, f"{tmp_path}/a")
    got = sorted(((r.page_id, len(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert all(sha(bytes(r.payload).decode()) == r.payload_digest for r in out.collect())
    kinds = [h["warc-type"] for f in tmp_path.glob("a/part-*") for h, _ in records_of(gzip.decompress(f.read_bytes()))]
    assert kinds.count("continuation") > 20 and kinds.count("revisit") == sum(r[3] == "revisit" for r in got)


def test_segments_spread_over_archives(spark, tmp_path, monkeypatch):
    """Archives of three records: most payloads have segments in several of them."""
    monkeypatch.setattr(warc, "FILE_RECORDS", 3)
    rows = [(i, f"u{i}", f"page {i} " * (40 * i)) for i in range(1, 12)]
    write_archives(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(2), f"{tmp_path}/a", segment_bytes=300)
    parsed = spark.read.format("binaryFile").load(f"{tmp_path}/a/part-*").select("content").mapInArrow(warc._parse, warc._PARSED_TYPE)
    assert parsed.where("origin is not null").count() > 20
    out = read_archives(spark, f"{tmp_path}/a").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in out} == {i: t for i, _, t in rows} and len(out) == 11


def damaged(spark, tmp_path, change):
    write_archives(spark.createDataFrame([(1, "u", "abc" * 900, "x")], SCHEMA), f"{tmp_path}/a", segment_bytes=700)
    # Partitions without rows leave archives without records.
    (whole,) = (data for f in tmp_path.glob("a/part-*") if (data := gzip.decompress(f.read_bytes())))
    other = change(whole)
    assert other != whole and whole.count(b"WARC-Type: continuation") > 2
    (tmp_path / "b").mkdir()
    (tmp_path / "b/part-0").write_bytes(other)
    return read_archives(spark, f"{tmp_path}/b")


def without_second(data):
    records = data.split(b"WARC/1.1\r\n")
    return b"WARC/1.1\r\n".join(records[:2] + records[3:])


@pytest.mark.parametrize(
    "change", [without_second, lambda d: d.replace(b"Total-Length: ", b"Total-Length: 9"), lambda d: d.replace(b"abcabc", b"abcabd", 1), lambda d: d[:-30], lambda d: b"junk" + d]
)
def test_damage_fails(spark, tmp_path, change):
    with pytest.raises(Exception, match="segments|bytes instead|digest|cut short|no record"):
        damaged(spark, tmp_path, change).count()


def test_pages_are_reassembled(spark, tmp_path):
    """Most pages of the tables are cut: the query reads more continuation records than responses."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    write_archives(pages, f"{tmp_path}/a")
    heads = [h for f in tmp_path.glob("a/part-*") for h, _ in records_of(gzip.decompress(f.read_bytes()))]
    kinds = [h["warc-type"] for h in heads]
    assert kinds.count("continuation") > kinds.count("response") > 0
    urls = {str(r.page_id): r.url for r in pages.collect()}
    for h in heads:
        if h["warc-type"] == "revisit":
            assert h["warc-refers-to-target-uri"] == urls[h["warc-refers-to-page"]]


def test_empty_table(spark, tmp_path):
    write_archives(spark.createDataFrame([], SCHEMA), f"{tmp_path}/a")
    assert read_archives(spark, f"{tmp_path}/a").count() == 0
    assert warc.digest(b"") == sha("")

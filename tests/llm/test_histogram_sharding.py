"""Shards against what is asked of them: sizes, checksums, bytes near equal, slots, one exchange."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from tillrecon.llm import histogram_sharding as h


def check(rows, out, shards, tolerance=h.TOLERANCE):
    sizes = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == sizes
    held = defaultdict(list)
    for r in out:
        held[r.shard].append(r)
    assert set(held) <= set(range(shards))
    for own in held.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    # Every boundary is near its goal: within the tolerance or half of the row that stands there.
    total, below, most = sum(r.size for r in out), 0, max((r.size for r in out), default=0)
    for s in range(shards - 1):
        below += sum(r.size for r in held[s])
        assert abs(below - total * (s + 1) / shards) <= max(total * tolerance / shards, most / 2) + 1, s
    return held


ROWS = [(i, t) for i, t in enumerate(["", None, "é" * 40, "word " * 900, "a"] * 30)] + [(None, "x"), (None, None), (7, "x" * 10_000)]


@pytest.mark.parametrize("range_rows", [4_000_000, 11])
def test_shards(docs, prose, range_rows):
    rows = ROWS + [(1000 + i, prose(i, 5 + i % 90)) for i in range(400)]
    held = check(rows, h.shard(docs(rows), 5, range_rows=range_rows).collect(), 5)
    # Equal texts stand together: a text lies in one shard, or in neighbours.
    where = defaultdict(set)
    for s, own in held.items():
        for r in own:
            where[r.size, r.text_crc32].add(s)
    assert all(max(s) - min(s) == len(s) - 1 for s in where.values())
    assert sum(len(s) > 1 for s in where.values()) <= 4


def test_one_text_and_one_row_repeated(docs, prose):
    """A group of copies that fills several shards, and equal rows that do."""
    rows = [(i, "the same text") for i in range(3000)] + [(5, "one row")] * 2500 + [(i, prose(i, 3)) for i in range(500)]
    for range_rows in (10_000, 300):
        held = check(rows, h.shard(docs(rows), 24, range_rows=range_rows).collect(), 24)
        assert max(map(len, held.values())) < 400


def test_reruns_agree_and_carry(spark, docs):
    rows = [(i, f"text {i % 17}") for i in range(300)]
    one, two = (sorted(h.shard(docs(rows), 7).collect()) for _ in range(2))
    assert one == two
    df = docs(rows)
    carried = h.shard(df, 7, carry=df["text"]).collect()
    assert all(zlib.crc32(r.carry.encode()) == r.text_crc32 for r in carried)


def test_few_rows_and_none(docs):
    assert h.shard(docs([])).count() == 0
    check([(1, "a")], h.shard(docs([(1, "a")])).collect(), 24)
    check([(1, None), (1, None)], h.shard(docs([(1, None), (1, None)])).collect(), 24)


def test_splitters_settle_within_the_tolerance(spark, docs, prose):
    rows = docs([(i, prose(i, 20)) for i in range(2000)])
    slim = h.stage(h.keyed(rows), "test")
    keys = sorted((r.h1, r.h2, r.seq, r.size) for r in slim.collect())
    total = sum(k[3] for k in keys)
    goals = h._goals("bytes", total, 10, 0.05)
    for goal, s in zip(goals, h.find_splitters(slim, goals), strict=True):
        below = [k for k in keys if k[:3] < s.key]
        assert s.below == (sum(k[3] for k in below), len(below)) and abs(s.below[0] - goal.amount) <= max(goal.miss, 100)


def test_plan(spark):
    """No Python, and one exchange of the rows."""
    out = h.op13_sharding(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    out.collect()
    physical = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange\b", physical)) == 1 and "Window" not in physical
    assert out.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = h.op13_sharding(spark, sf).collect()
    check(rows, out, 24)
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}

"""Sharding by a histogram sort.

Rows are ordered by a key (hash of the text, hash of the id, place in the input), so that equal texts stand together and no
two rows are equal. Shards are ranges of this order with near equal bytes.

1. Every text is read once: its size, checksum and key are written as a slim table.
2. Splitters are found by counting. A round sets probes between the least and the greatest key that a splitter
   can still be, and counts the exact bytes and rows between neighbouring probes across all partitions. A splitter
   settles where a probe comes within the tolerance of its goal; otherwise the next round looks between the two
   probes around the goal. Where one text fills that gap, the hash of the id goes on, and then the place, so
   that a group of copies of any size is divided only as far as the goal needs it. A splitter that can't meet
   the tolerance stands at the row boundary nearest to its goal.
3. Rows are exchanged once, each to the task of its range. Ranges hold a bounded number of rows: splitters by rows cut
   large shards further. Rows before each range were counted exactly, so a row's slot is its place in
   the sorted range and that number; nothing is counted again.

The driver holds the counts between probes of one round, a bounded number whatever the rows. SQL functions only.

Law: ``bytes``. Each boundary is within ``tolerance`` of a shard's size, or within half a row, of its goal.

Defined cases: a null text has no bytes and the checksum of none (0), as has an empty one; a null id is an id like others; equal
rows are divided by their place in the input; a row longer than a shard stays whole, and shards beside it may
be empty; a text's length doesn't matter, since only its size moves. An empty table has no rows. Columns of other names
are ignored, or carried along as one value by ``carry``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import stage

SHARDS, ROW_BYTES = 24, 8
#: Greatest miss of a boundary, as a share of a shard; rows of a range; probes of a round, all splitters together.
TOLERANCE, RANGE_ROWS, PROBES = 0.001, 4_000_000, 1 << 16
#: Keys have 62 bits; the first round's probes cut them by their first 12.
_BITS, _FIRST = 62, 12
_LEVELS = ("h1", "h2", "seq")


@dataclass(frozen=True)
class Goal:
    """What is to lie below a splitter: ``amount`` bytes or rows (``unit``), give or take ``miss``."""

    unit: str
    amount: int
    miss: int


@dataclass(frozen=True)
class Span:
    """Keys from ``low`` to ``high`` of a level, the levels before it fixed; what lies below it."""

    level: int
    fixed: tuple[int, ...]
    low: int
    high: int
    below: tuple[int, int]  # bytes, rows


@dataclass(frozen=True, order=True)
class Splitter:
    """Least key above a boundary, and the bytes and rows below it."""

    key: tuple[int, int, int]
    below: tuple[int, int]


def keyed(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """Slim rows of ``docs`` (doc_id, text): size, checksum and key, and ``carry`` where it is asked for."""
    hashed = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - _BITS)
    own = [carry.alias("carry")] if carry is not None else []
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        hashed("text").alias("h1"), hashed("doc_id").alias("h2"), F.monotonically_increasing_id().alias("seq"), *own,
    )


def _cell(key: Column) -> Column:
    return F.shiftright(key, _BITS - _FIRST)


def _counted(rows: DataFrame, spans: list[Span], probes: int) -> list[list[tuple[int, int, int, int]]]:
    """For each span: (least key, greatest key, bytes, rows) of each gap between probes that has rows, in order."""
    if spans == [ROOT]:
        there = rows.withColumns({"id": F.lit(0), "k": F.col("h1"), "gap": _cell(F.col("h1"))})
    else:
        table = [
            (i, s.level, *(*s.fixed, 0, 0)[:2], s.low, s.high, (s.high - s.low) // probes + 1, (s.fixed or (s.low,))[0] >> (_BITS - _FIRST))
            for i, s in enumerate(spans)
        ]
        looked = rows.sparkSession.createDataFrame(table, "id int, level int, f1 long, f2 long, low long, high long, step long, cell long")
        # One row per splitter that is still open.
        there = rows.join(F.broadcast(looked), _cell(F.col("h1")) == F.col("cell"))
        there = there.where("(level = 0 or h1 = f1) and (level < 2 or h2 = f2)")
        there = there.withColumn("k", F.expr("case level when 0 then h1 when 1 then h2 else seq end")).where("k between low and high")
        there = there.withColumn("gap", F.expr("(k - low) div step"))
    found = there.groupBy("id", "gap").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.sum("size").alias("bytes"), F.count("*").alias("n"))
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in spans]
    for r in found.collect():  # bounded by the probes
        out[r["id"]].append((r["a"], r["b"], r["bytes"], r["n"]))
    return [sorted(x) for x in out]


ROOT = Span(0, (), 0, (1 << _BITS) - 1, (0, 0))


def _settle(goal: Goal, span: Span, gaps: list[tuple[int, int, int, int]]) -> Splitter | Span:
    """Where the goal's boundary is, or the keys to look among next."""
    unit = ("bytes", "rows").index(goal.unit)
    below = span.below
    for a, b, size, n in gaps:
        above = (below[0] + size, below[1] + n)
        if above[unit] > goal.amount or (a, b) == gaps[-1][:2]:
            short, over = goal.amount - below[unit], above[unit] - goal.amount
            at = lambda k: (*span.fixed, k, 0, 0)[:3]
            if min(short, over) <= goal.miss or a == b and span.level == 2:
                return Splitter(at(a), below) if short <= over else Splitter(at(b + 1), above)
            if a < b:
                return replace(span, low=a, high=b, below=below)
            return Span(span.level + 1, (*span.fixed, a), 0, (1 << _BITS) - 1, below)
        below = above
    raise ValueError("a goal beyond all rows")


def find_splitters(rows: DataFrame, goals: list[Goal]) -> list[Splitter]:
    """A splitter for each goal; ``rows`` are slim rows that do not change between the rounds."""
    where: list[Splitter | Span] = [ROOT] * len(goals)
    while open_spans := list(dict.fromkeys(s for s in where if isinstance(s, Span))):
        gaps = dict(zip(open_spans, _counted(rows, open_spans, max(16, PROBES // len(open_spans))), strict=True))
        where = [_settle(g, s, gaps[s]) if isinstance(s, Span) else s for g, s in zip(goals, where, strict=True)]
    return where


def _goals(unit: str, total: int, n: int, tolerance: float) -> list[Goal]:
    return [Goal(unit, total * t // n, int(total * tolerance / n)) for t in range(1, n)]


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS, carry: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (and carry) of every row of ``docs`` (doc_id, text)."""
    rows = stage(keyed(docs, carry), "keys")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    cuts: dict[tuple[int, int, int], tuple[tuple[int, int], int]] = {}  # key -> what is below it, shards that begin there
    if total["n"]:
        goals = _goals("bytes", total["bytes"], shards, tolerance)
        found = find_splitters(rows, goals + _goals("rows", total["n"], -(-total["n"] // range_rows), 0.1))
        for i, s in enumerate(found):
            below, begins = cuts.get(s.key, (s.below, 0))
            cuts[s.key] = (below, begins + (i < len(goals)))
    # Ranges in order: their least key, shard, and rows of the shard before them.
    ranges, first, now = [((0, 0, 0), 0, 0)], 0, 0
    for key, ((_, n), begins) in sorted(cuts.items()):
        if begins:
            first, now = n, now + begins
        ranges.append((key, now, n - first))
    # Per first bits of a key the ranges that it can be in: the last one that begins before, and those within.
    cells: list[tuple[int, list]] = []
    at = 0
    for cell in range(1 << _FIRST):
        end = at
        while end + 1 < len(ranges) and ranges[end + 1][0][0] >> (_BITS - _FIRST) <= cell:
            end += 1
        cells.append((cell, [(*ranges[i][0], i, *ranges[i][1:]) for i in range(at, end + 1)]))
        at = end
    looked = rows.sparkSession.createDataFrame(cells, "cell long, ranges array<struct<h1:long,h2:long,seq:long,id:int,shard:int,before:long>>")
    # As many rows as first bits have values, as many entries in addition as there are ranges.
    placed = rows.join(F.broadcast(looked), _cell(F.col("h1")) == F.col("cell"))
    mine = F.filter("ranges", lambda r: F.struct(r["h1"], r["h2"], r["seq"]) <= F.struct("h1", "h2", "seq"))
    placed = placed.withColumn("mine", F.element_at(mine, -1)).select(*rows.columns, "mine.id", "mine.shard", "mine.before")
    ordered = placed.repartitionById(len(ranges), "id").sortWithinPartitions(*_LEVELS)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return ordered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + place).alias("slot"), *(["carry"] if carry is not None else []))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

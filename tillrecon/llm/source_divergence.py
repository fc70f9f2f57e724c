"""Source divergence audit with a dominance skyband.

How far do the sources of a language differ from one another, and which terms set a source apart?

1. Counting: each task sums occurrences and documents per (lang, source, term) before anything is moved; a
   term's counts then meet by (lang, term). Terms in fewer than ``min_docs`` documents of the language go.
2. Pairs of sources: blocks of ``BLOCK`` terms of a language become a matrix of smoothed shares, term by
   source. A block gives one sum per pair of sources; its size does not depend on the number of documents.
3. Terms of a source: a term's value rises with its count in the source and falls with its count in the
   language, and ties go to the earlier term. So a term that ``ranks`` others beat or equal in all three
   (count in the source, count in the language, UTF-8) can't be among the first ``ranks``. Partitions keep
   terms dominated by fewer, skybands of a group are merged in two steps, and what is left is ranked by
   its exact value.

All arithmetic is on integers: shares are floor(10^9 * (count + 2) / (N + 2 * V)) + 1.

Defined cases: null text, lang and source are empty strings; every (lang, source) that occurs is a group, also without
a text or a kept term (its counts are 0); a language without kept terms has pairs of value 0 and no terms; rows are
documents of their own, whatever their ids, so equal rows count as often as they occur; equal values rank by
UTF-8; a text of any length is read in steps of ``STEP`` bytes. An empty table has no groups. Only the named columns are read,
so that others may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillrecon.llm.common import batch_of, rows_of, stage

SCALE, PRIOR = 1_000_000_000, 2
#: Bytes of a text split at once; distinct terms a task counts before it hands them on; terms of a matrix;
#: terms looked at together by a skyband; lanes that merge skybands of a group.
STEP, HELD, BLOCK, BAND_STEP, LANES = 1 << 20, 300_000, 512, 4096, 16

#: A-Z become a-z; whatever cannot stand in a term becomes a space. Bytes above 0x7F belong to other letters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Terms of a text in order, in lists of bounded size."""
    data = text.encode()
    at = 0
    while at < len(data):
        part = data[at : at + STEP].translate(_LETTERS)
        if at + STEP < len(data):
            # A term that goes on is left to the next step.
            cut = part.rfind(b" ") + 1
            while not cut:
                more = data[at + len(part) : at + len(part) + STEP].translate(_LETTERS)
                part += more
                cut = len(part) if not more else part.rfind(b" ") + 1
            part = part[:cut]
        at += len(part)
        yield part.split()


_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) -> occurrences and documents of each term, summed within the task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                some = terms[at : at + 50_000]
                yield batch_of(_COUNTED, [[lang] * len(some), [source] * len(some), pa.array(some, pa.binary()).cast(pa.string()), [n[t] for t in some], [d[t] for t in some]])
        held.clear()

    for batch in batches:
        for lang, source, text in rows_of(batch):
            n, d = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in terms_of(text):
                n.update(terms)
                seen.update(terms)
            d.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from handed()
    yield from handed()


def kept_terms(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """lang, term, total (occurrences in the language), per (array of (source, n)) of the terms that stay."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = docs.where("text <> ''").select(text("lang"), text("source"), text("text"))
    counted = counted.mapInArrow(_count, "lang string, source string, term string, n long, d long")
    # One exchange serves both sums.
    sums = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    per = F.sort_array(F.collect_list(F.struct("source", "n")))  # at most one entry per source
    terms = sums.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("d"), per.alias("per"))
    return terms.where(F.col("d") >= min_docs).drop("d")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n (occurrences of kept terms), v and total of the language; one row per group of ``docs``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(text("lang"), text("source")).distinct()
    found = kept.select("lang", F.inline("per")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return groups.join(found, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("n"), zero("v"), zero("total"))


# ---------------------------------------------------------------- pairs of sources


def _shares(counts: np.ndarray, totals: list[int], v: int) -> np.ndarray:
    """Shares of counts (term by source); beyond 64 bits they are Python's integers."""
    below = np.array([n + PRIOR * v for n in totals], dtype=object)
    if int(counts.max(initial=0)) + PRIOR < 2**63 // SCALE and max(below) < 2**62:
        below = below.astype(np.int64)
    else:
        counts = counts.astype(object)
    return 1 + (SCALE * (counts + PRIOR)) // below


def _compare_sources(batches):
    """Rows (lang, v, sources, terms) of one block each -> per pair of sources the sum of the block."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    for batch in batches:
        for lang, v, sources, terms in rows_of(batch):
            place = {s["source"]: i for i, s in enumerate(sources)}
            counts = np.zeros((len(terms), len(place)), np.int64)
            for row, term in zip(counts, terms, strict=True):
                for x in term:
                    row[place[x["source"]]] = x["n"]
            p = np.ascontiguousarray(_shares(counts, [s["n"] for s in sources], v).T)
            names = [s["source"] for s in sources]
            for i in range(len(names) - 1):
                gap = p[i + 1 :] - p[i]
                value = ((gap * gap) // (p[i + 1 :] + p[i])).sum(axis=1)
                yield batch_of(schema, [[lang] * len(value), [names[i]] * len(value), names[i + 1 :], value.tolist()])


def source_pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (another source), value (squared differences of shares over their sum, all kept terms)."""
    sources = F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources")  # the result has a row for each pair of them
    langs = totals.groupBy("lang", "v").agg(sources)
    size = totals.groupBy("lang").agg(F.max(F.floor(F.col("v") / BLOCK) + 1).alias("blocks"))
    blocks = kept.join(size, "lang").groupBy("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block")).agg(F.collect_list("per").alias("terms"))
    given = blocks.join(langs, "lang").select("lang", "v", "sources", "terms")
    sums = given.mapInArrow(_compare_sources, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pair = lambda source, item: F.struct(F.col(source).alias("source"), F.col(item).alias("item"))
    both = sums.select("lang", F.inline(F.array(pair("a", "b"), pair("b", "a"))), "value")
    # Pairs of a language without kept terms have no block.
    every = totals.select("lang", "source", "v").join(totals.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    none = every.where("v = 0").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    return both.unionByName(none)


# ---------------------------------------------------------------- terms of a source


def skyband(n: np.ndarray, total: np.ndarray, term: list[str], k: int) -> np.ndarray:
    """Places of what fewer than ``k`` others dominate: at least the count, at most the total, an earlier term.

    Dominators come first in the order looked at, and the first ``k`` of them are in the band themselves, so
    everything is held against the band only.
    """
    rank = np.empty(len(term), np.int64)
    rank[np.argsort(np.array([t.encode() for t in term], dtype=object), kind="stable")] = np.arange(len(term))
    order = np.lexsort((rank, total, -n))
    total, rank, kept = total[order], rank[order], np.zeros(len(order), bool)
    band_total, band_rank = total[:0], rank[:0]
    for start in range(0, len(order), 256):
        t, r = total[start : start + 256, None], rank[start : start + 256, None]
        beaten = ((band_total <= t) & (band_rank < r)).sum(axis=1)
        within = (t.T <= t) & (r.T < r) & np.tri(len(t), k=-1, dtype=bool)
        new = beaten + within.sum(axis=1) < k
        kept[start : start + 256] = new
        band_total, band_rank = np.concatenate((band_total, t[new, 0])), np.concatenate((band_rank, r[new, 0]))
    return order[kept]


_CANDIDATES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("total", pa.int64())])


def _bands(k: int):
    """Rows (lang, source, term, n, total), groups one after another -> the skyband of each group."""

    def band(key, n, total, term) -> tuple[np.ndarray, np.ndarray, list[str]]:
        at = skyband(n, total, term, k)
        return n[at], total[at], [term[i] for i in at]

    def run(batches):
        key, held = None, (np.zeros(0, np.int64), np.zeros(0, np.int64), [])

        def handed():
            if held[2]:
                yield batch_of(_CANDIDATES, [[key[0]] * len(held[2]), [key[1]] * len(held[2]), held[2], held[0], held[1]])

        for batch in batches:
            for start in range(0, batch.num_rows, BAND_STEP):
                part = batch.slice(start, BAND_STEP)
                langs, sources, terms = (part.column(i).to_pylist() for i in range(3))
                n, total = (part.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                a = 0
                while a < len(terms):
                    b = a
                    while b < len(terms) and (langs[b], sources[b]) == (langs[a], sources[a]):
                        b += 1
                    if (langs[a], sources[a]) != key:
                        yield from handed()
                        key, held = (langs[a], sources[a]), (np.zeros(0, np.int64), np.zeros(0, np.int64), [])
                    held = band(key, np.concatenate((held[0], n[a:b])), np.concatenate((held[1], total[a:b])), held[2] + terms[a:b])
                    a = b
        yield from handed()

    return run


def source_terms(kept: DataFrame, totals: DataFrame, ranks: int = 10) -> DataFrame:
    """lang, source, item (a term more frequent in the source than in the language), value, of the first ``ranks``."""
    columns = ("lang", "source", "term", "n", "total")
    bands = kept.select("lang", F.inline("per"), "term", "total").select(*columns).sortWithinPartitions("lang", "source")
    for lanes in (LANES, 1):
        bands = bands.mapInArrow(_bands(ranks), "lang string, source string, term string, n long, total long")
        if lanes > 1:
            bands = bands.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(lanes))).repartition("lang", "source", "lane").sortWithinPartitions("lang", "source").select(*columns)
    big = lambda c: F.col(c).cast("decimal(20,0)")
    share = lambda n, of: F.expr(f"1 + ({SCALE}BD * ({n} + {PRIOR}BD)) div ({of} + {PRIOR}BD * v)")
    found = bands.join(totals.select("lang", "source", big("n").alias("of"), big("total").alias("all"), big("v").alias("v")), ["lang", "source"])
    found = found.withColumns({"n": big("n"), "total": big("total")}).withColumns({"p": share("n", "of"), "q": share("total", "all")}).where("p > q")
    found = found.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return found


def audit(docs: DataFrame, min_docs: int = 10, ranks: int = 10) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank of ``docs`` (text, lang, source)."""
    kept = stage(kept_terms(docs, min_docs), "terms")
    totals = stage(group_totals(docs, kept), "totals")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(kept, totals).withColumn("rank", F.row_number().over(order))
    terms = source_terms(kept, totals, ranks).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
    return part(pairs, "pair").unionByName(part(terms, "term"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), occurrences AS (
  SELECT row, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM occurrences GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS n, max(v) AS v, max(langs.total) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) LEFT JOIN langs ON langs.lang = g.lang
  GROUP BY g.lang, g.source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.n + 2 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (s.total + 2 * s.v) AS q
  FROM sizes s JOIN kept k ON k.lang = s.lang LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value,
    row_number() OVER (PARTITION BY lang, source ORDER BY coalesce(value, 0) DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

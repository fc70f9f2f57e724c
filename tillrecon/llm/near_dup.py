"""MinHash near-duplicates with sequential Bayesian verification.

Documents become sets of word shingles. Equal sets collapse first: only the smallest id of each class
goes on. Signatures of the classes are banded; each member of a bucket is compared with one centre
first, and members that are still in different components afterwards with each other, bucket by bucket.
Signatures of a candidate pair are compared in batches; after each batch a pair is pruned if the posterior
probability of a similarity at or above the threshold (uniform prior) is below ``miss``. What survives is
confirmed on the full sets. Components of the confirmed links give one kept document each.

Large centres and buckets are split: a task holds one centre, or one part (``APART_ROWS``) of the members of a bucket
outside its first component, while others stream past, by salts. Parts meet each other in tasks of their own. Only
what joins two components is emitted.

Defined cases: a null or empty text has an empty set and is linked with nothing; a text with fewer words
than a shingle is one shingle as a whole; rows with the same id are one node; a row without an id is
linked with nothing, has a null component and is kept. The smallest id names a component, so ties cannot occur;
a text of any length is shingled whole; an empty table has no rows. Columns other than the id and the text are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import (
    Buffer,
    components,
    mix,
    rolling,
    rows_of,
    signed,
    span_hashes,
    stage,
    unstage,
    words_of,
)

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

SET_SCHEMA = "doc_id long, n long, s1 long, s2 long, sig binary, keys array<long>"


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the text's word shingles, ascending."""
    raw = np.frombuffer((text or "").encode().translate(_LOWER), np.uint8)
    hashes = span_hashes(raw, *words_of(raw))
    if not len(hashes):
        return hashes
    return np.unique(rolling(hashes, min(words, len(hashes))))


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(77).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(values: np.ndarray, multipliers: np.ndarray, block: int = 2048) -> np.ndarray:
    best = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), block):
        np.minimum(best, np.multiply.outer(values[i : i + block], multipliers).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` hashes."""
    values = values[: len(values) // rows * rows].reshape(-1, rows).astype(np.uint64)
    keys = np.arange(len(values), dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        keys = mix(keys * np.uint64(0x2545F4914F6CDD1D) + values[:, i])
    return keys


def _sets(shingle_words: int, n_hashes: int, band_rows: int):
    """Sets as sizes and sums; of each signature the band keys, and a byte of each hash for the screen."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sig", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(n_hashes)
        out = Buffer(schema, 4_000)
        for batch in batches:
            for doc_id, text in rows_of(batch):
                have = shingles(text, shingle_words)
                if len(have):
                    # Two independent sums over the set: equal sets, and only they, share both.
                    sums = np.array([mix(have).sum(), mix(have ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).view(np.int64)
                    values = signature(have, multipliers)
                    out.add(doc_id, len(have), int(sums[0]), int(sums[1]), values.astype(np.uint8).tobytes(), signed(band_keys(values, band_rows)))
                else:
                    out.add(doc_id, 0, 0, 0, None, None)
                if out.full():
                    yield out.take()
        yield out.take()

    return run


def prune_bounds(n_hashes: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on): below it, P(similarity >= threshold) < miss.

    With a uniform prior the posterior is a Beta; its upper tail at the threshold is the probability that
    a binomial of one more trial stays at or below the matches.
    """
    bounds = []
    for n in [*range(batch, n_hashes, batch), n_hashes]:
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        bounds.append((n, m))
    return bounds


def _screened(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two arrays of signatures that survive every batch."""
    alive, same, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, fewest in bounds:
        same = same + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        keep = same >= fewest
        alive, same, done = alive[keep], same[keep], n
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two ascending sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    n = int((both[1:] == both[:-1]).sum())
    return n > 0 and 100 * n >= percent * (len(a) + len(b) - n)


def _sig(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _with_centre(bounds: list[tuple[int, int]], shingle_words: int, percent: int):
    """Rows come by centre and salt, the centre itself first: links of members with their centre."""

    def run(batches):
        out, key = Buffer(_LINK), None
        for batch in batches:
            for c, salt, kind, doc_id, sig, text in rows_of(batch):
                if (c, salt) != key:
                    key, centre, centre_sig = (c, salt), None, None
                if not kind:
                    centre, centre_sig = shingles(text, shingle_words), _sig(sig)[None, :]
                elif centre is not None and len(_screened(centre_sig, _sig(sig)[None, :], bounds)):
                    if linked(centre, shingles(text, shingle_words), percent):
                        out.add(c, doc_id)
                if out.full():
                    yield out.take()
        yield out.take()

    return run


class _Bucket:
    """Members of one bucket outside its first component, and what they are found to be linked with."""

    def __init__(self, bounds, shingle_words: int, percent: int):
        self.bounds, self.words, self.percent = bounds, shingle_words, percent
        self.ids, self.comps, self.sigs, self.texts, self.sets, self.root = [], [], [], [], {}, {}
        self.matrix = None

    def hold(self, doc_id: int, comp: int, sig: bytes, text: str) -> None:
        self.ids.append(doc_id)
        self.comps.append(comp)
        self.sigs.append(_sig(sig))
        self.texts.append(text)

    def _set(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = shingles(self.texts[i], self.words)
        return self.sets[i]

    def _find(self, comp: int) -> int:
        while (up := self.root.get(comp, comp)) != comp:
            comp = up
        return comp

    def _merge(self, a: int, b: int) -> None:
        self.root[max(a, b)] = min(a, b)

    def meet(self, doc_id: int, comp: int, sig: np.ndarray, text: str | None, own: np.ndarray | None, before: int | None = None):
        """Links of a document with the held ones that are not yet in its component."""
        if self.matrix is None:
            self.matrix = np.stack(self.sigs) if self.sigs else np.zeros((0, 1), np.uint8)
        some = np.arange(len(self.ids) if before is None else before)
        some = some[[self._find(self.comps[i]) != self._find(comp) for i in some.tolist()]] if len(some) else some
        for i in some[_screened(self.matrix[some], np.broadcast_to(sig, (len(some), len(sig))), self.bounds)].tolist() if len(some) else ():
            mine, theirs = self._find(comp), self._find(self.comps[i])
            if mine == theirs:
                continue
            if own is None:
                own = shingles(text, self.words)
            if linked(own, self._set(i), self.percent):
                self._merge(mine, theirs)
                yield min(doc_id, self.ids[i]), max(doc_id, self.ids[i])

    def among(self):
        for j in range(1, len(self.ids)):
            yield from self.meet(self.ids[j], self.comps[j], self.sigs[j], self.texts[j], self.sets.get(j), j)


def _within(bounds: list[tuple[int, int]], shingle_words: int, percent: int):
    """Rows come by bucket, part and salt: members of one part of those outside the first component, then what they meet."""

    def run(batches):
        out, key, bucket, done = Buffer(_LINK), None, None, True

        def close():
            nonlocal done
            if not done and key[2] == 0:
                for link in bucket.among():
                    out.add(*link)
            done = True

        for batch in batches:
            for k, part, salt, kind, doc_id, comp, sig, text in rows_of(batch):
                if (k, part, salt) != key:
                    if key is not None:
                        close()
                    key, bucket, done = (k, part, salt), _Bucket(bounds, shingle_words, percent), False
                if not kind:
                    bucket.hold(doc_id, comp, sig, text)
                else:
                    close()
                    for link in bucket.meet(doc_id, comp, _sig(sig), text, None):
                        out.add(*link)
                if out.full():
                    yield out.take()
        if key is not None:
            close()
        yield out.take()

    return run


#: Members of a centre that one task takes; members of a bucket outside its first component that one task holds, and
#: members that it lets these meet.
CENTRE_ROWS, APART_ROWS, SALT_ROWS = 256, 1024, 2048


def _salts(n, rows):
    return (F.floor((n - 1) / rows) + 1).cast("int")


def _salt(doc_id, salts, seed: int = 0):
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), salts).cast("int")


def _copies(n):
    return F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    n_hashes: int = 192,
    band_rows: int = 6,
    batch: int = 32,
    miss: float = 1e-4,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of ``docs`` (doc_id, text).

    ``percent`` is the similarity of a link in hundredths, ``miss`` the probability with which pruning may
    lose a link. A pair of that similarity shares one of the bands with probability
    1 - (1 - s^band_rows)^(n_hashes // band_rows): 0.99994 by default.
    """
    bounds = prune_bounds(n_hashes, batch, percent / 100, miss)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed_sets = stage(texts.mapInArrow(_sets(shingle_words, n_hashes, band_rows), SET_SCHEMA), "signatures")

    # Classes of equal sets; the smallest id stands for its class.
    full = signed_sets.where("n > 0 and doc_id is not null")
    reps = stage(full.groupBy("n", "s1", "s2").agg(F.min(F.struct("doc_id", "sig", "keys")).alias("m")).select("n", "s1", "s2", "m.*"), "reps")
    sets = stage(signed_sets.select("doc_id", "n", "s1", "s2"), "sets")
    unstage(signed_sets)

    keys = reps.select("doc_id", F.explode("keys").alias("key"))
    centres = keys.groupBy("key").agg(F.count("*").alias("m"), F.min("doc_id").alias("c")).where("m > 1")
    buckets = stage(keys.join(centres, "key"), "buckets")

    # First each member with the smallest centre of its buckets: one candidate a member, whatever the size of the bucket.
    chosen = buckets.groupBy("doc_id").agg(F.min("c").alias("c"))
    needed = reps.select("doc_id", "sig").groupBy("doc_id").agg(F.min("sig").alias("sig")).join(chosen, "doc_id")
    needed = stage(needed.join(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "doc_id"), "needed")
    sizes = needed.groupBy("c").agg(F.count("*").alias("m"))
    heads = needed.drop("c").join(sizes.withColumnRenamed("c", "doc_id"), "doc_id")
    heads = heads.select(F.col("doc_id").alias("c"), _copies(_salts(F.col("m"), CENTRE_ROWS)).alias("salt"), F.lit(0).alias("kind"), "doc_id", "sig", "text")
    rows = needed.where("doc_id <> c").join(sizes, "c").select("c", _salt("doc_id", _salts(F.col("m"), CENTRE_ROWS)).alias("salt"), F.lit(1).alias("kind"), "doc_id", "sig", "text")
    rows = heads.union(rows).repartition("c", "salt").sortWithinPartitions("c", "salt", "kind")
    links = stage(rows.mapInArrow(_with_centre(bounds, shingle_words, percent), "a long, b long"), "links")
    found = stage(components(links), "found")

    # Then, in buckets whose members are not all in one component, across components. A bucket of two whose
    # larger member has been with the smaller one is done; of buckets with the same members one will do.
    labelled = _labelled(buckets.select("key", "doc_id", "m", F.col("c").alias("first")), found, "doc_id", "comp")
    labelled = labelled.join(chosen, "doc_id").withColumn("h", F.xxhash64("doc_id").cast("decimal(38,0)"))
    tested = (F.col("m") == 2) & (F.col("partner") == F.col("first"))
    state = labelled.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.first("m").alias("m"), F.first("first").alias("first"),
        F.sum("h").alias("h"), F.max(F.when(F.col("doc_id") != F.col("first"), F.col("c"))).alias("partner"),
    )
    state = state.where("lo < hi").where(~tested).groupBy("m", "h").agg(F.min(F.struct("key", "lo")).alias("s")).select("s.key", "s.lo")
    # Members outside the first component are dealt into parts. A part meets the first component and the parts
    # after it, each in as many tasks as these have salts; so no task holds more than a part, however large a bucket is.
    members = stage(labelled.select("key", "doc_id", "m", "comp").join(state, "key"), "open")
    parts = members.groupBy("key").agg(_salts(F.count_if(F.col("comp") != F.col("lo")), APART_ROWS).alias("parts"))
    members = members.join(parts, "key").join(needed.select("doc_id", "sig", "text"), "doc_id")
    members = members.withColumns({"salts": _salts(F.col("m"), SALT_ROWS), "own": _salt("doc_id", F.col("parts"), 1)})
    tail = ["doc_id", "comp", "sig", "text"]
    outside = members.where("comp <> lo")
    held = outside.select("key", F.col("own").alias("part"), _copies(F.col("salts")).alias("salt"), F.lit(0).alias("kind"), *tail)
    meets = F.when(F.col("comp") == F.col("lo"), F.col("parts")).otherwise(F.col("own"))
    met = members.select("key", _copies(meets).alias("part"), _salt("doc_id", F.col("salts")).alias("salt"), F.lit(1).alias("kind"), *tail)
    rows = held.union(met).repartition("key", "part", "salt").sortWithinPartitions("key", "part", "salt", "kind", "doc_id")
    more = stage(rows.mapInArrow(_within(bounds, shingle_words, percent), "a long, b long"), "links")
    unstage(needed, buckets)
    if more.limit(1).count():
        found = components(links.union(more))

    classes = reps.select("n", "s1", "s2", F.col("doc_id").alias("rep"))
    least = _labelled(classes, found, "rep", "component_id").select("n", "s1", "s2", "component_id")
    out = sets.join(least, ["n", "s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _labelled(df: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the component of ``node``; a node without links is its own."""
    return df.join(found.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates (five-word shingles) the document with the smallest id.

    Rows without an id stay; of rows with the same id and text, one does.
    """
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("fp"), whole)
    left = rows.join(gone, F.col("id") == F.col("_gone"), "left_anti")
    once = left.where("id is not null").dropDuplicates(["id", "fp"])
    return once.union(left.where("id is null")).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=2)


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM words
), classes AS (
  SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), flat AS (
  SELECT rep, n, unnest(s) AS g FROM classes
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM flat a JOIN flat b ON a.g = b.g AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rep AS node, rep AS comp FROM classes
  UNION
  SELECT e.b, r.comp FROM reach r JOIN both_ways e ON e.a = r.node
), comp AS (
  SELECT node, min(comp) AS comp FROM reach GROUP BY node
)
SELECT x.doc_id, CAST(len(x.s) AS BIGINT) AS n_shingles, coalesce(m.comp, x.doc_id) AS component_id,
  x.doc_id = coalesce(m.comp, x.doc_id) AS kept
FROM sets x LEFT JOIN classes c ON len(x.s) > 0 AND c.s = x.s LEFT JOIN comp m ON m.node = c.rep
"""

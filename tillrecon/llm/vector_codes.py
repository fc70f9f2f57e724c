"""Vector code compression with an integer Walsh-Hadamard transform.

Vectors become integers floor(256 * x) and are cut into equal parts; each part position has a codebook, and a vector's
code names the nearest entry of each part. Codebooks begin as parts of the vectors with the smallest ids and
move to the floored means of what is assigned to them.

The nearest entry is found exactly and without floating point:

1. Parts and entries, padded with zeros to a power of two ``m``, go through the Walsh-Hadamard transform,
   which is made of sums and differences: squared distances between transforms are m times those of the parts.
2. Squared differences are added up in sequency order, smooth components first, where most of the difference
   usually lies. Sums only grow, so an entry whose sum exceeds a distance already reached is out.
3. What remains after a few components is followed entry by entry, and again thinned after each of them. Of
   equal distances the smallest index wins.

Vectors stay where they are: a round sends each task's sums per entry and component, and the codebooks (64
entries, whatever the number of vectors) come back with the next round.

Defined cases: a vector that is null or holds null or a component that is not finite has no row; a null id comes after all others,
and equal ids are ordered by their vectors, so that rows in any order give the same codebooks; equal vectors have equal
codes; fewer than 64 vectors make as many entries; components beyond 2^20 are computed with Python's integers, and a distance
that 64 bits can't hold fails; vectors of different lengths, or of a length that the parts do not divide, are an
error. An empty table has no rows and empty codebooks. Only the named columns are read, so that others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import batch_of, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors looked at together; beyond this size of a component 64 bits might not hold a sum of squares.
STEP, SMALL = 2048, 1 << 20


def sequency(m: int) -> np.ndarray:
    """Walsh-Hadamard matrix (m a power of two), rows in order of their sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < m:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Transforms of integer parts, one per row."""
    d = parts.shape[1]
    m = 1 << max(0, d - 1).bit_length()
    return parts @ sequency(m)[:, :d].T.astype(parts.dtype)


def nearest(parts: np.ndarray, entries: np.ndarray, whole: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each part; ``whole`` components are added up for all entries."""
    x, c = transformed(parts), transformed(entries)
    m = x.shape[1]
    sums = np.zeros((len(x), len(c)), x.dtype)
    for k in range(min(whole, m)):
        gap = x[:, k, None] - c[None, :, k]
        sums += gap * gap
    # The entry that is ahead so far gives the bound.
    ahead = sums.argmin(axis=1)
    rest = x[:, whole:] - c[ahead, whole:]
    bound = sums[np.arange(len(x)), ahead] + (rest * rest).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    reached = sums[row, entry]
    for k in range(whole, m):
        gap = x[row, k] - c[entry, k]
        reached = reached + gap * gap
        stay = reached <= bound[row]
        row, entry, reached = row[stay], entry[stay], reached[stay]
    # Rows are in order, entries in order within them; the least distance and its smallest index win.
    best = np.minimum.reduceat(reached, np.searchsorted(row, np.arange(len(x)))) if len(x) else reached
    won = np.flatnonzero(reached == best[row])
    _, first = np.unique(row[won], return_index=True)
    return entry[won[first]], best // m


def integers(values: np.ndarray, dim: int) -> np.ndarray:
    """floor(256 * x) of finite numbers, in rows of ``dim``."""
    scaled = np.floor(values.astype(np.float64) * SCALE)  # a power of two: exact
    if np.abs(scaled).max(initial=0) <= SMALL:
        return scaled.astype(np.int64).reshape(-1, dim)
    return np.array([int(v) for v in scaled], dtype=object).reshape(-1, dim)


def vectors_of(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    for start in range(0, len(column), STEP):
        part = column.slice(start, STEP)
        yield integers(part.flatten().to_numpy(zero_copy_only=False), dim)


def _array(books: list[list[list[int]]]) -> list[np.ndarray]:
    """Codebooks as 64-bit numbers where these are enough."""
    most = max((abs(v) for b in books for e in b for v in e), default=0)
    return [np.array(b, dtype=np.int64 if most <= SMALL else object) for b in books]


def _common(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = object if object in (x.dtype, c.dtype) else np.int64
    return x.astype(kind), c.astype(kind)


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])


def _sum_entries(books: list[list[list[int]]], dim: int):
    """Rows (vector) -> per part, entry and component the sum over what is assigned to the entry."""

    def run(batches):
        held, width = _array(books), dim // len(books)
        sums = np.zeros((len(held), len(held[0]), width), object)
        counts = np.zeros((len(held), len(held[0])), np.int64)
        for batch in batches:
            for v in vectors_of(batch.column(0), dim):
                for p, book in enumerate(held):
                    x, c = _common(v[:, p * width : (p + 1) * width], book)
                    entry, _ = nearest(x, c)
                    counts[p] += np.bincount(entry, minlength=len(c))
                    new = np.zeros((len(c), width), x.dtype)
                    np.add.at(new, entry, x)
                    sums[p] += new
        p, e, a = (i.ravel() for i in np.indices(sums.shape))
        some = counts[p, e] > 0
        p, e, a = p[some], e[some], a[some]
        yield batch_of(_SUMS, [p, e, a, [Decimal(int(s)) for s in sums[p, e, a]], counts[p, e]])

    return run


def _encode(books: list[list[list[int]]], dim: int):
    def run(batches):
        held, width = _array(books), dim // len(books)
        for batch in batches:
            codes, errors = [], []
            for v in vectors_of(batch.column(batch.num_columns - 1), dim):
                found = [nearest(*_common(v[:, p * width : (p + 1) * width], book)) for p, book in enumerate(held)]
                codes += [bytes(row).hex() for row in np.stack([i for i, _ in found], axis=1).astype(np.uint8)]
                errors += [int(e) for e in sum(d.astype(object) for _, d in found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=[f"c{i}" for i in range(batch.num_columns + 1)])

    return run


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is whole, with it as ``vector`` (doubles); other columns are left to the caller."""
    values = F.col(vector).cast("array<double>")
    fine = values.isNotNull() & F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return df.where(fine).withColumn(vector, values)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[list[list[int]]], int]:
    """(codebooks by part, entry and component; length of a vector) for whole ``vectors`` (vec_id, vector)."""
    if entries > 256:
        raise ValueError("a code has one byte per part")
    lengths = [r["n"] for r in vectors.select(F.size("vector").alias("n")).distinct().limit(2).collect()]
    if len(lengths) > 1 or any(n % parts or not n for n in lengths):
        raise ValueError(f"vectors must have one length that {parts} parts divide, not {lengths}")
    if not lengths:
        return [[] for _ in range(parts)], 0
    dim = lengths[0]
    width = dim // parts
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    start = [integers(np.array(r["vector"]), dim)[0].tolist() for r in first]
    books = [[v[p * width : (p + 1) * width] for v in start] for p in range(parts)]
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(_sum_entries(books, dim), "part int, entry int, at int, total decimal(38,0), n long")
        # One row per part, entry and component, whatever the number of vectors.
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[r["part"]][r["entry"]][r["at"]] = int(r["total"]) // r["n"]
    return books, dim


def encode(vectors: DataFrame, books: list[list[list[int]]], dim: int, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep``, code (two hex digits per part), error (squared distance to what the code stands for)."""
    given = vectors.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], "vector")
    if not dim:
        found = given.select(*given.columns[:-1], F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        kinds = ", ".join(f"{n} {t}" for n, t in given.dtypes[:-1])
        found = given.mapInArrow(_encode(books, dim), f"{kinds}, code string, error long")
    return found.toDF(*keep, "code", "error")


def decode(code: str, books: list[list[list[int]]]) -> list[float]:
    """The vector a code stands for."""
    return [v / SCALE for p, book in enumerate(books) for v in book[int(code[2 * p : 2 * p + 2], 16)]]


def digest(books: list[list[list[int]]]) -> str:
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    vectors = whole_vectors(rows).select("vec_id", "label", F.col("embedding").alias("vector"))
    books, dim = fit(vectors.select("vec_id", "vector"))
    coded = stage(encode(vectors, books, dim, ("vec_id", "label")), "codes")
    # Summed first, so that a label of very many vectors is one row when it meets them.
    labels = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    found = coded.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


_ROUND_SQL = """
), near{k} AS (
  SELECT r, part, arg_min(entry, d * 64 + entry) AS entry FROM (
    SELECT x.r, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d FROM cells x JOIN book{k} b USING (part, pos) GROUP BY ALL
  ) GROUP BY r, part
), mean{k} AS (
  SELECT part, entry, pos, sum(v) AS s, count(*) AS c FROM cells JOIN near{k} USING (r, part) GROUP BY part, entry, pos
), book{next} AS (
  SELECT b.part, b.entry, b.pos, CASE WHEN c IS NULL THEN b.v ELSE (s - ((s % c) + c) % c) // c END AS v FROM book{k} b LEFT JOIN mean{k} USING (part, entry, pos)
"""

OP12_SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbers AS (
  SELECT r, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) // 16 AS width FROM kept
), cells AS (
  SELECT r, i // width AS part, i % width AS pos, CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT) AS v FROM numbers
), book0 AS (
  SELECT part, r AS entry, pos, v FROM cells WHERE r < 64
"""
    + "".join(_ROUND_SQL.format(k=k, next=k + 1) for k in range(ROUNDS))
    + """
), distances AS (
  SELECT x.r, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d FROM cells x JOIN book2 b USING (part, pos) GROUP BY ALL
), best AS (
  SELECT r, part, min(d * 64 + entry) AS m FROM distances GROUP BY r, part
), coded AS (
  SELECT r, string_agg(printf('%02x', CAST(m % 64 AS INTEGER)), '' ORDER BY part) AS code, sum(m // 64) AS error FROM best GROUP BY r
), digest AS (
  SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS books FROM book2
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, books AS codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""
)

"""Nearest neighbours by multi-index hashing.

Codes: vectors are centred, turned onto principal axes and rotated so that signs lose least (iterative
quantization), all fitted on a bounded sample; a code has 64 bits, cut into 8 substrings of one byte.
Index: rows are dealt into blocks by a hash of the id; a block sorts its rows by each substring. Search:
if two codes differ in at most r bits, some substring differs in at most r // 8 (or, for the substrings
after the first r % 8 + 1, one less); the buckets of all such substring values are probed, what they hold
is checked on the whole code, and every code within the radius is ranked by the exact inner product of the
original vectors in double precision. The radius is learned on the sample: ``recall`` of the neighbours there lie within
it. A block that gives fewer than ``k`` widens the radius until it does or is exhausted.

Fitting takes ``FIT_ROWS`` rows (those with the smallest hashes of the id); every row is indexed, and every
query meets every block, so nothing is capped.

Defined cases: vectors that are null, zero, of another length than most, or with null or non-finite parts take no part; neither do rows without
an id. Rows with the same id count once, with the smallest vector. Equal scores rank by smaller id. A
table without such vectors has no rows. Other columns are ignored, whatever their names; no column holds texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import batch_of, stage

FIT_ROWS, BLOCK_ROWS = 8192, 8192
BITS, PARTS = 64, 8
_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class Coder:
    """Learned rotated binary codes."""

    def __init__(self, sample: np.ndarray, seed: int = 3, rounds: int = 30):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        _, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, :BITS]
        if axes.shape[1] < BITS:  # fewer axes than bits: random directions for the rest
            axes = np.hstack((axes, rng.normal(size=(sample.shape[1], BITS - axes.shape[1]))))
        z = x @ axes
        rotation, _ = np.linalg.qr(rng.normal(size=(BITS, BITS)))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(z @ rotation >= 0, 1.0, -1.0).T @ z)
            rotation = (left @ right).T
        self.turn = axes @ rotation

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One byte per substring."""
        return np.packbits((x - self.mean) @ self.turn >= 0, axis=1)


def whole(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes).view(np.uint64)[:, 0]


def learn_radius(coder: Coder, sample: np.ndarray, k: int, recall: float, queries: int = 512) -> int:
    """Radius that holds ``recall`` of the nearest neighbours within the sample."""
    codes = whole(coder.codes(sample))
    apart = []
    for i in range(min(queries, len(sample))):
        score = sample @ sample[i]
        score[i] = -np.inf
        near = np.argsort(-score)[: min(k, len(sample) - 1)]
        apart.append(np.bitwise_count(codes[near] ^ codes[i]))
    apart = np.concatenate(apart) if apart else np.zeros(0)
    return int(np.quantile(apart, recall, method="higher")) if len(apart) else BITS


class Block:
    """Rows of one block, indexed by every substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder):
        self.ids, self.vectors = ids, vectors
        codes = coder.codes(vectors)
        self.codes = whole(codes)
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(PARTS)]
        self.edges = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256)))) for j in range(PARTS)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ in at most ``radius`` bits."""
        found = np.zeros(len(self.ids), bool)
        for j in range(PARTS):
            most = radius // PARTS - (j > radius % PARTS)
            edges, order = self.edges[j], self.order[j]
            for value in np.flatnonzero(_NEAR[code[j]] <= most) if most >= 0 else ():
                found[order[edges[value] : edges[value + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ whole(code[None, :])[0]) <= radius]

    def nearest(self, query_id: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` nearest rows found."""
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != query_id]
            if len(rows) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + 4)
        score = (self.vectors[rows] * vector).sum(axis=1)  # row by row, so that equal rows score alike
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][best], score[best]


def _search(coder: Coder, radius: int, k: int):
    """Rows come by block, the block's own rows before the queries."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, kinds, ids = (np.asarray(batch.column(i)) for i in range(3))
            vectors = np.asarray(batch.column(3).flatten(), np.float64).reshape(batch.num_rows, -1)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if blocks[a] != key:
                    key, held, block = blocks[a], [], None
                if kinds[a] == 0:
                    held.append((ids[a:b], vectors[a:b]))
                    continue
                if block is None:
                    block = Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), coder)
                codes, out = coder.codes(vectors[a:b]), []
                for i in range(b - a):
                    near, score = block.nearest(int(ids[a + i]), vectors[a + i], codes[i], radius, k)
                    out.append((np.full(len(near), ids[a + i]), near, score))
                yield batch_of(schema, [pa.array(np.concatenate([o[j] for o in out])) for j in range(3)])

    return run


def taking_part(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one row per id, double precision, only vectors that can be compared."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(vectors: DataFrame, queries, k: int = 20, recall: float = 0.97, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of ``vectors`` (vec_id, embedding) for rows where ``queries`` holds."""
    spark = vectors.sparkSession
    rows = stage(taking_part(vectors), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = sizes[0]
    rows = rows.where(F.size("v") == d)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toPandas()
    sample = np.array(sample["v"].tolist(), np.float64).reshape(len(sample), d)
    coder = Coder(sample)
    radius = learn_radius(coder, sample, k, recall)

    blocks = max(1, -(-n // block_rows))
    own = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "v")
    # The query set meets every block: all queries are copied to each.
    asked = rows.where(queries).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v")
    dealt = own.union(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "vec_id")
    found = dealt.mapInArrow(_search(coder, radius, k), "query_id long, vec_id long, score double")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)").cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)

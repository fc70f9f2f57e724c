"""Helpers of the operators: staged tables, Arrow batches, word hashes, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What `\x20\x09-\x0D` matches: the bytes between two words.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: While a table is staged: Spark removes the shuffle files of the job afterwards, and Arrow batches stay small.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


# ---------------------------------------------------------------- staged tables


def shared_folder(spark: SparkSession) -> str:
    """Folder in ``spark.checkpoint.dir``; where that is unset, a local one, for sessions in one process only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


# Folders made since each open scope began.
_open: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession):
    """Remove, at the end, what was staged within; yields a list of folders that stay."""
    _open.append([])
    staying: list[str] = []
    try:
        yield staying
    finally:
        for path in set(_open.pop()) - set(staying):
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def settings(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    It cuts lineage, serves several readers from one computation and survives lost executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with settings(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for table in tables:
        _delete(table.sparkSession, table.staged_at)


# ---------------------------------------------------------------- Arrow batches


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, a few at a time, so that long texts are not all held twice."""
    for start in range(0, batch.num_rows, 256):
        part = batch.slice(start, 256)
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


class Buffer:
    """Gathers rows for output and hands out a batch whenever ``limit`` cells are reached."""

    def __init__(self, schema: pa.Schema, limit: int = 200_000):
        self.schema, self.limit = schema, limit
        self._clear()

    def _clear(self):
        self.columns, self.held = [[] for _ in self.schema], 0

    def add(self, *row, weight: int = 1):
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.held += weight

    def full(self) -> bool:
        return self.held >= self.limit

    def take(self) -> pa.RecordBatch:
        out = batch_of(self.schema, self.columns)
        self._clear()
        return out


def through(df: DataFrame, inputs: list, run, added: list[tuple[str, str]]) -> DataFrame:
    """``df`` through ``run``, which gets its columns and ``inputs`` last, and puts ``added`` in their place."""
    kept = [c for c in df.columns if c not in {n for n, _ in added}]
    names = [f"c{i}" for i in range(len(kept))]  # any names may occur in the input
    given = df.select(*[df[f"`{c}`"].alias(n) for c, n in zip(kept, names, strict=True)], *inputs)
    new = T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in added))
    out = given.mapInArrow(run, T.StructType([*given.schema.fields[: len(kept)], *new.fields]))
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], *[n for n, _ in added])


# ---------------------------------------------------------------- hashes

_rng = np.random.default_rng(20240517)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(12, int(n).bit_length()), base, dtype=np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def words_of(raw: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words begin and end."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = spaces[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    if not gap[-1]:
        edge = np.concatenate((edge, [len(raw)]))
    return edge[0::2], edge[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are ordered and do not overlap. Memory follows ``block``."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        low, high = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[raw[low:high]] * _powers(_STEP, high - low), out=sums[1:])
        first = starts[i:j] - low
        out[i:j] = (sums[ends[i:j] - low] - sums[first]) * _powers(_BACK, high - low)[first] + (ends[i:j] - starts[i:j]).astype(np.uint64)
        i = j
    return mix(out)


def rolling(values: np.ndarray, n: int, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive 64-bit values."""
    total = len(values) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(total, np.uint64)
    for i in range(0, total, block):
        part = values[i : min(i + block, total) + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _powers(_STEP, len(part)), out=sums[1:])
        m = len(part) - n + 1
        out[i : i + m] = (sums[n:] - sums[:-n]) * _powers(_BACK, m)
    return mix(out)


def sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``n`` values."""
    have, width = values, 1
    while width < n:
        step = min(width, n - width)
        have, width = pick(have[:-step], have[step:]), width + step
    return have


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def merge_ranges(starts, ends) -> list[tuple[int, int]]:
    """Union of half-open ranges, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of each node: (node, component), for edges (a, b) of any comparable type.

    Every round alternates two steps: link larger neighbours to the smallest one, then smaller
    neighbours to the smallest. Both are an aggregation (with map-side combine) and a join, so a hub is
    never gathered; the edges shrink to one star per component. Each round is staged.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    now = stage(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    for _ in range(max_rounds):
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        least = now.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = now.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        both = large.join(down, "a")
        small = both.select(F.col("b").alias("a"), F.col("m").alias("b")).union(both.select("a", F.col("m").alias("b")))
        small = small.where("a <> b").distinct()
        nxt = stage(small.select("a", "b"), "edges")
        # A star forest: every node has one root and no root has a root.
        bad = nxt.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not bad and not nxt.join(nxt.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            return nxt.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                nxt.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        now = nxt.union(nxt.select(F.col("b").alias("a"), F.col("a").alias("b")))
    raise RuntimeError("components did not settle")

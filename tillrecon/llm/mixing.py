"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: sources in code-point order (null last) share all words by weight; a target stops at ``most``
times its source's size and the excess is shared again. A source's target is a number of whole repeats
and a rest; documents are hashed into blocks, every repeat takes all blocks of the source in an own
permutation and the rest takes the first blocks of another, the last ones in part, document by document.

The drawn blocks of each source are its quota. The quotas are split among the output shards by a tree:
a node's quotas are halved by one multivariate hypergeometric draw, seeded by the node, until a leaf is
one shard. Shards then draw disjoint runs of each source's permuted blocks and order their rows by a hash.

Everything random is a hash of the seed and of the row's content, so reruns agree. The driver holds one
row per source and one number per source and shard; blocks are rows of a DataFrame. Blocks hold ``block_words`` words on average, so their number follows the data.

Defined cases: a null text has size 0; a null source is a source; a row of size 0 is taken as often as its
block; equal rows share their draws in the last block (taken together or not). A document longer than a block is a block of
its own; blocks that are drawn alike are ordered by their numbers; an empty table has no rows. Other columns pass through
``mix``; input columns called as one of the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import stage

WEIGHTS = (5, 2, 1)
_KEYS = ("source", "size", "uid")


def share_targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Share the sum of the sizes by weight; none above ``most`` times its size."""
    target, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / whole > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i] / whole
            break
        for i in over:
            target[i] = most * sizes[i]
        left -= sum(target[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return target


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (row) for each shard (column): exact row sums, shards of equal size up to one block."""
    out = np.zeros((len(quotas), shards), np.int64)

    def halve(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = counts
            return
        middle = (low + high) // 2
        left = int(round(int(counts.sum()) * (middle - low) / (high - low)))
        drawn = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(counts, left, method="marginals")
        halve(drawn, low, middle)
        halve(counts - drawn, middle, high)

    halve(np.asarray(quotas, np.int64), 0, shards)
    return out


def sized(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """row, source, size, uid: columns of ``docs`` as one, its source, its words and a hash of its content."""
    kept = [docs[f"`{c}`"].alias(c) for c in (docs.columns if keep is None else keep)]
    return docs.select(
        F.struct(*kept).alias("row"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("uid"),
    )


def _block(block_words: int, seed: int):
    """Block of a row; a document longer than a block is one of its own, with a negative number."""
    hashed = F.xxhash64(F.lit(seed), "uid")
    return F.when(F.col("size") > block_words, -1 - F.pmod(hashed, F.lit(1 << 60))).otherwise(F.pmod(hashed, "n_blocks")).alias("block")


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one source's last blocks: the documents that fit into what is left, in a permuted order."""
    pdf = pdf.sort_values(["rank", "order", "uid"], kind="stable")
    left, taken = max(0, int(pdf["room"].max())), []
    for size in pdf["words"].tolist():
        fits = size <= left
        left -= size if fits else 0
        taken.append(fits)
    # One more, the smallest, if that comes nearer to the target.
    over = [(size, i) for i, (size, fits) in enumerate(zip(pdf["words"].tolist(), taken, strict=True)) if not fits]
    if over and min(over)[0] - left < left:
        taken[min(over)[1]] = True
    return pdf.loc[taken, ["uid"]]


def plan(rows: DataFrame, weights=WEIGHTS, most: float = 3.0, shards: int = 64, block_words: int = 1 << 18, seed: int = 1) -> DataFrame:
    """``rows`` (of ``sized``) with source_size, target and copies: array of (repeat, shard), one per copy taken."""
    spark = rows.sparkSession
    small = stage(rows.select(*_KEYS), "sizes")
    sources = small.groupBy("source").agg(F.sum("size").alias("source_size")).collect()  # one row per source
    sources = sorted(sources, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["source_size"] for r in sources]
    targets = share_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    n_blocks = [max(1, -(-s // block_words)) for s in sizes]
    table = [(r["source"], s, t, b, int(t // s) if s else 0) for r, s, t, b in zip(sources, sizes, targets, n_blocks, strict=True)]
    by_source = spark.createDataFrame(table, "source string, source_size long, target double, n_blocks long, whole int")

    def with_source(df: DataFrame) -> DataFrame:
        # One row per source: the driver has made it.
        return df.join(F.broadcast(by_source.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    blocks = with_source(small).groupBy("source", "target", "source_size", "whole", _block(block_words, seed)).agg(F.sum("size").alias("words"))
    # Rank of each block in the permutation of each repeat; the last repeat takes blocks up to the target.
    turns = blocks.select("*", F.explode(F.sequence(F.lit(0), "whole")).alias("turn"))
    order = "partition by source, turn order by xxhash64({0}, source, turn, block), block".format(seed + 1)
    turns = turns.withColumn("rank", F.expr(f"row_number() over ({order})"))
    turns = turns.withColumn("before", F.expr(f"sum(words) over ({order} rows between unbounded preceding and current row) - words"))
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size"))
    turns = turns.withColumn("room", F.when(F.col("turn") == F.col("whole"), rest - F.col("before")))
    # From the first block that is too large for what is left, some are taken in part.
    turns = turns.withColumn("part", F.coalesce(F.col("words") > F.col("room"), F.lit(False)))
    # They are as many as it takes to fill it; documents that are a block of their own do not count.
    turns = turns.withColumn("filled", F.expr(f"sum(if(part and block >= 0, words, 0)) over ({order} rows between unbounded preceding and 1 preceding)"))
    turns = turns.withColumn("most", F.expr(f"max(if(part, room, null)) over ({order} rows between unbounded preceding and current row)"))
    turns = turns.where(~F.col("part") | (F.coalesce("filled", F.lit(0)) < F.col("most")))
    turns = stage(turns.select("source", "block", "turn", "rank", "room", "part"), "turns")

    quota = {r["source"]: r["n"] for r in turns.groupBy("source").agg(F.count("*").alias("n")).collect()}
    drawn = split_quotas(np.array([quota.get(r["source"], 0) for r in sources]), shards, seed)
    last = np.cumsum(drawn, axis=1)
    cuts = spark.createDataFrame([(r["source"], [int(x) for x in row]) for r, row in zip(sources, last, strict=True)], "s string, cuts array<long>")
    deal = "partition by source order by turn, rank"
    dealt = turns.withColumn("nth", F.expr(f"row_number() over ({deal})"))
    dealt = dealt.join(F.broadcast(cuts), F.col("source").eqNullSafe(F.col("s")))
    dealt = dealt.withColumn("shard", F.expr("size(filter(cuts, c -> c < nth))"))

    in_part = with_source(small).select("source", "size", "uid", _block(block_words, seed)).groupBy("source", "block", "uid").agg(F.sum("size").alias("words"))
    parts = dealt.where("part").select(F.col("source").alias("ps"), F.col("block").alias("pb"), "room", "rank")
    in_part = in_part.join(parts, F.col("source").eqNullSafe(F.col("ps")) & (F.col("block") == F.col("pb")))
    in_part = in_part.select("source", "uid", "words", "room", "rank", F.xxhash64(F.lit(seed + 2), "uid").alias("order"))
    # Few blocks of each source: bounded by the words of a block and of the longest document.
    filled = stage(in_part.groupBy("source").applyInPandas(_fill, "uid long"), "filled").distinct().withColumn("fits", F.lit(True))

    whole = dealt.groupBy("source", "block").agg(
        F.array_sort(F.collect_list(F.struct("turn", "shard", "part"))).alias("draws"), F.max("part").alias("part")
    )
    whole = whole.select(F.col("source").alias("ps"), F.col("block").alias("pb"), "draws", F.col("part").alias("has_part"))
    out = with_source(rows).select(*[F.col(f"`{c}`") for c in rows.columns], "source_size", "target", _block(block_words, seed))
    out = out.join(whole, F.col("source").eqNullSafe(F.col("ps")) & (F.col("block") == F.col("pb")), "left").join(filled, "uid", "left")
    draws = F.expr("transform(filter(coalesce(draws, array()), d -> not d.part or fits), d -> named_struct('turn', d.turn, 'shard', d.shard))")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], "source_size", "target", draws.alias("copies"))


def mix(docs: DataFrame, seed: int = 1, **settings) -> DataFrame:
    """The mix: one row per copy with its columns, mix_shard and mix_order; shards are shuffled by mix_order."""
    planned = plan(sized(docs), seed=seed, **settings)
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("mix_shard", "mix_order")]
    rows = planned.select("row", "uid", F.explode("copies").alias("copy"))
    return rows.select(*kept, F.col("copy.shard").alias("mix_shard"), F.xxhash64(F.lit(seed + 3), "uid", "copy").alias("mix_order"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    rows = stage(sized(docs, ["doc_id"]), "sized")
    out = plan(rows)
    return out.select(
        "row.doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("copies")).cast("long").alias("taken"),
        F.col("copies.shard").alias("shards"),
    )


def mix_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` mixed to the target weights; a document that is repeated has as many rows.

    Rows stand in the order of their shard and draw within each file; ``mix`` names both. Cases are those of the module: null
    texts and sources mix like others, an empty table stays empty, all columns pass unchanged whatever their names.
    """
    planned = plan(sized(docs)).select("row", "uid", F.explode("copies").alias("copy"))
    order = F.xxhash64(F.lit(4), "uid", "copy")  # as in ``mix``
    return planned.sortWithinPartitions("copy.shard", order).select(*[F.col("row")[c].alias(c) for c in docs.columns])

"""Mixing: targets, exact quotas, nearness, repeatability."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillrecon.llm.mixing import mix, mix_documents, op6_mixing, plan, share_targets, sized, split_quotas


def test_targets_stop_and_reshare():
    sizes, weights = [10, 1000, 0, 90], [5, 2, 1, 5]
    got = share_targets(sizes, weights)
    assert got[0] == 30 and got[2] == 0 and got[3] == 270 and np.isclose(sum(got), 1100)
    assert share_targets([], []) == [] and share_targets([0, 0], [1, 1]) == [0.0, 0.0]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_tree_gives_exact_quotas(shards):
    quotas = np.array([0, 1, 7, 500, 33])
    got = split_quotas(quotas, shards, 4)
    assert (got.sum(axis=1) == quotas).all() and (got >= 0).all()
    assert got.sum(axis=0).max() - got.sum(axis=0).min() <= 3
    assert (got == split_quotas(quotas, shards, 4)).all()


def test_tree_is_hypergeometric():
    """One source's share of the first of two shards: mean and variance of the distribution."""
    draws = np.array([split_quotas(np.array([60, 40]), 2, s)[0, 0] for s in range(3000)])
    assert abs(draws.mean() - 30) < 0.25 and abs(draws.var() - 100 * 0.6 * 0.4 * 50 * 50 / 100 / 99) < 0.6


def rows_of(docs, prose):
    rows = [(i, prose(i, 1 + i * 7 % 90)) for i in range(300)]
    return docs(rows + [(3, rows[3][1]), (400, None), (401, ""), (None, "a b c"), (402, prose(9, 5000))])


def test_taken_words_come_near_targets(docs, prose):
    given = rows_of(docs, prose).withColumn("source", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") < 60, "a").otherwise("b"))
    out = plan(sized(given), block_words=700, shards=4).toPandas()
    assert len(out) == 305
    out["taken"] = out["size"] * out["copies"].map(len)
    sums = out.assign(source=out.source.fillna("~")).groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert np.isclose(sums.target.sum(), sums["size"].sum())
    # Within a document of the last block of the target.
    assert (abs(sums.taken - sums.target) <= 60).all()
    assert (out.taken <= 3 * out["size"]).all()
    assert {c.shard for cs in out.copies for c in cs} <= set(range(4))


def test_mix_keeps_columns_and_repeats(spark, docs, prose):
    given = rows_of(docs, prose)
    out = mix_documents(spark, given, "")
    assert out.columns == given.columns
    key = ["doc_id", "text"]
    assert sorted(map(str, out.select(key).collect())) == sorted(map(str, mix_documents(spark, given.repartition(5), "").select(key).collect()))
    shards = mix(given, shards=8, block_words=300).groupBy("mix_shard").count().collect()
    assert len(shards) == 8


def test_empty_table_and_query(spark, docs):
    assert mix(docs([])).count() == 0
    out = op6_mixing(spark, "/root/testdata/sf0.01").toPandas()
    sums = out.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert (abs(sums.taken - sums.target) < 0.02 * sums.target).all()

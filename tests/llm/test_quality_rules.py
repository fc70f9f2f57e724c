"""Statistics against brute force, rules on held-out rows, the list as a Spark column."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillrecon.llm.quality_rules import (
    STATS, base_failed, covered, feature_matrix, fit, keep_good, learn_rules, op3_quality, rules_column, text_stats, with_stats,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


TEXTS = [
    None, "", " \n ", "one", "a b a b a b c", "a b c\na b c\n\n \na b c\r\n", "é ü x 😀 # * $%&|<>", "x " * 200, "\n".join(["line of text"] * 5),
    " ".join(str(i % 17) for i in range(400)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_stats(text):
    s = dict(zip(STATS, text_stats(text)))
    assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == brute(text)


def test_stats_pass_all_columns(docs):
    given = docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, "x")]).withColumn("quality_stats", F.lit("old"))
    out = with_stats(given)
    assert out.columns == [c for c in given.columns if c != "quality_stats"] + ["quality_stats"]
    assert sorted((str(r.doc_id), r.quality_stats.n_words, r["a.b"]) for r in out.collect()) == sorted(
        (str(i), brute(t)[0], "d") for i, t in [*enumerate(TEXTS), (None, "x")]
    )


def sample(seed, n=3000):
    rng = np.random.default_rng(seed)
    stats = np.zeros((n, len(STATS)), np.int64)
    stats[:, 0] = rng.integers(60, 900, n)
    stats[:, 1] = stats[:, 0] * rng.integers(4, 8, n)
    stats[:, 4] = rng.integers(1, 30, n)
    bad = rng.random(n) < 0.15
    noisy = bad & (rng.random(n) < 0.7)
    stats[:, 2] = np.where(noisy, stats[:, 0] // 3, rng.integers(0, 3, n))
    stats[:, 3] = np.where(bad & ~noisy, stats[:, 4] * 3 // 4 + 1, 0)
    return stats, bad


def test_rules_hold_on_other_rows_and_as_column(spark):
    rules = learn_rules(*sample(1))
    stats, bad = sample(2)
    rejected = np.any([covered(r, feature_matrix(stats)) for r in rules], axis=0)
    assert (rejected & bad).sum() > 0.95 * bad.sum() and (rejected & ~bad).sum() < 0.01 * (~bad).sum()
    df = spark.createDataFrame([(i, tuple(map(int, s))) for i, s in enumerate(stats[:400])], f"i int, quality_stats struct<{','.join(f'{s}:bigint' for s in STATS)}>")
    got = {r.i: r.v for r in df.select("i", rules_column(rules).alias("v")).collect()}
    assert [got[i] for i in range(400)] == (~rejected[:400]).tolist()


@pytest.mark.parametrize("bad", [[], [True] * 5, [False] * 5])
def test_no_rules_without_both_classes(bad):
    assert learn_rules(np.zeros((len(bad), len(STATS)), np.int64), np.array(bad, bool)) == []


def test_query_and_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = op3_quality(spark, sf).toPandas().set_index("doc_id")
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        row, e = out.loc[r.doc_id], brute(r.text) if len(r.text) < 9000 else None
        if e:
            assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == e
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.kept and row.base_failed)
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    both = labels.join(out, how="inner")
    both = both[~both.base_failed]
    assert both[both.quality == 1].kept.mean() > 0.98 and both[both.quality == 0].kept.mean() < 0.35


def test_labels_null_repeated_or_missing(spark, docs, tmp_path):
    given = with_stats(docs([(i, "word " * 60) for i in range(5)]))
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (None, 0), (2, None), (99, 0)], "doc_id long, quality int")
    assert fit(given.select("doc_id", "quality_stats"), labels) == []
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = docs([(1, " ".join(map(str, range(80)))), (2, "short"), (None, None)])
    out = keep_good(spark, rows, str(tmp_path))
    assert out.columns == rows.columns and [r.doc_id for r in out.collect()] == [1]
    assert keep_good(spark, docs([]), str(tmp_path)).count() == 0
    assert with_stats(docs([])).where(base_failed()).count() == 0

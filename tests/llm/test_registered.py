"""Registered queries against their SQL, the pipeline stage by stage, connected components."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from tillrecon.llm.common import components, shared_folder
from tillrecon.llm.queries import ORACLES, QUERIES
from tillrecon.llm.sentencepiece_sampling import decode

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name, monkeypatch):
    monkeypatch.setattr(oracle, "TYPES", oracle.TYPES | {"boolean": "BOOLEAN", "double": "DOUBLE"})
    assert oracle.compare(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name]) is None


def test_all_are_registered():
    assert [f"op{n}_" for n in range(1, 14)] == sorted((q[: q.index("_") + 1] for q in QUERIES), key=lambda q: int(q[2:-1]))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == [*docs.columns, "ids"]
    rows = out.collect()
    assert 0 < len(rows) and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(len(r.text) == r.n_chars for r in rows)


def small_corpus(prose):
    """Texts with a source of their own; copies, near copies, a shared passage, poor ones."""
    words = lambda seed, n: prose(seed, n).split()
    shared = words(900, 70)
    rows = {i: words(i, 60 + 3 * i) for i in range(12)}
    rows |= {20: rows[3], 21: [*rows[5][:-2], "other", "end"], 22: [*rows[5][:-1], "x"]}
    rows |= {30: words(30, 60) + shared + words(31, 40), 31: words(32, 55) + shared, 32: shared[:55] + words(33, 80)}
    rows |= {40: words(40, 49), 41: words(41, 10) * 9, 42: words(42, 50), 43: []}
    return {i: " ".join(w) for i, w in rows.items()} | {44: None}


def brute_pipeline(texts):
    """doc_id -> words of the final text, for one source and no labels."""
    sets = {i: (t or "").split() for i, t in texts.items()}

    def good(w):
        runs = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        inside = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(3)}
        return len(w) >= 50 and 100 * len(inside) <= 50 * len(w)

    kept = {i: w for i, w in sets.items() if good(w)}
    shingles = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in kept.items()}
    links = {i: {j for j in kept if 100 * len(shingles[i] & shingles[j]) >= 80 * len(shingles[i] | shingles[j])} for i in kept}
    first = dict.fromkeys(kept)
    for i in sorted(kept):
        todo, seen = [i], set()
        while todo:
            if (j := todo.pop()) not in seen:
                seen.add(j)
                todo += links[j]
        first[i] = min(seen)
    kept = {i: w for i, w in kept.items() if first[i] == i}
    windows = {i: [tuple(w[k : k + 50]) for k in range(len(w) - 49)] for i, w in kept.items()}
    out = {}
    for i, w in kept.items():
        before = {x for j in kept if j < i for x in windows[j]}
        gone = {k + n for k, x in enumerate(windows[i]) if x in before for n in range(50)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_pipeline_against_brute_force(spark, tmp_path, prose):
    texts = small_corpus(prose)
    rows = [(i, t, "en", "one", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    folder = f"{shared_folder(spark)}/llm".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = out.collect()
    want = brute_pipeline(texts)
    assert {r.doc_id: r.text.split() for r in got} == want and len(got) == len(want)
    assert {20, 21, 22, 40, 41, 43, 44}.isdisjoint(want) and len(want[31]) == 55 and len(want[32]) < 135
    assert all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == r.old for r in decode(out.withColumnRenamed("text", "old")).collect())
    # Of all that was staged only what the last stage reads is left.
    assert len(set(os.listdir(folder)) - before) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(1, 90)]
    edges += [(5, 5), (None, 3)]
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            least[high] = low
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in least}
    assert components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).count() == 0

"""Prefix-free parsing against sorted suffixes and a direct count of windows."""

import collections
import hashlib
import random

import pytest

from tillrecon.llm import suffix_dedup
from tillrecon.llm.suffix_dedup import corpus_order, op4_suffix, remove_repeated_bytes, repeated_places, shard_ranges


def pieces(seed):
    rng = random.Random(seed)
    letters = rng.choice(["a", "ab", "abcdefgh ", "\x00\x01é"])
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 500))) for _ in range(3)]
    return ["".join(rng.choice(base)[rng.randint(0, 50) :] for _ in range(rng.randint(0, 4))).encode() for _ in range(rng.randint(1, 6))]


@pytest.mark.parametrize("seed", range(12))
def test_order_and_repeats(seed):
    texts = pieces(seed)
    piece, place, order = corpus_order(texts)
    suffixes = [texts[piece[k]][place[k] :] for k in order]
    assert len(suffixes) == sum(map(len, texts)) and suffixes == sorted(suffixes)
    for window in (40, 100):
        count = collections.Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
        expected = [[i for i in range(len(t) - window + 1) if count[t[i : i + window]] > 1] for t in texts]
        assert [p.tolist() for p in repeated_places(texts, window)] == expected


def test_passes_give_what_one_pass_gives():
    rng = random.Random(4)
    common = rng.randbytes(900)
    texts = [rng.randbytes(rng.randint(0, 600)) + common[rng.randint(0, 400) :] + rng.randbytes(50) for _ in range(25)]
    counts = [1] * 24 + [2]
    assert shard_ranges(texts, counts, 400) == shard_ranges(texts, counts, 400, pass_bytes=3000)


def brute(rows, window=400):
    texts = [(t or "").encode() for _, t in rows]
    name = lambda b: hashlib.blake2b(b, digest_size=12).digest()
    count = collections.Counter(name(b[i : i + window]) for b in texts for i in range(len(b) - window + 1))
    out = []
    for (i, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if count[name(b[k : k + window])] > 1:
                gone[k : k + window] = b"\1" * window
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def test_whole_operator(docs, prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_DOCS", 10)
    rng = random.Random(1)
    common = [prose(k + 50, n) for k, n in enumerate((70, 90, 200))]
    rows = [(i, f"{prose(i, rng.randint(0, 80))} {rng.choice(common)}{prose(i + 90, rng.randint(0, 80))}") for i in range(40)]
    rows += [(60, rows[4][1]), (61, rows[4][1]), (4, rows[4][1]), (62, None), (63, ""), (None, rows[7][1]), (None, None), (64, "z" * 3000)]
    rows += [(65, "é" * 399), (66, "é" * 150 + prose(1, 20)), (67, prose(3, 400) * 2), (68, "z" * 400), (69, prose(6, 12_000))]
    rng.shuffle(rows)
    out = remove_repeated_bytes(docs(rows))
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=str) == brute(rows)
    assert remove_repeated_bytes(docs([])).count() == 0


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = [(i, n, r, s, hashlib.sha256(k).hexdigest(), k.decode("utf-8", "replace")) for i, n, r, s, k in brute([(d.doc_id, d.text) for d in docs])]
    assert sorted(map(tuple, op4_suffix(spark, "/root/testdata/sf0.001").collect()), key=str) == sorted(expected, key=str)

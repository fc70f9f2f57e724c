"""Sampled segmentations: lossless, reproducible, and distributed as the lattice says."""

import collections
import itertools
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillrecon.llm import sentencepiece_sampling as sp
from tillrecon.llm.sentencepiece_sampling import MODEL, TOKENIZERS, Encoder, decode, encode, op2_sentencepiece

TEXTS = [
    None, "", " ", "  a", "a  ", "▁x▁ ▁", "a\nb\t\r\n", "x" * 500, " é😀 漢字 \u0000", "The quick brown fox", "Ünïcödé " * 50, "word " * 3000,
]


def test_round_trip_with_all_columns(docs):
    given = docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, "no key"), (3, TEXTS[3])])
    tokens = encode(given, back=True)
    assert tokens.columns == [c for c in given.columns if c != "ids"] + ["ids", "decoded"]
    rows = tokens.collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.decoded == r.text for r in rows)
    assert all((r.ids is None) == (r.text is None) and (r["a.b"], r.c0) == ("d", "c") for r in rows)
    again = decode(tokens.withColumnRenamed("text", "old"))
    assert all(r.text == r.old for r in again.collect())


def test_same_on_any_layout_and_other_seed(docs, prose):
    given = docs([(i, prose(i % 7, 300)) for i in range(40)])
    one = {r.doc_id: r.ids for r in encode(given.coalesce(1)).collect()}
    assert one == {r.doc_id: r.ids for r in encode(given.repartition(7)).collect()}
    assert one[0] != one[7]  # the same text under another key
    assert one != {r.doc_id: r.ids for r in encode(given, seed=2).collect()}


def test_draws_follow_the_lattice():
    """Frequencies of whole segmentations of a word against their weights."""
    encoder = Encoder(f"{TOKENIZERS}/{MODEL}", 1.0, 1)
    vocab, word, n = encoder.vocab, " thing", 40_000
    weight = {}
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(edges, edges[1:])]
        if all(p in vocab.pieces for p in parts):
            ids = tuple(vocab.pieces[p] for p in parts)
            weight[ids] = float(np.prod([(i + 1.0) ** -1 for i in ids]))
    whole = sum(weight.values())
    got = collections.Counter(tuple(x.tolist()) for x in encoder.encode(list(range(n)), [word[1:]] * n))
    assert set(got) <= set(weight)
    for ids, w in weight.items():
        p = w / whole
        assert abs(got[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


def marginals(vocab, text, alpha=1.0):
    """Expected number of draws of each id, by exact forward and backward sums over the whole text with a space in front."""
    text = " " + text
    arcs = []
    for i in range(len(text)):
        found = [(i, j, vocab.pieces[text[i:j]]) for j in range(i + 1, len(text) + 1) if text[i:j] in vocab.pieces]
        arcs += found if any(j == i + 1 for _, j, _ in found) else [*found, (i, i + 1, -1)]
    weight = lambda p: Fraction(float((p if p >= 0 else vocab.size - 1) + 1.0) ** -alpha)
    ahead, behind = [Fraction(1)] + [Fraction(0)] * len(text), [Fraction(0)] * len(text) + [Fraction(1)]
    for i, j, p in arcs:
        ahead[j] += ahead[i] * weight(p)
    for i, j, p in reversed(arcs):
        behind[i] += weight(p) * behind[j]
    out = collections.Counter()
    for i, j, p in arcs:
        out[p] += float(ahead[i] * weight(p) * behind[j] / ahead[-1])
    return out


@pytest.mark.parametrize("text", ["def f():        return   x", "x" * 63 + "ing" + "the" * 20, "a" + " " * 80 + "b"])
def test_no_boundary_that_the_vocabulary_does_not_have(monkeypatch, text):
    """Runs of spaces and places over 64 characters: mean counts of ids against exact sums over the whole text."""
    monkeypatch.setattr(sp, "BLOCK", 50)
    encoder, n = Encoder(f"{TOKENIZERS}/{MODEL}", 1.0, 1), 3000
    want, got, squares = marginals(encoder.vocab, text), collections.Counter(), collections.Counter()
    for ids in encoder.encode(list(range(n)), [text] * n):
        for i, c in collections.Counter(ids.tolist()).items():
            got[i] += c
            squares[i] += c * c
    assert set(got) <= set(want)
    for i, mean in want.items():
        spread = max(squares[i] / n - (got[i] / n) ** 2, mean) ** 0.5
        assert abs(got[i] / n - mean) < 5 * spread / n**0.5 + 2e-3


def test_same_ids_wherever_long_units_begin(monkeypatch, prose):
    texts = ["http://a.example/" + "path/index?q=ab&" * 40, "漢字" * 70 + " é▁\n" * 9, prose(1, 50).replace(" ", "-"), "  x" + " " * 99, prose(2, 60)]
    path = f"{TOKENIZERS}/{MODEL}"
    one = [i.tolist() for i in Encoder(path, 0.5, 1).encode([1, 2, 3, 4, 5], texts)]
    for most, block in ((1, 7), (5, 1000), (64, 33)):
        monkeypatch.setattr(sp, "UNIT_CHARS", most)
        monkeypatch.setattr(sp, "BLOCK", block)
        assert one == [i.tolist() for i in Encoder(path, 0.5, 1).encode([1, 2, 3, 4, 5], texts)]
    encoder = Encoder(path, 200.0, 1)  # weights beyond the range of numbers
    assert [encoder.decode(i.tolist()) for i in encoder.encode([1, 2, 3, 4, 5], texts)] == texts


@pytest.mark.parametrize("alpha", [0.0, 0.3, 3.0])
def test_alpha_and_small_store(monkeypatch, prose, alpha):
    monkeypatch.setattr(sp, "UNITS_KEPT", 50)
    encoder = Encoder(f"{TOKENIZERS}/{MODEL}", alpha, 1)
    for i in range(4):
        text = prose(i, 200) + " é" * 5 + "漢" * 90
        assert encoder.decode(encoder.encode([i], [text])[0].tolist()) == text


def test_query_is_lossless_and_empty_table(spark, docs):
    out = op2_sentencepiece(spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.where(~F.col("lossless")).count() == 0
    assert encode(docs([])).count() == 0

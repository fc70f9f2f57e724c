"""Divergence against brute force; skybands; empty and odd cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillrecon.llm import source_divergence as s

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_docs=10, ranks=10):
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    docs, out = defaultdict(Counter), []
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        docs[lang].update(set(terms(text)))
        counts[lang, source].update(terms(text))
    for lang in {k for k, _ in counts}:
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=lambda t: t.encode())
        sources = sorted(b for a, b in counts if a == lang)
        whole = sum((counts[lang, x] for x in sources), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {x: shares(counts[lang, x]) for x in sources}
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for x in sources:
            pairs = [(y, sum(f(p[x][t], p[y][t]) for t in kept)) for y in sources if y != x]
            own = [(t, f(p[x][t], q[t])) for t in kept if counts[lang, x][t] and p[x][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, ranks)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, x, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(t, a, b, 1, "x", "y") for t, a, b in rows], "text string, lang string, source string, n int, term string, total string")


def random_rows(seed, n, words):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aBcDéßж") for _ in range(rng.randint(1, 4))) for _ in range(words)]
    rows = []
    for _ in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", None, ""])
        bias = {"b": 3, "c": 7}.get(source, 0)
        text = " ".join(vocabulary[min(words - 1, int(rng.expovariate(0.05)) * (1 + bias) % words)] + rng.choice(["", ",", "1", "_"]) for _ in range(rng.randint(0, 40)))
        rows.append((text if rng.random() > 0.02 else None, rng.choice(["en", "en", "de", None]), source))
    return rows


@pytest.mark.parametrize("seed,ranks", [(1, 10), (2, 2)])
def test_against_brute_force(spark, monkeypatch, seed, ranks):
    rows = random_rows(seed, 400, 150) + [("", "fr", "x"), (None, "fr", "y"), ("word once", "it", "z")] + [("Same same TEXT", "en", "hot")] * 60
    monkeypatch.setattr(s, "HELD", 100)  # counts are handed on more than once
    got = sorted(tuple(r) for r in s.audit(table(spark, rows), ranks=ranks).collect())
    assert got == brute(rows, ranks=ranks)


def test_empty_table(spark):
    assert s.audit(table(spark, [])).count() == 0


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband(k):
    rng = np.random.default_rng(k)
    n, total = rng.integers(1, 30, 700), rng.integers(1, 60, 700)
    term = [f"t{i:04}" for i in rng.permutation(700)]
    beaten = [sum(n[j] >= n[i] and total[j] <= total[i] and term[j] < term[i] for j in range(700)) for i in range(700)]
    assert sorted(s.skyband(n, total, term, k)) == [i for i in range(700) if beaten[i] < k]


def test_terms_in_steps(monkeypatch):
    text = "One  twoTHREE;é四 " * 50 + "x" * 40 + " " + "é" * 30
    for step in (1, 2, 7, 16, 10_000):
        monkeypatch.setattr(s, "STEP", step)
        assert [t.decode() for part in s.terms_of(text) for t in part] == terms(text)


def test_shares_beyond_64_bits():
    counts = np.array([[10**12, 3], [0, 10**15]])
    totals = [10**12, 10**15 + 3]
    got = s._shares(counts, totals, 2)
    assert got.tolist() == [[1 + 10**9 * (int(c) + 2) // (n + 4) for c, n in zip(row, totals, strict=True)] for row in counts]

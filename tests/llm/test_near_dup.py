"""Near-duplicates against brute force over all pairs."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from tillrecon.llm import near_dup
from tillrecon.llm.near_dup import keep_one, linked, near_duplicates, prune_bounds


def brute(rows, words, percent=80):
    """(n_shingles, component, kept) of each row, in order."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    least = {i: i for i, _ in rows if i is not None}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for (a, x), (b, y) in itertools.combinations([(r[0], s) for r, s in zip(rows, sets) if r[0] is not None], 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            least[high] = low
    return [(len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets)]


def mutated(text, rng, share):
    return " ".join("x%d" % rng.randrange(10**6) if rng.random() < share else w for w in text.split())


def check(df, rows, words):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)
    assert got == sorted(((i, *e) for (i, _), e in zip(rows, brute(rows, words))), key=str)


def test_groups_copies_and_edges(docs, prose):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = prose(g, rng.choice([1, 2, 8, 60, 300]))
        rows += [(len(rows) + k, mutated(base, rng, share)) for k, share in enumerate((0, 0, 0.01, 0.02, 0.04, 0.08))]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (None, rows[0][1]), (None, None)]
    rows += [(0, rows[0][1]), (906, prose(77, 20_000))]
    rng.shuffle(rows)
    check(near_duplicates(docs(rows), shingle_words=2), rows, 2)


@pytest.mark.parametrize("centre,apart,salt", [(3, 2, 3), (1, 1, 1), (2, 7, 2)])
def test_large_group_is_split(docs, prose, monkeypatch, centre, apart, salt):
    """Tasks of a few rows: centres are salted, members outside the first component dealt into parts that meet each other."""
    for name, n in (("CENTRE_ROWS", centre), ("APART_ROWS", apart), ("SALT_ROWS", salt)):
        monkeypatch.setattr(near_dup, name, n)
    rng = random.Random(8)
    base = prose(3, 200)
    rows = [(i, mutated(base, rng, rng.choice([0.01, 0.03, 0.06, 0.09]))) for i in range(60)]
    # A family of which most members are linked with a few others only.
    heads = [mutated(base, rng, 0.12) for _ in range(12)]
    rows += [(100 + i, mutated(heads[i % 12], rng, 0.02)) for i in range(60)]
    check(near_duplicates(docs(rows), shingle_words=2), rows, 2)


def test_bucket_of_many_apart(docs, prose, monkeypatch):
    """Hundreds of members outside the first component, more than a part or a salt takes."""
    monkeypatch.setattr(near_dup, "APART_ROWS", 20)
    monkeypatch.setattr(near_dup, "SALT_ROWS", 30)
    rng = random.Random(4)
    base = prose(5, 150)
    heads = [mutated(base, rng, 0.11) for _ in range(40)]
    rows = [(i, mutated(heads[i % 40], rng, 0.015)) for i in range(400)]
    check(near_duplicates(docs(rows), shingle_words=2), rows, 2)


def test_empty_table(docs):
    assert near_duplicates(docs([])).count() == 0


def test_stage_keeps_columns_and_one_of_each_group(spark, docs, prose):
    rows = [(5, prose(1, 90)), (3, prose(1, 90)), (7, prose(2, 90)), (7, prose(2, 90)), (None, prose(2, 90)), (8, None)]
    given = docs(rows)
    out = keep_one(spark, given, "")
    assert out.columns == given.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "7", "8", "None"]


@pytest.mark.parametrize("n,fewest", prune_bounds(192, 64, 0.8, 1e-4))
def test_prune_bound_is_the_posterior(n, fewest):
    """Integrate the Beta posterior numerically on both sides of the bound."""

    def tail(m):
        x = np.linspace(0, 1, 200_001)[1:-1]
        log = m * np.log(x) + (n - m) * np.log(1 - x)
        p = np.exp(log - log.max())
        return p[x >= 0.8].sum() / p.sum()

    assert tail(fewest) >= 1e-4 > tail(fewest - 1)
    assert math.isclose(fewest / n, 0.7, abs_tol=0.12)


def test_linked_counts_exactly():
    a, b = np.arange(0, 10, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64)
    assert linked(a, b, 80) and not linked(a, b, 82)  # 9 of 11

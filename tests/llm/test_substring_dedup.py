"""Substring dedup against a direct count of windows."""

import random
import re

import pytest

from tillrecon.llm import substring_dedup
from tillrecon.llm.substring_dedup import cut_repeats, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def check(docs, rows):
    out = remove_repeats(docs(rows))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=str) == brute(rows)


def test_passages_copies_and_edges(docs, prose):
    rng = random.Random(2)
    shared = [prose(100 + k, n) for k, n in enumerate((49, 50, 51, 80, 200))]
    rows = []
    for i in range(60):
        parts = [prose(i, rng.randint(0, 60)), rng.choice(shared), prose(i + 500, rng.randint(0, 60)), rng.choice(shared)]
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(1, rows[5][1]), (2, rows[5][1]), (15, rows[5][1]), (None, rows[5][1]), (400, None), (401, ""), (402, " \n ")]
    rows += [(403, "the " * 300), (404, "the " * 120), (405, prose(9, 30_000)), (406, prose(9, 30_000)[1000:9000])]
    rng.shuffle(rows)
    check(docs, rows)


def test_small_shards_salts_and_automata(docs, prose, monkeypatch):
    for name, value in (("SHARD_DOCS", 5), ("SALT_BYTES", 500), ("AUTOMATON_WORDS", 60)):
        monkeypatch.setattr(substring_dedup, name, value)
    common = prose(1, 70)
    rows = [(i, f"{prose(i + 10, 20)} {common} {prose(i % 4 + 300, 90)}") for i in range(30)]
    check(docs, rows)


def test_empty_table(docs):
    assert remove_repeats(docs([])).count() == 0


def test_stage_cuts_text_and_keeps_columns(spark, docs, prose):
    common = prose(1, 60)
    given = docs([(1, f"a {common} b"), (2, f"c  d {common}\ne\tf "), (3, None)])
    out = cut_repeats(spark, given, "")
    assert out.columns == given.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: f"a {common} b", 2: "c  d e\tf ", 3: None}


@pytest.mark.parametrize("window,phrase", [(50, 12), (10, 3)])
def test_automaton_finds_every_window(prose, window, phrase):
    import numpy as np

    from tillrecon.llm.common import rolling, span_hashes, words_of

    def hashes(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return span_hashes(raw, *words_of(raw))

    passage = hashes(prose(1, 90))
    automaton = substring_dedup.Automaton([(7, passage)], window, phrase)
    text = np.concatenate((hashes(prose(2, 33)), passage[5:80], hashes(prose(3, 20)), passage[: window - 1]))
    expected = np.flatnonzero(np.isin(rolling(text, window), rolling(passage, window)))
    assert automaton.earlier(8, text).tolist() == expected.tolist() == list(range(33, 33 + 75 - window + 1))
    assert not len(automaton.earlier(7, text))

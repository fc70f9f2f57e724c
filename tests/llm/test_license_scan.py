"""Base phrases against brute force; labels of the rare-token index."""

import re

from tillrecon.llm import license_scan as L
from tillrecon.llm.license_scan import BASE, TEMPLATES, op7_licenses, scan_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in BASE.items():
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


ROWS = [
    (1, "Released under the MIT License."), (2, "under the mit license under THE MIT-license under the mit"), (3, None), (4, ""), (5, "--- \x7f"),
    (6, "x, Apache License, Version 2.0; CC-BY-NC 4.0 … under the MIT license"), (7, "under theé mit license cc byé nc"),
    (8, "This work is licensed under the GNU General Public License, version 3."), (9, "the general public of version 3 of a license"),
    (10, "word " * 5000 + "cc by nc"), (11, "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    (1, "Released under the MIT License."), (None, "cc by nc"), (12, "He is under the Mit. License to kill."), (13, "gnu public general license version 3"),
]


def test_base_and_labels(docs):
    rows = scan_licenses(docs(ROWS)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in ROWS), key=str)
    labels = {r.doc_id: (r.labels, r.score) for r in rows}
    assert labels[8] == ("gpl-3", 1.0) and labels[11][0] == "bsd-3-clause"
    assert labels[7] == ("", 0.6)  # three of the five words of the notice at one position
    assert labels[6] == ("apache-2,cc-by-nc,mit", 1.0)
    assert all(labels[i] == ("", 0.0) for i in (3, 4, 5, 9, 13))
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)


def test_every_template_is_found_in_its_own_notice(docs):
    rows = [(i, f"some words before {must[0]} and then {' '.join(passages)} after") for i, (must, passages) in enumerate(TEMPLATES.values())]
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(docs(rows)).collect()}
    assert all(label in got[i] for i, label in enumerate(TEMPLATES))


def test_all_notices_in_one_file(docs):
    notices = " ".join(f"{must[0]} --- {' '.join(passages)} ---" for must, passages in TEMPLATES.values())
    words = " ".join(w for _, passages in TEMPLATES.values() for p in passages for w in sorted(set(p.split()), reverse=True))
    rows = [(i, f"{words} {must[0]} --- {' '.join(passages)}") for i, (must, passages) in enumerate(TEMPLATES.values())]
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(docs([(99, notices), *rows])).collect()}
    assert got[99] == sorted(TEMPLATES)
    assert all(label in got[i] for i, label in enumerate(TEMPLATES))  # one notice in a text that has every word of the templates


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def verdicts(texts):
    """(labels, score) of each text by trying every alignment."""
    texts = [words_of(t) for t in texts]
    known = {w for _, _, words in L.passages_of() for w in words}
    looks = L.looked_up({w: sum(w in t for t in map(set, texts)) for w in known})
    out = []
    for t, (_, n_base, _, _, base) in zip(texts, (brute(" ".join(t)) for t in texts), strict=True):
        best = {}
        for label, k, words in L.passages_of():
            look = looks[label, k]
            for begin in range(-len(words) - L.SLACK, len(t)):
                held = {w for i, w in enumerate(words) if w in look and w in t[max(0, begin + i) : max(0, begin + i + L.SLACK + 1)]}
                share = len(held) / len(look)
                if share < L.PROPOSED:
                    continue
                low, high = max(0, begin - L.NEAR), begin + len(words) + L.SLACK + L.NEAR
                around = f" {' '.join(t[low:high])} "
                if any(f" {phrase} " in around for phrase in TEMPLATES[label][0]):
                    best[label] = max(best.get(label, 0), share)
        labels = set(filter(None, base.split(","))) | {x for x, share in best.items() if share >= L.ALIGNED}
        out.append((",".join(sorted(labels)), 1.0 if n_base else max(best.values(), default=0.0)))
    return out


MIT = TEMPLATES["mit"][1][1]


def edited(words, *places):
    return " ".join("changed" if i in places else w for i, w in enumerate(words.split()))


PLANTED = [
    edited(MIT, 9, 14, 20),  # three words changed
    MIT.replace("associated documentation", "associated and attached documentation").replace("to deal", "deal"),  # one put in, one left out
    edited(MIT, *range(8, 27)),  # no notice any more
    "someone spoke of the mit license " + "and then of other things " * 40,
    "the isc license", "gplv3 or gpl v3",
    " ".join(reversed(MIT.split())) + " permission is hereby granted free of charge",
    "permission is hereby granted free of charge " + "x " * 60 + " ".join(MIT.split()[7:]),  # the phrase far from the rest
    "Licensed under the ISC licence. Licensed under the ISC License!", "Subject to the terms of the Mozilla Public License, v. 2.0",
]


def test_index_against_every_alignment(docs):
    texts = [*PLANTED, *(t for _, t in ROWS), *(f"words before {' '.join(passages)} and {must[-1]} after" for must, passages in TEMPLATES.values())]
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(docs(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == verdicts(texts)
    # Edited notices are found by the index, and phrases without a notice are not; a phrase search says the same of all of them.
    assert got[0][0] == got[1][0] == "mit" and 0.6 < got[0][1] < 1
    assert all(got[i][0] == "" and got[i][1] < L.ALIGNED for i in (2, 3, 5, 7)) and 0 < got[3][1]
    holds = lambda t, label: any(f" {p} " in f" {' '.join(words_of(t))} " for p in TEMPLATES[label][0])
    assert all(holds(PLANTED[i], label) for i, label in ((2, "mit"), (3, "mit"), (5, "gpl-3"), (7, "mit")))


def test_empty_table_and_query(spark, docs):
    assert scan_licenses(docs([])).count() == 0
    sf = "/root/testdata/sf0.001"
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op7_licenses(spark, sf).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])


def test_no_python_in_the_plan(spark):
    plan = op7_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

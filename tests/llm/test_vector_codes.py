"""Codes against a brute-force k-means on integers; the transform; exact early elimination."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillrecon.llm import vector_codes as v


def brute(rows, parts, entries, rounds):
    """rows (vec_id, vector) -> {place: (code, error)}, codebooks."""
    fine = [(i, x) for i, x in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * c) for c in x] for _, x in fine]
    width = len(whole[0]) // parts
    cut = [[x[p * width : (p + 1) * width] for x in whole] for p in range(parts)]
    books = [c[:entries] for c in cut]

    def assigned(p):
        found = []
        for x in cut[p]:
            d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        for p in range(parts):
            now = assigned(p)
            for e in range(len(books[p])):
                own = [x for x, (k, _) in zip(cut[p], now, strict=True) if k == e]
                if own:
                    books[p] = [*books[p][:e], [sum(c) // len(own) for c in zip(*own, strict=True)], *books[p][e + 1 :]]
    last = [assigned(p) for p in range(parts)]
    return [(i, "".join(f"{last[p][n][0]:02x}" for p in range(parts)), sum(last[p][n][1] for p in range(parts))) for n, (i, _) in enumerate(fine)], books


def vectors(spark, rows):
    return v.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, `c0` string, code string, vector int")).select("vec_id", F.col("embedding").alias("vector"))


def made(seed, n, dim, scale=1.0):
    rng = random.Random(seed)
    return [float(np.float32(rng.gauss(0, scale))) for _ in range(dim)]


@pytest.mark.parametrize("dim,parts,entries,scale", [(12, 4, 5, 1.0), (20, 4, 7, 0.3), (16, 16, 3, 5.0), (8, 2, 4, 1e6)])
def test_against_brute_force(spark, dim, parts, entries, scale):
    rows = [(n, made(n, 1, dim, scale)) for n in range(90)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, None), (200, [*rows[0][1][:-1], None]), (201, [float("nan")] + rows[0][1][1:]), (202, [float("inf")] + rows[0][1][1:])]
    rows += [(300 + n, [0.5] * dim) for n in range(20)]  # ties and copies
    random.Random(1).shuffle(rows)
    given = vectors(spark, [(i, x, "c", "d", 1) for i, x in rows])
    books, d = v.fit(given, parts, entries, 2)
    want, want_books = brute(rows, parts, entries, 2)
    assert books == want_books and d == dim
    got = [(r.vec_id, r.code, r.error) for r in v.encode(given, books, d).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    for _, code, error in got[:5]:
        assert len(v.decode(code, books)) == dim


@pytest.mark.parametrize("d", [1, 2, 3, 4, 7, 16])
def test_transform_keeps_distances(d):
    rng = np.random.default_rng(d)
    x, c = rng.integers(-500, 500, (300, d)), rng.integers(-500, 500, (40, d))
    h = v.sequency(1 << (d - 1).bit_length())
    changes = (h[:, 1:] != h[:, :-1]).sum(axis=1)
    assert (changes == np.arange(len(h))).all() and (h @ h.T == len(h) * np.eye(len(h))).all()
    c[5] = c[3]  # a tie goes to the smaller index
    x[:20] = c[rng.integers(0, 40, 20)]
    whole = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    for k in (0, 1, 2, 99):
        entry, distance = v.nearest(x, c, k)
        assert (entry == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
        assert 5 not in entry


def test_few_rows_none_and_wrong_lengths(spark):
    few = vectors(spark, [(1, [1.0] * 16, "", "", 0), (2, [-1.0] * 16, "", "", 0)])
    books, dim = v.fit(few)
    assert {(r.vec_id, r.code, r.error) for r in v.encode(few, books, dim).collect()} == {(1, "00" * 16, 0), (2, "01" * 16, 0)}
    none = vectors(spark, [])
    books, dim = v.fit(none)
    assert dim == 0 and v.encode(none, books, dim).count() == 0 and v.digest(books) == hashlib.sha256(b"").hexdigest()
    for bad in ([1.0] * 15, []):
        with pytest.raises(ValueError, match="one length"):
            v.fit(vectors(spark, [(1, bad, "", "", 0)]))
    with pytest.raises(ValueError, match="one length"):
        v.fit(vectors(spark, [(1, [1.0] * 16, "", "", 0), (2, [1.0] * 32, "", "", 0)]))


def test_labels_meet_with_nulls(spark, tmp_path):
    rows = [(n, made(n, 1, 16), None if n % 3 == 0 else n % 4) for n in range(80)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    out = v.op12_codes(spark, str(tmp_path)).collect()
    error = {r.vec_id: r.error for r in out}
    label = {n: k for n, _, k in rows}
    for r in out:
        assert r.label_error == sum(e for n, e in error.items() if label[n] == label[r.vec_id])
    assert len(out) == 80

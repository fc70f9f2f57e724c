import random

from tillrecon.operators import checks, ordering


def rows(n=4000, seed=3):
    """Groups of very different size, most rows in one; order keys repeat, ids break ties."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", "z", None])
        key = "same" if rng.random() < 0.4 else f"{rng.randrange(500):04d}"
        value = rng.choice([None, None, f"{rng.randrange(99):03d}", " ", "x1"])
        out.append((group, key, i, value))
    return out


def expected(data, step):
    """``step`` over each group in order, by brute force."""
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[1], r[2]))
        out.update(step(members))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "shop string, k string, id long, v string").repartition(5)


def test_previous_fill_number(spark):
    data = rows()
    df = frame(spark, data)
    for chunks in (1, 7, 40):
        previous = ordering.previous_in_order(df, ("shop",), ("k", "id"), "v", "p", chunks).collect()
        assert {r.id: r.p for r in previous} == expected(
            data, lambda m: {b[2]: (a[3] if a else None) for a, b in zip([None, *m], m)}
        )

        def filled(members):
            last, out = None, {}
            for r in members:
                last = r[3] if r[3] is not None else last
                out[r[2]] = last
            return out

        down = ordering.fill_down(df, ("shop",), ("k", "id"), "v", "f", chunks).collect()
        assert {r.id: r.f for r in down} == expected(data, filled)
        numbered = ordering.number_in_order(df, ("shop",), ("k", "id"), "n", chunks).collect()
        assert {r.id: r.n for r in numbered} == expected(
            data, lambda m: {r[2]: i for i, r in enumerate(m, 1)}
        )


def test_fill_down_crosses_chunks_without_any_value(spark):
    data = [("s", f"{i:05d}", i, "first" if i == 0 else None) for i in range(500)]
    down = ordering.fill_down(frame(spark, data), ("shop",), ("k", "id"), "v", "f", 20).collect()
    assert {r.f for r in down} == {"first"} and len(down) == 500


def test_the_hot_group_is_spread_over_chunks(spark):
    laid = ordering.lay_out(frame(spark, rows()), ("shop",), ("k", "id"), 16)
    sizes = {r[0]: r[1] for r in laid.groupBy(ordering.CHUNK).count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 3 * 4000 / 16


def test_numbering_does_not_move_the_stored_rows(spark):
    numbered = ordering.number_in_order(frame(spark, rows()), ("shop",), ("k", "id"), "n", 7)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan


def test_windows_read_the_stored_rows_where_they_lie(spark):
    """No exchange of stored rows: what is moved are summaries, after their sums."""
    df = frame(spark, rows())
    for found in (
        ordering.previous_in_order(df, ("shop",), ("k", "id"), "v", "p", 7),
        ordering.fill_down(df, ("shop",), ("k", "id"), "v", "f", 7),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 2
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                assert "Aggregate" in "".join(lines[i + 1 : i + 3]), plan


def test_chunks_follow_the_bytes(spark, monkeypatch):
    df = frame(spark, rows())
    count = lambda: len(ordering.lay_out(df, ("shop",), ("k", "id")).select(ordering.CHUNK).distinct().collect())
    assert count() == ordering.LEAST_CHUNKS
    monkeypatch.setattr(ordering, "CHUNK_BYTES", 1000)
    assert count() > 20


def test_sequence_gaps(spark):
    data = [
        ("A", "001", "0035", 1), ("A", "002", "0036", 2), ("A", "003", " ", 3), ("A", "004", "0040", 4),
        ("A", "005", "x", 5), ("A", "006", "0042", 6), ("A", "007", "0050", 7), ("B", "001", "0010", 8),
        ("B", "002", None, 9), ("B", "003", "0011", 10),
    ]
    df = spark.createDataFrame(data, "shop string, internal_no string, ticket_no string, block_id long")
    gaps = checks.sequence_gaps(df, columns=("internal_no", "ticket_no"), chunks=3).collect()
    found = {(r.shop, r.internal_no): r.gap for r in gaps}
    assert {k: v for k, v in found.items() if v is not None} == {("A", "002"): 1, ("A", "007"): 8}
    assert len(found) == 10

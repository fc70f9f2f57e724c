"""Suffix-array dedup by prefix-free parsing.

Every byte that a repeated string of ``window`` bytes covers is removed, wherever the other occurrence is.

1. Routing: the smallest rolling hash of ``GRAM`` bytes in each window is an anchor, so equal windows have
   equal anchors. Anchors that occur once cannot lie in a repeated window. The others are labelled with a
   shard by their first occurrence (document and stretch of it), and the bytes within their reach are cut out.
2. Equal pieces of a shard become one with a count: what is repeated as a whole is settled and sorted once.
3. Per shard, prefix-free parsing: the text is cut into phrases wherever a rolling hash triggers, each
   overlapping the next one by the trigger. The distinct phrases are the dictionary, their sequence the parse.
   A suffix array of the dictionary (prefix doubling over what is still tied) and one of the parse (doubling
   over phrase ranks) combine into the order of all places: by the suffix of the phrase, which is never
   the prefix of another, then by the rank of the parse behind it.
4. In this order equal strings are neighbours: a window that equals its neighbour is repeated.

A shard whose text exceeds ``PASS_BYTES`` is sorted in passes, each with the places around one class of
anchors; equal windows have equal anchors and meet in one pass. One pass holds at least the distinct
surroundings of a single anchor.

Defined cases: a null or empty text has no bytes; rows are documents of their own, whatever their ids, so equal rows
repeat each other; rows of the same id and text get the same result. A text of any length is read whole, its hashes in
blocks; equal strings are removed wherever they are, so ties cannot occur; an empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import (
    _BACK,
    _BYTE,
    _STEP,
    Buffer,
    _powers,
    merge_ranges,
    mix,
    rolling,
    rows_of,
    signed,
    sliding,
    span_hashes,
    stage,
    unstage,
)

GRAM = 32
#: Trigger of the parse: bytes hashed, and one place in so many triggers.
TRIGGER, PHRASE = 16, 64
SHARD_DOCS, STRETCH, PASS_BYTES = 512, 1 << 16, 3 << 19
_NO_ID = -(2**63)


def _raw(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def anchors(raw: np.ndarray, window: int, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the smallest gram of each window."""
    width, places, hashes = window - GRAM + 1, [], []
    low = np.zeros(width - 1, np.uint64)
    for start in range(0, len(raw) - window + 1, block):
        part = raw[start : start + block + window - 1]
        grams = rolling(_BYTE[part], GRAM)
        least = sliding(grams, width, np.minimum)
        top = sliding(np.concatenate((low, least, low)), width, np.maximum)
        at = np.flatnonzero(grams == top)
        # Of a run of one gram (a repeated byte) the ends and some places between them do.
        if len(at) > 2:
            inner = (at[1:-1] - at[:-2] == 1) & (at[2:] - at[1:-1] == 1) & (grams[at[1:-1]] == grams[at[:-2]]) & (grams[at[1:-1]] == grams[at[2:]])
            at = at[np.concatenate(([True], ~inner | (at[1:-1] % 128 == 0), [True]))]
        places.append(at + start)
        hashes.append(grams[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


def _find_anchors(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("anchor", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for doc_id, fp, text in rows_of(batch):
                at, found = anchors(_raw(text.encode()), window)
                for column, value in zip(columns, (np.full(len(at), doc_id, np.int64), np.full(len(at), fp, np.int64), signed(found), at.astype(np.int32)), strict=True):
                    column.append(value)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], schema=schema)

    return run


def _cut_pieces(window: int):
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("first", pa.int32()), ("piece", pa.binary())])

    def run(batches):
        for batch in batches:
            out = Buffer(schema, 4 << 20)
            for doc_id, fp, text, at, shards in rows_of(batch):
                data, at, shards = text.encode(), np.array(at), np.array(shards)
                for shard in np.unique(shards):
                    here = at[shards == shard]
                    low, high = np.maximum(here + GRAM - window, 0), np.minimum(here + window, len(data))
                    for a, b in merge_ranges(low.tolist(), high.tolist()):
                        out.add(int(shard), doc_id, fp, a, data[a:b], weight=b - a)
                    if out.full():
                        yield out.take()
            yield out.take()

    return run


# ---------------------------------------------------------------- prefix-free parsing


def _ranks(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank of each element among the distinct keys): equal keys have equal ranks."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    # Ranks are the places of a group's first element, so that a group can be refined within its places.
    group = np.maximum.accumulate(np.where(new, np.arange(len(order), dtype=np.int32), 0))
    rank = np.empty(len(order), np.int32)
    rank[order] = group
    return order, rank


def suffix_ranks(symbols: np.ndarray, left: np.ndarray, most: int | None = None) -> np.ndarray:
    """Rank of the suffix at each place, which ends ``left`` symbols on; equal suffixes share a rank.

    Prefix doubling: after each round only suffixes that are still tied are sorted again. ``most``: symbols
    after which ties may stay.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    if symbols.dtype == np.uint8:
        key, span = np.zeros(n, np.uint64), 8
        wide = np.concatenate((symbols, np.zeros(8, np.uint8)))
        for k in range(8):
            key <<= np.uint64(8)
            key |= wide[k : k + n] * (left > k)
    else:
        key, span = symbols, 1
    _, rank = _ranks((key,))
    tied = np.arange(n)
    while len(tied) and (most is None or span < most):
        # Tied: another suffix has the rank, and both go on.
        count = np.bincount(rank[tied], minlength=n)
        tied = tied[(count[rank[tied]] > 1) & (left[tied] > span)]
        if not len(tied):
            break
        behind = rank[tied + span] + 1
        order = np.lexsort((behind, rank[tied]))
        a, b = rank[tied][order], behind[order]
        head = np.concatenate(([True], a[1:] != a[:-1]))
        start = np.maximum.accumulate(np.where(head, np.arange(len(a)), 0))
        fresh = head | np.concatenate(([True], b[1:] != b[:-1]))
        # Suffixes of the group that ended earlier keep its first places.
        ended = count[a] - np.bincount(a, minlength=n)[a]
        group = np.maximum.accumulate(np.where(fresh, np.arange(len(a)), 0))
        rank[tied[order]] = a + ended + (group - start)
        span *= 2
    return rank


def corpus_order(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place, order) of all places of the pieces; ``order`` sorts them as suffixes of their piece.

    Places whose suffixes agree in 512 phrases may stay in any order.
    """
    # Each piece is closed by a trigger of its own that no text has.
    close = np.zeros(TRIGGER, np.uint8)
    length = np.array([len(p) for p in pieces], np.int64)
    offset = np.concatenate(([0], np.cumsum(length + TRIGGER)))
    text = np.concatenate([x for p in pieces for x in (_raw(p), close)])
    value = _BYTE[text]
    value[np.repeat(offset[:-1] + length, TRIGGER) + np.tile(np.arange(TRIGGER), len(pieces))] = np.uint64(12345)

    # Triggers: where a piece begins or is closed, and wherever the rolling hash says so.
    hashes = rolling(value, TRIGGER)
    is_trigger = np.zeros(len(text), bool)
    is_trigger[: len(hashes)] = hashes % np.uint64(PHRASE) == 0
    for k in range(1, TRIGGER):  # not across the close
        is_trigger[offset[:-1] + length + k] = False
        cross = offset[:-1] + length - k
        is_trigger[cross[length >= k]] = False
    is_trigger[offset[:-1]] = is_trigger[offset[:-1] + length] = True
    starts = np.flatnonzero(is_trigger)
    closing = np.zeros(len(text), bool)
    closing[offset[:-1] + length] = True
    nexts = np.concatenate((starts[1:], [0]))
    phrase = ~closing[starts]  # what follows a close belongs to the next piece
    begin, end = starts[phrase], nexts[phrase] + TRIGGER

    # Dictionary: distinct phrases; closed ones differ from all others by their close.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * _powers(_STEP, len(value)), dtype=np.uint64)))
    name = mix((sums[end] - sums[begin]) * _powers(_BACK, len(value))[begin] + (end - begin).astype(np.uint64))
    _, first, word = np.unique(name, return_index=True, return_inverse=True)
    size = (end - begin)[first]
    base = np.concatenate(([0], np.cumsum(size)))
    inside = np.arange(base[-1], dtype=np.int32) - np.repeat(base[:-1].astype(np.int32), size)
    source = np.repeat(begin[first].astype(np.int32), size) + inside
    left = np.repeat(size.astype(np.int32), size) - inside
    letters = text[source].astype(np.int16) + 1
    letters[value[source] == np.uint64(12345)] = 0
    del hashes, is_trigger, closing, sums, value, text, inside, source
    ranks = suffix_ranks(letters if letters.max(initial=0) > 255 else letters.astype(np.uint8), left)

    # Parse: ranks of the phrases in a row, up to the close of the piece.
    rank_of_phrase = ranks[base[:-1]][word]
    piece_of = np.searchsorted(offset, begin, side="right") - 1
    last = np.searchsorted(piece_of, piece_of, side="right")
    parse = suffix_ranks(rank_of_phrase, last - np.arange(len(word)), most=512)

    # A place: the suffix of its phrase, then the rank of the parse behind the phrase.
    width = end - begin - TRIGGER
    phrase_of = np.repeat(np.arange(len(begin), dtype=np.int32), width)
    shift = np.arange(int(width.sum()), dtype=np.int32) - np.repeat((np.cumsum(width) - width).astype(np.int32), width)
    place = begin.astype(np.int32)[phrase_of] + shift
    behind = np.where(np.arange(len(word)) + 1 < last, np.concatenate((parse[1:], [0])) + 1, 0).astype(np.int64)
    key = ranks[base[:-1][word].astype(np.int32)[phrase_of] + shift].astype(np.int64) << 32
    key |= behind[phrase_of]
    piece = piece_of.astype(np.int32)[phrase_of]
    return piece, place - offset.astype(np.int32)[piece], np.argsort(key, kind="stable")


def repeated_places(pieces: list[bytes], window: int) -> list[np.ndarray]:
    """For each piece: where repeated windows start. Pieces of less than a window have none."""
    out = [np.zeros(0, np.int64)] * len(pieces)
    if not pieces:
        return out
    piece, place, order = corpus_order(pieces)
    length = np.array([len(p) for p in pieces], np.int64)
    order = order[place[order] + window <= length[piece[order]]]
    if len(order) < 2:
        return out
    rolled = [rolling(_BYTE[_raw(p)], window) for p in pieces]
    at = np.concatenate(([0], np.cumsum([len(r) for r in rolled])))
    value = np.concatenate(rolled)[at[piece[order]] + place[order]]
    same = value[1:] == value[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    piece, place = piece[order][twice], place[order][twice]
    by_piece = np.lexsort((place, piece))
    piece, place = piece[by_piece], place[by_piece]
    edges = np.searchsorted(piece, np.arange(len(pieces) + 1))
    return [place[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _runs(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Bytes that windows at these ascending starts cover."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > window)
    return [(int(starts[i]), int(starts[j]) + window) for i, j in zip([0, *(cuts + 1)], [*cuts, len(starts) - 1], strict=True)]


def shard_ranges(pieces: list[bytes], counts: list[int], window: int, pass_bytes: int = PASS_BYTES) -> list[list[tuple[int, int]]]:
    """Repeated bytes of each distinct piece of a shard; pieces that occur more than once are repeated whole."""
    total = sum(map(len, pieces))
    if total <= pass_bytes:
        found = repeated_places(pieces, window)
    else:
        passes = -(-3 * total // pass_bytes)
        found_in: list[list[np.ndarray]] = [[] for _ in pieces]
        marks = [anchors(_raw(p), window) for p in pieces]
        for k in range(passes):
            # Equal surroundings are sorted once; with two occurrences they are repeated as a whole.
            where: dict[bytes, list[tuple[int, int]]] = {}
            for i, (at, hashes) in enumerate(marks):
                here = at[hashes % np.uint64(passes) == np.uint64(k)]
                low, high = np.maximum(here + GRAM - window, 0), np.minimum(here + window, len(pieces[i]))
                for a, b in merge_ranges(low.tolist(), high.tolist()):
                    where.setdefault(pieces[i][a:b], []).append((i, a))
            texts = list(where)
            for text, places in zip(texts, repeated_places(texts, window), strict=True):
                if len(where[text]) > 1:
                    places = np.arange(len(text) - window + 1)
                for i, a in where[text]:
                    found_in[i].append(places + a)
        found = [np.unique(np.concatenate(f)) if f else np.zeros(0, np.int64) for f in found_in]
    return [[(0, len(p))] if c > 1 and len(p) >= window else _runs(f, window) for p, c, f in zip(pieces, counts, found, strict=True)]


def _sort_shards(window: int):
    """Rows (shard, h1, h2, count, piece), by shard -> the repeated bytes of each piece."""
    span = pa.struct([("a", pa.int32()), ("b", pa.int32())])
    schema = pa.schema([("shard", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("spans", pa.list_(span))])

    def run(batches):
        out, key, held = Buffer(schema), None, []

        def close():
            spans = shard_ranges([h[3] for h in held], [h[2] for h in held], window)
            for (h1, h2, _, _), s in zip(held, spans, strict=True):
                if s:
                    out.add(key, h1, h2, [{"a": a, "b": b} for a, b in s], weight=len(s))

        for batch in batches:
            for shard, h1, h2, n, piece in rows_of(batch):
                if shard != key:
                    close()
                    key, held = shard, []
                    if out.full():
                        yield out.take()
                held.append((h1, h2, n, piece))
        close()
        yield out.take()

    return run


def _keep(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for batch in batches:
        out = Buffer(schema, 4 << 20)
        for doc_id, text, ranges in rows_of(batch):
            data = (text or "").encode()
            merged = merge_ranges([r["a"] for r in ranges], [r["b"] for r in ranges]) if ranges else []
            edges = [0, *[x for ab in merged for x in ab], len(data)]
            kept = b"".join([data[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True)]) if merged else data
            out.add(doc_id, len(data), len(data) - len(kept), len(merged), kept, weight=len(kept))
            if out.full():
                yield out.take()
        yield out.take()


def remove_repeated_bytes(docs: DataFrame, window: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) of every row of ``docs`` (doc_id, text)."""
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(_NO_ID)).alias("doc_id"), F.xxhash64("text").alias("fp"), "text")
    some = texts.where("text is not null")
    shards = max(1, -(-some.count() // SHARD_DOCS))

    places = stage(some.mapInArrow(_find_anchors(window), "doc_id long, fp long, anchor long, at int"), "anchors")
    first = F.min(F.struct("doc_id", F.floor(F.col("at") / STRETCH).alias("s")))
    homes = places.groupBy("anchor").agg(F.count("*").alias("n"), first.alias("home")).where("n > 1")
    homes = stage(homes.select("anchor", F.pmod(F.xxhash64("home"), F.lit(shards)).cast("int").alias("shard")), "homes")
    reach = places.join(homes, "anchor").groupBy("doc_id", "fp").agg(F.collect_set(F.struct("at", "shard")).alias("p"))
    reach = stage(reach, "reach")
    unstage(places, homes)
    cut = some.join(reach, ["doc_id", "fp"]).select("doc_id", "fp", "text", "p.at", "p.shard")
    pieces = cut.mapInArrow(_cut_pieces(window), "shard int, doc_id long, fp long, first int, piece binary")
    pieces = stage(pieces.withColumn("h1", F.xxhash64("piece")).withColumn("h2", F.hash("piece").cast("long")), "pieces")
    unstage(reach)

    distinct = pieces.groupBy("shard", "h1", "h2").agg(F.count("*").alias("n"), F.min("piece").alias("piece"))
    ordered = distinct.select("shard", "h1", "h2", "n", "piece").repartition("shard").sortWithinPartitions("shard", "h1", "h2")
    spans = ordered.mapInArrow(_sort_shards(window), "shard int, h1 long, h2 long, spans array<struct<a:int,b:int>>")
    spans = stage(spans, "spans")
    found = pieces.select("shard", "h1", "h2", "doc_id", "fp", "first").join(spans, ["shard", "h1", "h2"])
    moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("first")).alias("a"), (s["b"] + F.col("first")).alias("b")))
    ranges = found.select("doc_id", "fp", moved.alias("spans")).groupBy("doc_id", "fp").agg(F.flatten(F.collect_list("spans")).alias("ranges"))
    ranges = stage(ranges, "ranges")
    unstage(pieces, spans)
    out = texts.join(ranges, ["doc_id", "fp"], "left").select("doc_id", "text", "ranges")
    out = out.mapInArrow(_keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    # What is left as text: a character that a cut goes through shows as U+FFFD.
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text)

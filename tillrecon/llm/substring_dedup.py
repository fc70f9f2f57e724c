"""Substring dedup with repeated-phrase automata.

1. Winnowing: in every window of ``window`` words the smallest hash of ``gram`` consecutive words is an
   anchor, so equal windows have equal anchors. An aggregation keeps the anchors of two or more documents;
   the smallest of these is the anchor's home.
2. Regions: the words within reach of such anchors, cut from their documents and labelled with the shard
   of the anchors' homes. Copies of a text meet in the shard of its first document.
3. Confirmation: windows of the regions are hashed and aggregated; those of two or more documents recur.
   Runs of recurring windows in their first document are the passages.
4. Automata: each shard compiles Aho-Corasick automata (pyahocorasick) from phrases of its passages, over
   an alphabet of words, and streams its regions through them. A phrase recurs at least once in every
   window, so that no occurrence is missed; the windows around each one are held against the passages'
   windows, and those of an earlier document mark their words.

A shard that many documents reach is salted: its passages go to each salt, its regions to one. Nothing is
gathered but one shard's passages (a share of some 16,000 documents' recurring text) and one region.

Defined cases: a null or empty text has no words; a row without an id is neither compared nor changed;
rows with the same id and text are one document; texts of one id never remove each other's words. Ties
cannot occur: the smallest id keeps a passage. A text of any length is read whole, its hashes in blocks of bounded size;
an empty table has no rows. Columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillrecon.llm.common import Buffer, merge_ranges, rolling, rows_of, signed, sliding, span_hashes, stage, unstage, words_of

#: Documents of a shard, and bytes of regions that one salt of a shard streams.
SHARD_DOCS, SALT_BYTES = 16_384, 32 << 20
#: Words of passages in one automaton: bounds its memory and its alphabet.
AUTOMATON_WORDS = 1_000_000


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _anchors(window: int, gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("anchor", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps, anchors, places = [], [], [], []
            for doc_id, fp, text in rows_of(batch):
                raw = _raw(text)
                hashes = span_hashes(raw, *words_of(raw))
                if len(hashes) < window:
                    continue
                grams = rolling(hashes, gram)
                width = window - gram + 1
                least = sliding(grams, width, np.minimum)
                low = np.zeros(width - 1, np.uint64)
                top = sliding(np.concatenate((low, least, low)), width, np.maximum)
                at = np.flatnonzero(grams == top)
                ids.append(np.full(len(at), doc_id, np.int64))
                fps.append(np.full(len(at), fp, np.int64))
                anchors.append(signed(grams[at]))
                places.append(at.astype(np.int32))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, fps, anchors, places)], schema=schema)

    return run


def _regions(window: int, gram: int):
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("first", pa.int32()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            out = Buffer(schema, 4 << 20)
            for doc_id, fp, text, at, shards in rows_of(batch):
                data = text.encode()
                raw = np.frombuffer(data, np.uint8)
                starts, ends = words_of(raw)
                at, shards = np.array(at), np.array(shards)
                for shard in np.unique(shards):
                    here = at[shards == shard]
                    low = np.maximum(here + gram - window, 0)
                    high = np.minimum(here + window, len(starts))
                    for a, b in merge_ranges(low.tolist(), high.tolist()):
                        if b - a >= window:
                            piece = data[starts[a] : ends[b - 1]]
                            out.add(int(shard), doc_id, fp, a, piece.decode(), weight=len(piece))
                    if out.full():
                        yield out.take()
            yield out.take()

    return run


def _windows(window: int, flush: int = 2_000_000):
    """Window hashes with their smallest and largest document, combined before they leave the task."""
    schema = pa.schema([("w", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])

    def combined(hashes, ids):
        h, d = np.concatenate(hashes), np.concatenate(ids)
        order = np.argsort(h)
        h, d = h[order], d[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        for i in range(0, len(first), 100_000):
            part = first[i : i + 100_000]
            end = first[i + 100_000] if i + 100_000 < len(first) else len(h)
            lows, highs = (f.reduceat(d[part[0] : end], part - part[0]) for f in (np.minimum, np.maximum))
            yield pa.RecordBatch.from_arrays([pa.array(signed(h[part])), pa.array(lows), pa.array(highs)], schema=schema)

    def run(batches):
        hashes, ids, held = [], [], 0
        for batch in batches:
            for doc_id, text in rows_of(batch):
                raw = _raw(text)
                got = rolling(span_hashes(raw, *words_of(raw)), window)
                hashes.append(got)
                ids.append(np.full(len(got), doc_id, np.int64))
                held += len(got)
                if held > flush:
                    yield from combined(hashes, ids)
                    hashes, ids, held = [], [], 0
        if held:
            yield from combined(hashes, ids)

    return run


def _passages(window: int):
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            out = Buffer(schema, 4 << 20)
            for shard, doc_id, text, recurring in rows_of(batch):
                data = text.encode()
                raw = np.frombuffer(data, np.uint8)
                starts, ends = words_of(raw)
                got = signed(rolling(span_hashes(raw, starts, ends), window))
                at = np.flatnonzero(np.isin(got, np.array(recurring, np.int64)))
                # Windows side by side make one passage.
                cuts = np.flatnonzero(np.diff(at) > 1)
                for i, j in zip([0, *(cuts + 1)], [*cuts, len(at) - 1], strict=True) if len(at) else ():
                    piece = data[starts[at[i]] : ends[at[j] + window - 1]]
                    out.add(shard, doc_id, piece.decode(), weight=len(piece))
                if out.full():
                    yield out.take()
            yield out.take()

    return run


class Automaton:
    """Finds in a text the windows of passages that belong to an earlier document."""

    def __init__(self, passages: list[tuple[int, np.ndarray]], window: int, phrase: int):
        """passages: (document, word hashes). Phrases of ``phrase`` words begin every window - phrase + 1 words."""
        self.window, self.phrase = window, phrase
        self.words = np.unique(np.concatenate([h for _, h in passages]))
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        windows, owners = [], []
        for doc_id, hashes in passages:
            line = self._line(hashes)
            for i in range(0, len(line) - phrase + 1, window - phrase + 1):
                self.trie.add_word(line[i : i + phrase])
            windows.append(rolling(hashes, window))
            owners.append(np.full(len(windows[-1]), doc_id, np.int64))
        self.trie.make_automaton()
        every, owner = np.concatenate(windows), np.concatenate(owners)
        order = np.lexsort((owner, every))
        every, owner = every[order], owner[order]
        new = np.concatenate(([True], every[1:] != every[:-1]))
        self.every, self.owner = every[new], owner[new]

    def _line(self, hashes: np.ndarray) -> str:
        """One character a word; words of no passage share one that no phrase has."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        code = np.where(self.words[at] == hashes, at + 1, 0)
        code = (code + np.where(code >= 0xD800, 0x800, 0)).astype("<u4")  # surrogates are no characters
        return code.tobytes().decode("utf-32-le")

    def earlier(self, doc_id: int, hashes: np.ndarray) -> np.ndarray:
        """Starts of the windows that an earlier document holds."""
        ends = np.fromiter((e for e, _ in self.trie.iter(self._line(hashes))), np.int64)
        total = len(hashes) - self.window + 1
        if not len(ends) or total <= 0:
            return ends[:0]
        # A window holds a phrase that ends at e if it starts in e - window + 1 .. e - phrase + 1.
        step = np.zeros(total + 1, np.int64)
        np.add.at(step, np.clip(ends - self.window + 1, 0, total), 1)
        np.add.at(step, np.clip(ends - self.phrase + 2, 0, total), -1)
        near = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        mine = rolling(hashes, self.window)[near]
        at = np.minimum(np.searchsorted(self.every, mine), len(self.every) - 1)
        return near[(self.every[at] == mine) & (self.owner[at] < doc_id)]


def _locate(window: int, phrase: int):
    """Rows come by shard and salt, passages before regions."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches):
        out, key, held, size, automata = Buffer(schema), None, [], 0, []

        def compiled():
            nonlocal held, size
            if held:
                automata.append(Automaton(held, window, phrase))
                held, size = [], 0

        for batch in batches:
            for shard, salt, kind, doc_id, fp, first, text in rows_of(batch):
                if (shard, salt) != key:
                    key, held, size, automata = (shard, salt), [], 0, []
                raw = _raw(text)
                hashes = span_hashes(raw, *words_of(raw))
                if not kind:
                    held.append((doc_id, hashes))
                    size += len(hashes)
                    if size >= AUTOMATON_WORDS:
                        compiled()
                    continue
                compiled()
                found = np.concatenate([a.earlier(doc_id, hashes) for a in automata]) if automata else ()
                if len(found):
                    found = np.unique(found)
                    cuts = np.flatnonzero(np.diff(found) > window)
                    for i, j in zip([0, *(cuts + 1)], [*cuts, len(found) - 1], strict=True):
                        out.add(doc_id, fp, int(first + found[i]), int(first + found[j] + window))
                if out.full():
                    yield out.take()
        yield out.take()

    return run


def repeated_ranges(docs: DataFrame, window: int = 50, gram: int = 16, phrase: int = 12) -> DataFrame:
    """(doc_id, fp, ranges of words) for the documents with words to remove; fp is ``xxhash64(text)``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"), "text").where("doc_id is not null and text is not null")
    shards = max(1, -(-texts.count() // SHARD_DOCS))

    places = stage(texts.mapInArrow(_anchors(window, gram), "doc_id long, fp long, anchor long, at int"), "anchors")
    homes = places.groupBy("anchor").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).where("home < last")
    # Written first, so that both sides of the join are plain exchanges and a frequent anchor can be split.
    homes = stage(homes.select("anchor", F.pmod(F.xxhash64("home"), F.lit(shards)).cast("int").alias("shard")), "homes")
    reach = places.join(homes, "anchor").groupBy("doc_id", "fp").agg(F.collect_list(F.struct("at", "shard")).alias("p"))
    reach = stage(reach, "reach")
    unstage(places, homes)
    cut = texts.join(reach, ["doc_id", "fp"]).select("doc_id", "fp", "text", "p.at", "p.shard")
    regions = stage(cut.mapInArrow(_regions(window, gram), "shard int, doc_id long, fp long, first int, text string"), "regions")
    unstage(reach)

    windows = regions.select("doc_id", "text").mapInArrow(_windows(window), "w long, lo long, hi long")
    windows = windows.groupBy("w").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("lo", "w")
    windows = stage(windows, "windows")
    by_home = windows.groupBy(F.col("lo").alias("doc_id")).agg(F.collect_list("w").alias("recurring"))
    passages = regions.join(by_home, "doc_id").select("shard", "doc_id", "text", "recurring")
    passages = stage(passages.mapInArrow(_passages(window), "shard int, doc_id long, text string").distinct(), "passages")
    unstage(windows)

    salts = regions.groupBy("shard").agg((F.sum(F.length("text")) / SALT_BYTES + 1).cast("int").alias("salts"))
    salts = stage(salts, "salts")
    one = passages.join(salts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "doc_id", F.lit(0).cast("long").alias("fp"), F.lit(0).alias("first"), "text"
    )
    two = regions.join(salts, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id", "first"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), "doc_id", "fp", "first", "text"
    )
    ordered = one.union(two).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    found = ordered.mapInArrow(_locate(window, phrase), "doc_id long, fp long, first int, last int")
    ranges = stage(found.groupBy("doc_id", "fp").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    unstage(regions, passages, salts)
    return ranges


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """These words with one space between them."""
    if not len(starts):
        return b""
    line = np.append(raw, np.uint8(32))
    line[ends] = 32
    step = np.zeros(len(line) + 1, np.int8)
    step[starts] += 1
    step[ends + 1] -= 1
    return line[np.cumsum(step[:-1], dtype=np.int8).view(bool)].tobytes()[:-1]


def _cut(joined: bool, keep_text: bool):
    """The last two columns, text and ranges, become word counts and the remaining text; the text may stay."""
    added = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def rest(text: str | None, ranges) -> tuple[int, int, str | None, int]:
        if text is None and not joined:
            return 0, 0, None, 0
        data = (text or "").encode()
        raw = np.frombuffer(data, np.uint8)
        starts, ends = words_of(raw)
        gone = np.zeros(len(starts), bool)
        for r in ranges or ():
            gone[r["first"] : r["last"]] = True
        if joined:
            kept = _joined(raw, starts[~gone], ends[~gone])
        else:
            kept = _without(data, starts, gone) if gone.any() else data
        return len(starts), int(gone.sum()), kept.decode(), len(kept)

    def run(batches):
        for batch in batches:
            at = batch.num_columns - 2
            start, done, size = 0, [], 0
            rows = rows_of(batch.select([at, at + 1]))
            for i, (text, ranges) in enumerate(rows):
                *row, weight = rest(text, ranges)
                done.append(row)
                size += weight
                if size > 4 << 20 or i + 1 == batch.num_rows:
                    given = batch.slice(start, len(done))
                    columns = [pa.array([d[j] for d in done], f.type) for j, f in enumerate(added)]
                    stay = at + keep_text
                    yield pa.RecordBatch.from_arrays([*given.columns[:stay], *columns], names=[*given.schema.names[:stay], *added.names])
                    start, done, size = i + 1, [], 0

    return run


def _without(data: bytes, starts: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without its removed words and what separates them from the next one."""
    edges = np.concatenate((starts, [len(data)]))
    flips = np.flatnonzero(np.diff(np.concatenate(([False], ~gone, [False])).astype(np.int8)))
    return b"".join([data[edges[i] : edges[j]] for i, j in zip(flips[0::2].tolist(), flips[1::2].tolist(), strict=True)])


def remove_repeats(docs: DataFrame, window: int = 50, joined: bool = True, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed and kept, the remaining text; without ``keep_text`` it loses text.

    ``joined``: remaining words joined by one space; otherwise with their own separators, and null for a null text.
    """
    ranges = repeated_ranges(docs, window).select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), F.col("ranges").alias("_ranges"))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in names if c != "text"]).alias("row")  # the text moves once
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"), "text")
    both = rows.join(ranges, (F.col("doc_id") == F.col("_id")) & (F.col("fp") == F.col("_fp")), "left").select("row", "text", "_ranges")
    added = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType())]
    text = [both.schema["text"]] if keep_text else []
    out = both.mapInArrow(_cut(joined, keep_text), T.StructType([both.schema["row"], *text, *[T.StructField(n, t) for n, t in added]]))
    columns = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in names if keep_text or c != "text"]
    return out.select(*columns, *[n for n, _ in added])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` without passages that an earlier document has; ``n_chars`` follows the text."""
    others = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns if c != "text"]).alias("all")
    cut = remove_repeats(docs.select(others, "doc_id", "text"), joined=False, keep_text=False)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*[(new[c] if c in new else F.col("all")[c]).alias(c) for c in docs.columns])


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1 : i + 50], ' ') AS s FROM words, unnest(range(0, len(w) - 49)) AS t(i)
), firsts AS (
  SELECT s, min(doc_id) AS lo FROM windows GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM windows JOIN firsts USING (s), unnest(range(0, 50)) AS u(k) WHERE lo < doc_id
), kept AS (
  SELECT x.doc_id, x.pos, x.word FROM (
    SELECT doc_id, unnest(range(0, len(w))) AS pos, unnest(w) AS word FROM words
  ) x ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.pos = x.pos
), texts AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM kept GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN texts ON texts.doc_id = words.doc_id
"""

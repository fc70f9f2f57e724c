"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The vocabulary (a SentencePiece model, never trained here) gives pieces and scores. Over the piece lattice
of a text, the forward pass sums the weights of all segmentations up to each place; the backward pass
draws the last piece in proportion to its share of the sum, then the one before it, and so on. Draws are
hashes of the row key, the unit's place in the text and the step, so a row is segmented alike on any
executor, in any batch and on every run.

No piece has a space behind another character (a vocabulary with such pieces makes each text one unit), so
the lattice of a text is the chain of the lattices of its units (a run of spaces and what follows up to the
next one). Forward sums are kept per distinct unit; all units of a batch take their backward steps together
in numpy. A unit of more than ``UNIT_CHARS`` characters has one lattice as well: its forward sums are
logarithms, carried place by place, and its pieces are found in blocks, so that its ids are those that one
pass over it would draw.

A piece of rank r weighs (r + 1) ** -alpha: the model is a merge model whose scores are ranks. A character
that is no piece is spelt in byte pieces and counts as the rarest one. The place-holder for a space that occurs in a text itself is spelt in
bytes, therefore decoding gives the text back whatever it holds.

Defined cases: a null text gives null ids and decodes to null; an empty text gives no ids and decodes to
an empty one; rows with the same key and text are segmented alike; a null key counts as key 0. Texts of any
length are segmented in runs of bounded size; an empty table has no rows. Other columns pass; those called as an added one are replaced.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import _BACK, _STEP, _powers, mix, rows_of, through

#: Folder of the vocabulary files; a parameter of every function.
TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
#: Longer units are drawn one after the other, with logarithms; BLOCK characters of them at a time.
UNIT_CHARS, BLOCK = 64, 1 << 15
#: Distinct units whose lattices a task keeps; beyond it the store is emptied.
UNITS_KEPT = 100_000
_SPACE = "▁"


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []  # what a piece decodes to
        self.pieces: dict[str, int] = {}
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(_SPACE, " ").encode())
                self.pieces[piece.replace(_SPACE, " ")] = i
        self.size = len(self.bytes_of)
        #: Whether a piece goes on from another character to a space; if none does, units end before spaces.
        self.crosses = any(re.search("[^ ] ", p) for p in self.pieces)
        self.longest = max(map(len, self.pieces))
        #: length -> which leading bits occur, hashes ascending, ids, characters of the pieces of that length
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        for n in sorted({len(p) for p in self.pieces}):
            some = [p for p in self.pieces if len(p) == n]
            spelt = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = (mix(spelt.astype(np.uint64) + np.uint64(1)) * _powers(_STEP, n)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            seen = np.zeros(1 << 20, bool)
            seen[hashes >> np.uint64(44)] = True
            self.by_length[n] = (seen, hashes[order], np.array([self.pieces[p] for p in some])[order], spelt[order])


    def arcs(self, chars: np.ndarray, ends_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, width, piece) of every piece that stands in ``chars`` and ends before ``ends_at`` of its start.

        A character that is no piece has the piece -1 less its code.
        """
        sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * _powers(_STEP, len(chars)), out=sums[1:])
        start, back = np.arange(len(chars)), _powers(_BACK, len(chars))
        at, width, piece = [], [], []
        for n, (seen, hashes, ids, spelt) in self.by_length.items():
            here = start if n == 1 else start[start + n <= ends_at]
            h = (sums[here + n] - sums[here]) * back[here]
            some = np.flatnonzero(seen[h >> np.uint64(44)])
            here, h = here[some], h[some]
            i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[i] == h)
            here, i = here[hit], i[hit]
            same = np.flatnonzero((chars[here[:, None] + np.arange(n)] == spelt[i]).all(axis=1))
            at.append(here[same])
            width.append(np.full(len(same), n))
            piece.append(ids[i[same]])
            if n == 1:
                alone = np.ones(len(chars), bool)
                alone[at[0]] = False
                at.append(np.flatnonzero(alone))
                width.append(np.ones(len(at[1]), np.int64))
                piece.append(-chars[at[1]].astype(np.int64) - 1)
        return np.concatenate(at), np.concatenate(width), np.concatenate(piece)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """Forward sums of distinct units, laid out so that many backward steps are one array operation.

    A node is a place within a unit; its arcs are the pieces that end there, one after the other from
    ``first_arc`` on, with their running shares. Drawing walks the arcs of many nodes at a time.
    """

    def __init__(self, vocab: Vocabulary, alpha: float):
        self.vocab = vocab
        self.weights = (np.arange(vocab.size) + 1.0) ** -alpha
        self.unit: dict[str, int] = {}
        self.nodes = 1  # node 0: nothing left
        self.first_arc = np.zeros(1, np.int32)
        self.shares, self.arc_piece, self.arc_from = np.ones(1), np.zeros(1, np.int32), np.zeros(1, np.int32)

    def add(self, units: list[str]) -> None:
        """Lattices of new units, all at once: ``unit`` gives the last node of each."""
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        length = np.array([len(u) for u in units], np.int64)
        last = np.cumsum(length)
        ends_at = np.repeat(last, length)  # for each character, where its unit ends
        inside = np.arange(len(chars)) - np.repeat(last - length, length)  # its place in the unit

        # Arcs: every piece of the vocabulary that stands here; in bytes, characters that are no piece.
        at, width, piece = self.vocab.arcs(chars, ends_at)

        # Nodes are numbered by their place within the unit first: sums go forward place by place.
        order = np.argsort(inside.astype(np.uint8), kind="stable")
        rank = np.empty(len(chars), np.int64)
        rank[order] = np.arange(len(chars))
        node = rank[at + width - 1]
        order = np.argsort(node, kind="stable")
        at, piece, node = at[order], piece[order], node[order]
        before = np.where(inside[at] == 0, -1, rank[at - 1])
        weight = self.weights[np.maximum(piece, 0)]
        weight[piece < 0] = self.weights[-1]
        heads = np.searchsorted(node, np.arange(len(chars)))
        total, shares = np.ones(len(chars) + 1), np.empty(len(at))  # total[-1]: where a unit begins
        per_place = np.concatenate(([0], np.cumsum(np.bincount(inside))))
        for low, high in zip(per_place[:-1].tolist(), per_place[1:].tolist(), strict=True):
            a, b = int(heads[low]), int(heads[high]) if high < len(heads) else len(at)
            part = weight[a:b] * total[before[a:b]]
            total[low:high] = np.add.reduceat(part, heads[low:high] - a)
            share = part / total[node[a:b]]
            upto = np.cumsum(share)
            shares[a:b] = upto - (upto - share)[heads[low:high] - a][node[a:b] - low]
        shares[np.concatenate((heads[1:], [len(at)])) - 1] = 1.0
        base, arcs = self.nodes, len(self.shares)
        self.first_arc = np.concatenate((self.first_arc, (heads + arcs).astype(np.int32)))
        self.shares = np.concatenate((self.shares, shares))
        self.arc_piece = np.concatenate((self.arc_piece, piece.astype(np.int32)))
        self.arc_from = np.concatenate((self.arc_from, np.where(before < 0, 0, base + before).astype(np.int32)))
        last = rank[last - 1] + 1
        self.unit.update(zip(units, (base + last - 1).tolist(), strict=True))
        self.nodes += len(chars)

    def sample(self, last: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, piece) of all pieces drawn, units ascending and pieces in the order of the text."""
        shares, arc_piece, arc_from, first_arc = self.shares, self.arc_piece, self.arc_from, self.first_arc
        at, node, units, pieces, steps = np.arange(len(last)), last, [], [], 0
        alive = node > 0
        at, node = at[alive], node[alive]
        while len(at):
            draw = (mix(seeds[at] + np.uint64(steps * 0x9E3779B9)) >> np.uint64(32)) * 2.0**-32
            arc = first_arc[node]
            behind = np.flatnonzero(shares[arc] <= draw)
            while len(behind):
                arc[behind] += 1
                behind = behind[shares[arc[behind]] <= draw[behind]]
            units.append(at)
            pieces.append(arc_piece[arc])
            node = arc_from[arc]
            alive = node > 0
            at, node, steps = at[alive], node[alive], steps + 1
        if not units:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        unit, piece = np.concatenate(units), np.concatenate(pieces)
        step = np.repeat(np.arange(len(units)), [len(u) for u in units])
        # Pieces were drawn from the end of each unit: count the place from the front.
        per = np.bincount(unit, minlength=len(last))
        first = np.cumsum(per) - per
        order = np.empty(len(unit), np.int64)
        order[first[unit] + per[unit] - 1 - step] = np.arange(len(unit))
        return unit[order], piece[order]


class LongUnits:
    """Draws of long units, one after the other; forward sums are logarithms, so that none leaves the range.

    All units are one array of characters, gone over in blocks: forward for the sums, then backward for the
    draws, where the pieces of each block are found again. Held are the sums, one number per character.
    """

    def __init__(self, vocab: Vocabulary, alpha: float, units: list[str]):
        self.vocab = vocab
        self.logs = -alpha * np.log(np.arange(vocab.size) + 1.0)
        self.chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        length = np.array([len(u) for u in units], np.int64)
        self.ends = np.cumsum(length)
        self.begins = self.ends - length
        self.sums = np.zeros(len(self.chars) + 1)  # sums[i]: up to place i; 0 where a unit begins
        self.held: tuple[int, tuple] | None = None
        for low in range(0, len(self.chars), BLOCK):
            self._forward(low)

    def _block(self, low: int) -> tuple[np.ndarray, ...]:
        """first arc of each place of a block, and one more; start, width, piece and log weight of its arcs by where they end."""
        if self.held is None or self.held[0] != low:
            high, begin = min(low + BLOCK, len(self.chars)), max(0, low - self.vocab.longest + 1)
            ends_at = self.ends[np.searchsorted(self.ends, np.arange(begin, high), side="right")]
            at, width, piece = self.vocab.arcs(self.chars[begin:high], np.minimum(ends_at, high) - begin)
            at = at + begin
            end = at + width - 1
            order = np.argsort(end, kind="stable")
            order = order[np.searchsorted(end[order], low) :]
            at, width, piece, end = at[order], width[order], piece[order], end[order]
            logs = np.where(piece < 0, self.logs[-1], self.logs[np.maximum(piece, 0)])
            self.held = low, (np.searchsorted(end, np.arange(low, high + 1)), at, width, piece, logs)
        return self.held[1]

    def _forward(self, low: int) -> None:
        first, at, _, _, logs = self._block(low)
        begin = max(0, low - self.vocab.longest + 1)
        first, start, logs = first.tolist(), (at - begin).tolist(), logs.tolist()
        sums = self.sums[begin : low + 1].tolist()
        high = low + len(first) - 1
        begins = set(self.begins[np.searchsorted(self.begins, low) : np.searchsorted(self.begins, high)].tolist())
        exp, log = math.exp, math.log
        for place, a, b in zip(range(low, high), first, first[1:]):
            if place in begins:
                sums[-1] = 0.0
            if b - a == 1:
                sums.append(logs[a] + sums[start[a]])
            else:
                parts = [x + sums[i] for x, i in zip(logs[a:b], start[a:b])]
                most = max(parts)
                sums.append(most + log(sum([exp(x - most) for x in parts])))
        self.sums[begin : high + 1] = sums

    def sample(self, seeds: np.ndarray) -> list[np.ndarray]:
        """The pieces of each unit in the order of the text; the draws are those of :meth:`Lattices.sample`."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(seeds)
        unit, place, drawn, draws, done = len(seeds) - 1, len(self.chars) - 1, [], [], 0
        for low in reversed(range(0, len(self.chars), BLOCK)):
            first, at, width, piece, logs = self._block(low)
            # Running shares of the arcs of each place, in their order.
            count = np.diff(first)
            parts = logs + self.sums[at]
            parts = np.exp(parts - np.repeat(np.maximum.reduceat(parts, first[:-1]), count))
            share = parts / np.repeat(np.add.reduceat(parts, first[:-1]), count)
            upto = np.cumsum(share)
            shares = upto - np.repeat((upto - share)[first[:-1]], count)
            shares[first[1:] - 1] = 1.0
            first, width, piece, shares = first.tolist(), width.tolist(), piece.tolist(), shares.tolist()
            begin = int(self.begins[unit])
            while place >= low:
                if done == len(draws):
                    steps = np.arange(len(drawn), len(drawn) + min(4096, place - begin + 1)).astype(np.uint64)
                    draws, done = ((mix(seeds[unit] + steps * np.uint64(0x9E3779B9)) >> np.uint64(32)) * 2.0**-32).tolist(), 0
                arc, draw = first[place - low], draws[done]
                while shares[arc] <= draw:
                    arc += 1
                drawn.append(piece[arc])
                place, done = place - width[arc], done + 1
                if place < begin:
                    out[unit] = np.array(drawn[::-1], np.int64)
                    unit, drawn, draws, done = unit - 1, [], [], 0
                    begin = int(self.begins[unit]) if unit >= 0 else 0
        return out


def _units(text: str) -> list[str]:
    """The text with a space in front, cut before every run of spaces."""
    if "  " in text or text[:1] == " ":
        return re.findall(" +[^ ]*", " " + text)
    return [" " + u for u in text.split(" ")]


class Encoder:
    def __init__(self, path: str, alpha: float, seed: int):
        self.vocab, self.alpha, self.seed = vocabulary(path), alpha, seed
        self.lattices = Lattices(self.vocab, alpha)
        # The smallest product of weights within a unit of so many characters stays a normal number.
        self.unit_chars = int(UNIT_CHARS / max(1.0, alpha))

    def encode(self, keys: list[int], texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text."""
        every, counts = [], []
        for text in texts:
            units = ([" " + text] if self.vocab.crosses else _units(text)) if text else []
            counts.append(len(units))
            every += units
        if len(self.lattices.unit) > UNITS_KEPT:
            self.lattices = Lattices(self.vocab, self.alpha)
        known = self.lattices.unit
        new = list({u for u in every if u not in known})
        over = any(len(u) > self.unit_chars for u in new)
        if over:
            new = [u for u in new if len(u) <= self.unit_chars]
        for i in range(0, len(new), 20_000):
            self.lattices.add(new[i : i + 20_000])
        # Node 0 for long units: they are drawn by themselves.
        last = np.fromiter((known.get(u, 0) for u in every) if over else map(known.__getitem__, every), np.int64, len(every))
        counts = np.array(counts, np.int64)
        place = np.arange(len(last)) - np.repeat(np.cumsum(counts) - counts, counts)
        key = mix(np.array([k or 0 for k in keys], np.int64).view(np.uint64) + np.uint64(self.seed))
        seeds = mix(np.repeat(key, counts) ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        unit, piece = self.lattices.sample(last, seeds)
        if over:
            unit, piece = self._with_long(every, np.flatnonzero(last == 0), seeds, unit, piece)
        if len(piece) and piece.min() < 0:
            unit, piece = self._spelt(unit, piece)
        text_of = np.repeat(np.arange(len(texts)), counts)
        ends = np.cumsum(np.bincount(text_of[unit], minlength=len(texts))) if len(unit) else np.zeros(len(texts), np.int64)
        piece = piece.astype(np.int32)
        return [piece[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _with_long(self, every: list[str], long: np.ndarray, seeds: np.ndarray, unit: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces drawn, with those of the units at ``long`` put in their places."""
        drawn = LongUnits(self.vocab, self.alpha, [every[i] for i in long.tolist()]).sample(seeds[long])
        unit = np.concatenate((unit, np.repeat(long, [len(d) for d in drawn])))
        piece = np.concatenate((piece, *drawn))
        order = np.argsort(unit, kind="stable")
        return unit[order], piece[order]

    def _spelt(self, unit: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace each character that is spelt by its byte pieces."""
        spell = {int(c): [self.vocab.byte_ids[b] for b in chr(-int(c) - 1).encode()] for c in np.unique(piece[piece < 0])}
        where = np.flatnonzero(piece < 0)
        width = np.ones(len(piece), np.int64)
        width[where] = [len(spell[c]) for c in piece[where].tolist()]
        out = np.repeat(piece, width)
        start = (np.cumsum(width) - width)[where]
        for k in range(4):
            has = width[where] > k
            out[start[has] + k] = [spell[c][k] for c in piece[where[has]].tolist()]
        return np.repeat(unit, width), out

    def decode(self, ids) -> str:
        data = b"".join(map(self.vocab.bytes_of.__getitem__, ids))
        return data[1:].decode()


def _groups(batch: pa.RecordBatch, chars: int = 1_000_000):
    """Runs of rows with about so many characters, as (start, rows)."""
    start, held, rows = 0, 0, []
    for i, row in enumerate(rows_of(batch)):
        rows.append(row)
        held += len(row[-1] or "")
        if held >= chars:
            yield start, rows
            start, held, rows = i + 1, 0, []
    if rows:
        yield start, rows


def _encode(path: str, alpha: float, seed: int, back: bool):
    def run(batches):
        encoder = Encoder(path, alpha, seed)
        for batch in batches:
            last = batch.num_columns - 1
            for start, rows in _groups(batch.select([last - 1, last])):
                ids = encoder.encode([r[0] for r in rows], [r[1] or "" for r in rows])
                null = np.array([r[1] is None for r in rows])
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                values = pa.array(np.concatenate(ids).astype(np.int32))
                offsets = pa.array(ends, mask=np.concatenate((null, [False])))
                part = batch.slice(start, len(rows))
                columns = [*part.columns[: last - 1], pa.ListArray.from_arrays(offsets, values)]
                names = [*batch.schema.names[: last - 1], "ids"]
                if back:
                    texts = [None if n else encoder.decode(i.tolist()) if len(i) else "" for n, i in zip(null, ids, strict=True)]
                    columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _decode(path: str):
    def run(batches):
        encoder = Encoder(path, 1.0, 0)
        for batch in batches:
            for start, rows in _groups(batch.select([batch.num_columns - 1])):
                texts = [None if r[0] is None else encoder.decode(r[0]) if r[0] else "" for r in rows]
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(rows)).columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return run


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", alpha: float = 1.0, seed: int = 1, back: bool = False, tokenizers: str = TOKENIZERS
) -> DataFrame:
    """``docs`` with ids: the sampled pieces of the text; with ``back`` also decoded: the text made from them."""
    added = [("ids", "array<int>")] + [("decoded", "string")] * back
    inputs = [F.coalesce(docs[f"`{key}`"].cast("long"), F.lit(0)).alias("key"), docs[f"`{text}`"].cast("string").alias("text")]
    return through(docs, inputs, _encode(f"{tokenizers}/{MODEL}", alpha, seed, back), added)


def decode(tokens: DataFrame, ids: str = "ids", tokenizers: str = TOKENIZERS) -> DataFrame:
    """``tokens`` with text: what the ids decode to."""
    return through(tokens, [tokens[f"`{ids}`"].alias("given")], _decode(f"{tokenizers}/{MODEL}"), [("text", "string")])


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode(docs, back=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` with the sampled ids of their texts, as ``ids``; cases are those of the module."""
    return encode(docs)

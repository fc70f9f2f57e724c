"""Quality rules: a decision list learned from labelled statistics of the texts.

Sequential covering: a rule is grown on two thirds of the labelled rows, one threshold condition at a
time by information gain, then pruned from its end on the remaining third; the rows that it covers are taken out
and the next rule is learned, until a rule is no longer precise on the pruning rows. Every rule rejects;
what no rule covers is kept. The list becomes one Spark conditional expression.

The list is fitted on at most ``FIT_ROWS`` labelled rows (those with the smallest hashes of the id).
Statistics and verdicts cover every row and whole texts.

Defined cases: a null or empty text has no words and fails the base check; a label that is null is left
out, of several labels for an id the mean counts (half is good); without labels of both classes there are no rules. Of
conditions that gain alike the first statistic's wins. Rows are judged one by one, so equal rows are judged alike;
a text of any length is counted whole; an empty table has no rows. A column of the
input with the name of the statistics column is replaced; other columns pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import rolling, rows_of, span_hashes, stage, through, unstage, words_of

FIT_ROWS = 20_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_digits", "n_upper")
STATS_TYPE = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ">"

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_DIGIT = np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_SPACE = " \t\n\x0b\x0c\r"


def text_stats(text: str | None) -> tuple[int, ...]:
    """The numbers of ``STATS`` for one text."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends = words_of(raw)
    counts = np.bincount(raw, minlength=256)
    spaces = int(counts[9:14].sum() + counts[32])
    chars = len(text) - spaces
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    repeated = 0
    if len(starts) > 3:
        grams = rolling(span_hashes(raw, starts, ends), 3)
        order = np.argsort(grams)
        same = grams[order[1:]] == grams[order[:-1]]
        if same.any():
            covered = np.zeros(len(starts), bool)
            twice = np.zeros(len(grams), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            for k in range(3):
                covered[k : k + len(grams)] |= twice
            repeated = int(covered.sum())
    return (
        len(starts), chars, int(counts[_SYMBOL].sum()), len(lines) - len(set(lines)), len(lines), repeated,
        int(counts[_DIGIT].sum()), int(counts[_UPPER].sum()),
    )


def _append_stats(batches):
    kind = pa.struct([(s, pa.int64()) for s in STATS])
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        values = np.array([text_stats(row[0]) for row in rows_of(pa.RecordBatch.from_arrays([texts], ["t"]))], np.int64).reshape(-1, len(STATS))
        stats = pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(len(STATS))], fields=list(kind))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], stats], names=[*batch.schema.names[:-1], "stats"])


def with_stats(docs: DataFrame, text: str = "text", into: str = "quality_stats") -> DataFrame:
    """``docs`` and a struct of the statistics of the text."""
    return through(docs, [docs[f"`{text}`"].cast("string").alias("text")], _append_stats, [(into, STATS_TYPE)])


def base_failed(stats: str = "quality_stats") -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 50) | (100 * repeated > 50 * words)


# ---------------------------------------------------------------- features: the same for learner and Spark

#: name -> (numerator, denominator); shares are per word or per line.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "symbols": ("n_symbols", None),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", None),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
    "digits_per_word": ("n_digits", "n_words"),
    "upper_per_word": ("n_upper", "n_words"),
}


def feature_matrix(stats: np.ndarray) -> np.ndarray:
    at = {s: i for i, s in enumerate(STATS)}
    columns = []
    for top, below in FEATURES.values():
        value = stats[:, at[top]].astype(float)
        columns.append(value / np.maximum(stats[:, at[below]], 1) if below else value)
    return np.stack(columns, axis=1)


def feature_column(name: str, stats: str = "quality_stats") -> Column:
    top, below = FEATURES[name]
    value = F.col(f"{stats}.{top}").cast("double")
    return value / F.greatest(F.col(f"{stats}.{below}"), F.lit(1)) if below else value


# ---------------------------------------------------------------- learner


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, list(FEATURES).index(self.feature)]
        return value >= self.threshold if self.above else value < self.threshold

    def column(self, stats: str) -> Column:
        value = feature_column(self.feature, stats)
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _best_condition(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> tuple[float, Condition | None]:
    """Highest gain: bad rows covered, times the growth of the logarithm of their share."""
    before = math.log2(max(bad.sum(), 1e-9) / len(bad))
    best, chosen = 0.0, None
    for i, name in enumerate(FEATURES):
        order = np.argsort(x[:, i], kind="stable")
        values, run = x[order, i], np.concatenate(([0], np.cumsum(bad[order])))
        below = np.searchsorted(values, cuts[i], side="left")
        for above in (True, False):
            n = len(bad) - below if above else below
            p = run[-1] - run[below] if above else run[below]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((n > 0) & (p > 0), p * (np.log2(p / np.maximum(n, 1)) - before), 0.0)
            if len(gain) and gain.max() > best + 1e-9:
                k = int(gain.argmax())
                best, chosen = float(gain[k]), Condition(name, above, float(cuts[i][k]))
    return best, chosen


def learn_rules(
    stats: np.ndarray, bad: np.ndarray, seed: int = 11, precision: float = 0.9, most_rules: int = 20, most_conditions: int = 5, least: int = 5
) -> list[Rule]:
    """Ordered rules that reject. ``precision``: share of bad rows that a rule must reach on the pruning rows."""
    if not len(bad) or bad.all() or not bad.any():
        return []
    x, bad = feature_matrix(stats), bad.astype(bool)
    side = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    grow_x, grow_y, prune_x, prune_y = x[side], bad[side], x[~side], bad[~side]
    rules: list[Rule] = []
    while len(rules) < most_rules and grow_y.any() and not grow_y.all():
        part_x, part_y, rule = grow_x, grow_y, ()
        while len(rule) < most_conditions and not part_y.all():
            cuts = [np.unique(np.quantile(part_x[:, i], np.linspace(0, 1, 129))) for i in range(x.shape[1])]
            _, condition = _best_condition(part_x, part_y, cuts)
            if condition is None:
                break
            rule = (*rule, condition)
            inside = condition.holds(part_x)
            part_x, part_y = part_x[inside], part_y[inside]
        # Prune: the prefix with the best (p - n) / (p + n), the shortest of equals.
        best, pruned = -2.0, ()
        for k in range(1, len(rule) + 1):
            hit = covered(rule[:k], prune_x)
            p, n = int(prune_y[hit].sum()), int((~prune_y[hit]).sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if worth > best + 1e-9:
                best, pruned = worth, rule[:k]
        hit, hit_grow = covered(pruned, prune_x), covered(pruned, grow_x)
        p, n = int(prune_y[hit].sum()), int(hit.sum())
        if not pruned or n == 0 or p < precision * n or hit_grow.sum() < least:
            break
        rules.append(pruned)
        grow_x, grow_y, prune_x, prune_y = grow_x[~hit_grow], grow_y[~hit_grow], prune_x[~hit], prune_y[~hit]
    return rules


def rules_column(rules: list[Rule], stats: str = "quality_stats") -> Column:
    """False where a rule of the list rejects, the first one that holds deciding; else true."""
    out = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(stats)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def known_labels(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id and bad of the ``rows`` labelled ids with the smallest hashes."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(stats: DataFrame, labels: DataFrame, into: str = "quality_stats", rows: int = FIT_ROWS) -> list[Rule]:
    """Learn from ``stats`` (doc_id and statistics) and ``labels`` (doc_id, quality: 1 good, 0 bad)."""
    both = known_labels(labels, rows).join(stats.select(F.col("doc_id"), F.col(into).alias("s")), "doc_id").select("doc_id", "bad", "s.*")
    got = both.orderBy("doc_id", *STATS).toPandas()
    return learn_rules(got[list(STATS)].to_numpy(np.int64), got["bad"].to_numpy(bool))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stats = stage(with_stats(docs).drop("text"), "stats")
    rules = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    failed = base_failed()
    return stats.select(
        "doc_id",
        *[F.col(f"quality_stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & rules_column(rules)).alias("kept"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that pass the base check and the learned list.

    A row is judged by itself: a null or empty text fails, equal rows share their verdict, a text of any length is
    counted whole, an empty table stays empty, and all columns pass unchanged whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Rules are learned from the labelled rows alone: FIT_ROWS ids at most choose them.
    chosen = F.broadcast(known_labels(labels).select(F.col("doc_id").alias("_chosen")))
    labelled = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_chosen"), "left_semi")
    learned = stage(with_stats(labelled).select("doc_id", "quality_stats"), "stats")
    rules = fit(learned, labels)
    unstage(learned)
    stats = with_stats(docs)
    return stats.where(~base_failed() & rules_column(rules)).select(*[F.col(f"`{c}`") for c in docs.columns])

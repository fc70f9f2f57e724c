"""License scan with a positional rare-token index.

An index holds for each word of the license notices its postings: notice and position. Words are weighed by how
few documents have them, counted over all documents; of a notice the ``RARE_WORDS`` rarest words are looked up.

1. Propose: places of these words in a text meet their postings. Place less position is where the notice would
   begin; words that agree on it, give or take ``SLACK`` words put in or left out, are counted together. An
   alignment's share is how many of the words looked up it holds, so changed words lower it.
2. Verify: a mandatory phrase of the license has to stand, word for word, at the alignment, ``NEAR`` words to
   either side included. Places of phrases come from their own postings: all words at one relative position.
3. A verified alignment with a share of ``ALIGNED`` is a label. The score is the best share of a verified alignment,
   so that a phrase far from any notice scores low and labels nothing.

Exact base phrases are counted beside it; their labels always stay, with score 1.

DataFrame and SQL functions only. Words are held with two spaces between them, so that phrases that follow
one another are told apart and places are counted by cutting the text, without exploding it. Only documents
with some mandatory phrase can have a label by the index, and only their words are looked up.

Defined cases: a null or empty text has no words, empty labels, null places and score 0; rows with the same id and text
share their result; the index of a repeated word has all its places; equally rare words are looked up in order of their
letters; texts of any length are looked up by places that are rows; an empty table has no rows. Only the named columns
are read, so that others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillrecon.llm.common import stage

#: Phrases whose places are counted, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label -> (mandatory phrases, any of them at the notice; passages of the license's notice, each aligned by itself)
TEMPLATES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "mit": (
        ("mit license", "permission is hereby granted free of charge"),
        (
            "released under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
            " to deal in the software without restriction",
        ),
    ),
    "apache-2": (
        ("apache license version 2", "apache license 2", "apache 2 0 license"),
        (
            "licensed under the apache license version 2 0",
            "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ),
    ),
    "gpl-3": (
        ("gnu general public license version 3", "gnu gpl version 3", "gpl v3", "gplv3"),
        ("this work is licensed under the gnu general public license version 3", "under the terms of the gnu general public license version 3"),
    ),
    "gpl-2": (
        ("gnu general public license version 2", "gnu gpl version 2", "gpl v2", "gplv2"),
        ("licensed under the gnu general public license version 2", "under the terms of the gnu general public license version 2"),
    ),
    "lgpl": (
        ("gnu lesser general public license", "lgpl"),
        ("under the terms of the gnu lesser general public license", "licensed under the lgpl"),
    ),
    "agpl-3": (("gnu affero general public license", "agpl"), ("licensed under the gnu affero general public license version 3",)),
    "mpl-2": (("mozilla public license", "mpl 2 0"), ("subject to the terms of the mozilla public license version 2 0",)),
    "bsd-3-clause": (
        ("redistribution and use in source and binary forms", "3 clause bsd license", "bsd 3 clause"),
        (
            "redistribution and use in source and binary forms with or without modification are permitted",
            "licensed under the bsd 3 clause license",
        ),
    ),
    "isc": (("isc license", "permission to use copy modify and or distribute this software"), ("licensed under the isc license", "permission to use copy modify and or distribute this software for any purpose")),
    "cc-by-nc": (
        ("cc by nc", "creative commons attribution noncommercial"),
        ("licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    ),
    "cc-by-sa": (
        ("cc by sa", "creative commons attribution sharealike"),
        ("licensed under cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    ),
    "cc0": (("cc0", "creative commons zero"), ("released under cc0 1 0 universal public domain dedication",)),
    "unlicense": (("free and unencumbered software released into the public domain",), ("this is free and unencumbered software released into the public domain",)),
}

#: Rarest words of a passage that are looked up; share of them that an alignment must hold to count at all, and for a label.
RARE_WORDS, PROPOSED, ALIGNED = 12, 0.3, 0.7
#: Words put in or left out that an alignment bears; words around it where a mandatory phrase may stand.
SLACK, NEAR = 3, 10


def _spaced(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def _words_in(text: Column) -> Column:
    """Words of a spaced text: each has its own two spaces."""
    return F.floor((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))) / 2)


def spaced_text(text: Column | str) -> Column:
    """The words in lower case, each between its own two spaces."""
    inner = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  ")
    return F.concat(F.lit(" "), F.trim(inner), F.lit(" "))


def _base(norm: Column, n_words: Column) -> dict[str, tuple[Column, Column, Column]]:
    """label -> places, first and last start of its phrase."""
    out = {}
    for phrase, label in BASE.items():
        mark = _spaced(phrase)
        there = norm.contains(mark)
        size = len(mark.encode())
        gone = F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(mark), F.lit("")))
        out[label] = (
            F.when(there, F.floor(gone / size)).otherwise(0),
            F.when(there, _words_in(F.substring_index(norm, mark, 1))),
            F.when(there, n_words - _words_in(F.substring_index(norm, mark, -1)) - len(phrase.split())),
        )
    return out


def passages_of() -> list[tuple[str, int, list[str]]]:
    """(label, number, words) of every passage."""
    return [(label, k, p.split()) for label, (_, passages) in TEMPLATES.items() for k, p in enumerate(passages)]


def looked_up(found_in: dict[str, int]) -> dict[tuple[str, int], list[str]]:
    """The rarest words of each passage, from the number of documents that have a word."""
    return {(label, k): sorted(set(words), key=lambda w: (found_in.get(w, 0), w))[:RARE_WORDS] for label, k, words in passages_of()}


def _postings(spark: SparkSession, looks: dict[tuple[str, int], list[str]]) -> tuple[DataFrame, DataFrame]:
    """Postings of the words looked up, and of the mandatory phrases; both have the templates' own size."""
    rows = [
        (w, label, k, i, len(words), len(looks[label, k]))
        for label, k, words in passages_of() for i, w in enumerate(words) if w in looks[label, k]
    ]
    phrases = [
        (w, label, k, i, len(phrase.split()))
        for label, (must, _) in TEMPLATES.items() for k, phrase in enumerate(must) for i, w in enumerate(phrase.split())
    ]
    return (
        spark.createDataFrame(rows, "word string, label string, passage int, position int, length int, most int"),
        spark.createDataFrame(phrases, "word string, label string, phrase int, position int, length int"),
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    vocabulary = sorted({w for _, _, words in passages_of() for w in words})
    mandatory = [p for must, _ in TEMPLATES.values() for p in must]

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"), spaced_text(F.col("text")).alias("norm"))
    empty = F.col("norm") == "  "
    rows = rows.withColumn("n_words", F.when(empty, 0).otherwise(_words_in(F.col("norm"))).cast("long"))
    base = _base(F.col("norm"), F.col("n_words"))
    have = F.array_intersect(F.split("norm", " +"), F.array(*[F.lit(w) for w in vocabulary]))
    plausible = F.lit(False)
    for phrase in mandatory:
        plausible = plausible | F.col("norm").contains(_spaced(phrase))
    rows = rows.select(
        "doc_id", "uid", "n_words",
        *[c.alias(f"{part}_{i}") for i, three in enumerate(base.values()) for part, c in zip(("n", "first", "last"), three, strict=True)],
        have.alias("have"), F.when(plausible, F.col("norm")).alias("norm"),
    )
    rows = stage(rows, "licenses")

    # Rarity over all documents; as many rows as the notices have words.
    counted = rows.select(F.explode("have").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    looks = looked_up({r["word"]: r["n"] for r in counted.collect()})
    index, phrases = _postings(spark, looks)

    # Places of the words looked up, in texts with some mandatory phrase.
    some = rows.where("norm is not null").select("uid", "norm").dropDuplicates(["uid"])
    known = sorted({w for words in looks.values() for w in words} | {w for p in mandatory for w in p.split()})
    places = some.select("uid", F.posexplode(F.split(F.trim("norm"), " +")).alias("at", "word")).where(F.col("word").isin(known))
    hits = places.join(F.broadcast(index), "word")
    # A hit counts for every beginning that it may belong to.
    begins = F.explode(F.sequence(F.col("at") - F.col("position") - SLACK, F.col("at") - F.col("position"))).alias("begin")
    aligned = hits.select("uid", "label", "passage", "length", "most", "word", begins)
    aligned = aligned.groupBy("uid", "label", "passage", "length", "most", "begin").agg(F.size(F.collect_set("word")).alias("n"))
    aligned = aligned.withColumn("share", F.col("n") / F.col("most")).where(F.col("share") >= PROPOSED)

    # Phrases of which every word stands at one relative position, and alignments around them.
    stands = places.join(F.broadcast(phrases), "word").groupBy("uid", "label", "phrase", "length", (F.col("at") - F.col("position")).alias("start"))
    stands = stands.agg(F.count("*").alias("n")).where("n = length")
    spot = lambda c: F.floor(c / 64)
    stands = stands.select("uid", "label", "start", (F.col("start") + F.col("length")).alias("end"), spot(F.col("start")).alias("spot"))
    low, high = F.col("begin") - NEAR, F.col("begin") + F.col("length") + SLACK + NEAR
    around = aligned.select("uid", "label", "share", low.alias("low"), high.alias("high"), F.explode(F.sequence(spot(low), spot(high))).alias("spot"))
    verified = around.join(stands, ["uid", "label", "spot"]).where("start >= low and end <= high")
    found = verified.groupBy("uid", "label").agg(F.max("share").alias("share")).groupBy("uid").agg(
        F.array_compact(F.collect_list(F.when(F.col("share") >= ALIGNED, F.col("label")))).alias("more"), F.max("share").alias("share")
    )

    n = [F.col(f"n_{i}") for i in range(len(base))]
    labels = F.array_compact(F.array(*[F.when(c > 0, F.lit(label)) for c, label in zip(n, base, strict=True)]))
    every = F.array_sort(F.array_distinct(F.concat(labels, F.coalesce("more", F.array().cast("array<string>")))))
    return rows.drop("norm", "have").join(found, "uid", "left").select(
        "doc_id", "n_words", sum(n[1:], n[0]).cast("long").alias("n_base"),
        F.least(*[f"first_{i}" for i in range(len(base))]).cast("long").alias("first_word"),
        F.greatest(*[f"last_{i}" for i in range(len(base))]).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size(labels) > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).cast("double").alias("score"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


OP7_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), tokens AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs
), base(label, k, word, n) AS (
  VALUES {_values((label, k, w, len(phrase.split())) for phrase, label in BASE.items() for k, w in enumerate(phrase.split()))}
), base_found AS (
  SELECT r, label, place - k AS start FROM tokens JOIN base USING (word) GROUP BY r, label, place - k, n HAVING count(*) = n
), base_docs AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    list(DISTINCT label) AS base_labels FROM base_found GROUP BY r
), passages(label, passage, word, k, length) AS (
  VALUES {_values((label, n, w, k, len(words)) for label, n, words in passages_of() for k, w in enumerate(words))}
), seen AS (
  SELECT word, count(DISTINCT r) AS n FROM tokens WHERE word IN (SELECT word FROM passages) GROUP BY word
), looked AS (
  SELECT label, passage, word, count(*) OVER (PARTITION BY label, passage) AS most FROM (
    SELECT label, passage, word, row_number() OVER (PARTITION BY label, passage ORDER BY coalesce(n, 0), word) AS rank
    FROM (SELECT DISTINCT label, passage, word FROM passages) LEFT JOIN seen USING (word)
  ) WHERE rank <= {RARE_WORDS}
), begins AS (
  SELECT DISTINCT r, label, passage, length, most, word, unnest(range(place - k - {SLACK}, place - k + 1)) AS b
  FROM tokens JOIN passages USING (word) JOIN looked USING (label, passage, word)
), aligned AS (
  SELECT r, label, length, b, count(*) / most AS share FROM begins GROUP BY r, label, passage, length, most, b HAVING count(*) / most >= {PROPOSED}
), phrases(label, phrase, word, k, n) AS (
  VALUES {_values((label, n, w, k, len(p.split())) for label, (must, _) in TEMPLATES.items() for n, p in enumerate(must) for k, w in enumerate(p.split()))}
), stands AS (
  SELECT r, label, place - k AS start, n FROM tokens JOIN phrases USING (word) GROUP BY r, label, phrase, place - k, n HAVING count(*) = n
), verified AS (
  SELECT r, label, max(share) AS share FROM aligned JOIN stands USING (r, label)
  WHERE start >= b - {NEAR} AND start + n <= b + length + {SLACK} + {NEAR} GROUP BY r, label
), found AS (
  SELECT r, list(label) FILTER (share >= {ALIGNED}) AS more, max(share) AS share FROM verified GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM docs LEFT JOIN base_docs USING (r) LEFT JOIN found USING (r)
"""

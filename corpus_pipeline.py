"""Stages that turn raw documents into a tokenized training mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillrecon.llm.common import scope, stage, unstage
from tillrecon.llm.mixing import mix_documents
from tillrecon.llm.near_dup import keep_one
from tillrecon.llm.quality_rules import keep_good
from tillrecon.llm.sentencepiece_sampling import tokenize
from tillrecon.llm.substring_dedup import cut_repeats

#: (name, function): each takes (spark, docs, sf_dir), works on all that the one before kept and returns a
#: DataFrame; all but the last return the columns of ``docs``.
STAGES = [
    ("quality_rules", keep_good),
    ("near_dedup", keep_one),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_documents),
    ("sentencepiece", tokenize),
]

#: The learned rules and the sampling are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over ``documents``; each result is written and read again.

    What a stage has staged is removed once its result is written, and so is that result once the next one is. What the last
    stage reads stays, since its rows are lazy.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        with scope(spark) as staying:
            docs = stage(function(spark, docs, sf_dir), name)
            staying.append(docs.staged_at)
        if before is not None:
            unstage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: five stages over `documents`, each from the written table of the one before.

1. toxicity: documents predicted toxic go;
2. line_dedup: later copies of repeated line runs go, and documents of which nothing stays;
3. simhash_near_dedup: one document of each group of near copies stays, the one with the least doc_id;
4. benchmark_decontamination: documents that hold a benchmark item go;
5. best_fit_packing: the rest is packed into token sequences.

Each stage takes (spark, docs, sf_dir).  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, line_runs, packing, simhash, toxicity
from tideline.llm.queries import held_out, tokenizer_file
from tideline.llm.rows import stored, table

TOXIC_FROM = 0.3


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored toxic go, each by its own text.  A NULL or empty text has the score of no evidence; repeated rows
    have one fate, ids and ties of them none; an empty table stays empty."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels), TOXIC_FROM)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`text` and `n_chars` are those of what is kept; a document that had no text keeps its row.  The first place of
    a run is that of the least (doc_id, text hash), NULL ids first; rows equal in both change alike."""
    return line_runs.without_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least doc_id stays, of its repeated rows one.  Rows of one doc_id,
    or without any, in different groups all stay; NULL and empty texts are one group."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item go, each judged by its own text whatever its id; NULL and empty texts hold none."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is packed, repeated ones and those without id or text included; no rows give no sequences."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("line_dedup", dedupe_lines),
    ("simhash_near_dedup", remove_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("best_fit_packing", pack_tokens),
]

# Learned scores, hashes and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the next stage's documents, the last one the encoded corpus.  All
stages but the last return the columns of ``docs``; a stage may be followed by
a Parquet write and a read of what it returned.

Columns that are not used by a stage pass through.  A null or empty text is a
document like any other; rows without an id and rows that share one are judged
one by one, by the near-duplicate stage too, which goes by their texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hebdo.llm import decontaminate, quality, sentencepiece_fst, simhash, suffix_dedup
from hebdo.llm.catalog import fold, table
from hebdo.llm.names import free_name

MODEL = "piece_bpe_32k.model"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking scores at or above its cut."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), fold("id", 5) != 0)
    return quality.keep_good(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, rows without an id last."""
    return simhash.keep_one_text(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has."""
    return suffix_dedup.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with their number and the result of decoding them again.

    A column of the documents that has the name of a new one keeps it; the new one gets an underscore."""
    keep = [c for c in docs.columns if c not in ("text", "n_chars")]
    made = [free_name(docs.select(*keep), c) for c in sentencepiece_fst.MADE]
    return sentencepiece_fst.encode_and_check(docs, public_tokenizers.path(MODEL), keep, made=made)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL can't express the trained, the iterated and the tokenizer stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


QUERIES = {"pipeline": run}

"""From raw documents to packed token batches, in four stages.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; what it
returns is written and read again. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe_automaton, minhash_dedup, packing, quality_nbsvm, secret_scan
from pulsegrid.llm.common import col, materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted on the labelled ones among them, rejects. Null
    and empty texts are scored alike, as are repeated rows; with no labels, or of one class only, all
    are scored alike and stay unless that class is 0. Columns may have any names."""
    model = quality_nbsvm.train(docs, table(spark, sf_dir, "labels"))
    return quality_nbsvm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the one of
    the smallest id. Documents without id, and those without words, stay; rows that repeat an id stay
    or go together. Columns may have any names."""
    gone = minhash_dedup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars follows the text where it changed. Null
    and empty texts, ties and repeated rows stay as they are; columns may have any names."""
    model = secret_scan.train(secret_scan.default_samples(spark))
    spans = next(x for k in range(len(docs.columns) + 1) if (x := f"_spans{k}") not in docs.columns)
    clean = secret_scan.redact(secret_scan.scan(docs, model, out_col=spans), spans)
    if "n_chars" in docs.columns:
        length = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return clean.select(*map(col, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of token ids in optimal length buckets, one row each, with the documents and pieces that they
    hold. A null or empty text is a piece without tokens; repeated rows are packed as often as they come,
    those without id as null."""
    ids = bpe_automaton.encode(docs).withColumn("ids", F.col("ids").cast("array<int>"))
    return packing.token_batches(ids)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", pack),
]

#: The classifier, the signatures and the Markov models have no SQL form; tests compare the stages
#: with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

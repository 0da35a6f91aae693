"""The corpus pipeline: quality rules, quality classifier, near duplicates, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Null texts count as empty and so fail the quality rules; rows that repeat an id or a text are rows of their own, of
which the near-duplicate stage keeps the first; texts of any length go through whole; an empty table stays empty;
further columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import small_batches, table
from voltline.llm.line_quality import keep_good, trained_on
from voltline.llm.linking import Similarity
from voltline.llm.packing import pack
from voltline.llm.quality_rules import keep_regular
from voltline.llm.secret_scans import mask_secrets
from voltline.llm.set_join import keep_one
from voltline.session import drop_scratch, materialize, scratch_made

#: Near duplicates in the pipeline: five-word shingles, similarity 0.8 or more.
NEAR = Similarity(shingle=5, num=80, den=100)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the repetition limits reject go."""
    return keep_regular(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 go; the chain is fitted on the labelled ones outside the held-out third."""
    return keep_good(docs, trained_on(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of the least id."""
    return keep_one(docs, sim=NEAR)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; ``n_chars`` follows the masked text."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their places in sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("packing", packing),
]
#: Models and components are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents; each result but the last is written once.

    When a stage's result is written, what the stage wrote on its way, and the result before it, is deleted."""
    docs = table(spark, sf_dir, "documents")
    older = scratch_made()
    with small_batches(spark):
        for i, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if i + 1 < len(STAGES):
                docs = materialize(docs, name.replace(" ", "-"))
                drop_scratch(spark, [p for p in scratch_made()[:-1] if p not in older])  # the last is the result
    return docs

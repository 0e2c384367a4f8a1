"""A corpus pipeline from the operators: each stage takes what the one before it kept.

STAGES lists (name, function) with function(spark, docs, sf_dir) -> DataFrame. All but
the last return the columns of ``docs``; the last returns packed pieces. ``run``
applies them to the documents table, writing and rereading each stage's result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import decontam, mil, packing, secrets, simhash
from barforge.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, gives a score of 0.5 or more."""
    model = mil.fit(docs, table(spark, sf_dir, "labels"))
    scored = mil.score(docs, model, keep=docs.columns)
    return scored.where("_score >= 0.5").select([F.col("kept")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest id.

    Rows without an id form no group's first document unless no row of it has one; of
    rows of a group that repeat the smallest id, the one with the smallest hash of its
    text stays, and one of its exact copies. Rows of different groups may share an id.
    """
    groups = simhash.simhash_components(docs, shingle=3, radius=2, seed=42)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    first = groups.groupBy("component").agg(F.min(order).alias("first")).select("first.id", "first.text_key")
    key = simhash.text_key(docs["text"])
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["id"]) & (key == first["text_key"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark's windows of 13 words."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), window=13, share=20)
    bad = found.where("contaminated").select("row_id").distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"]) == bad["row_id"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret span replaced by a mark."""
    found = secrets.scan(docs, keep=docs.columns)
    hit, old = F.size("spans") > 0, F.col("kept")
    clean = F.when(hit, secrets.redacted(old["text"], F.col("spans"))).otherwise(old["text"])
    new = {"text": clean}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length(clean)).otherwise(old["n_chars"])
    return found.select([new.get(c, old[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("packing", pack),
]

#: The classifier and the tokenizer are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: language ID, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's ``docs``. All but the last
keep the columns of ``docs``. No stage alters a document that it keeps, but for
the lines that line dedup takes out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm import decontaminate, langid, linededup, packing, simhash
from marketflow.llm.common import stored, table

#: A document goes if no language's own margin, mapped to 0..1, reaches this. It doesn't depend on how many languages there are.
LEAST_CLAIM = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without text or letters, and those that no learned language claims.

    Learns from the documents at hand. Without a single labelled row nothing can be
    rejected for its language, and only texts without letters go.
    """
    model = langid.train(docs, F.col("doc_id").isNotNull())
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model, [row])
    return found.filter((F.col("lang_pred") != "und") & (F.col("claim") >= LEAST_CLAIM)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes recurring lines out of the documents; all rows stay."""
    return linededup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of copies and near copies.

    Rows without an id stay. Different texts under one id are judged apart; rows
    that repeat id and text stay or go together. Null texts are empty.
    """
    groups = simhash.near_copies(docs).filter(~F.col("stays") & F.col("doc_id").isNotNull())
    gone = groups.select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__digest")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["__gone"]) & (simhash.copy_digest(docs["text"]) == gone["__digest"]), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark passage was found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Kernels, fingerprints, seeds and token ids have no counterpart in SQL; the tests hold each
# stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

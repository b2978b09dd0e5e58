"""The corpus pipeline: documents through five operators, each working on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import language, line_chunks, near_dup, packing, tiling
from skylattice.llm.rows import materialize, read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go, whatever the labels; the others stay as they are.

    The predicted language and its score decide nothing here.
    """
    model = language.learn(language.learnable(docs))
    found = language.identify(docs, model, "_found_language", "_found_score", "_found_letters")
    return found.where("_found_letters").select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go from the texts, and documents of which nothing but white space is left."""
    cut = line_chunks.drop_repeated_runs(docs)
    emptied = (F.col("removed_chunks") > 0) & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")
    columns = [F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    found = near_dup.near_duplicates(docs, k=5, percent=80)
    gone = materialize(found.where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

ORACLE_SQL = None  # models, minhashes and the tokenizer have no SQL; stages are tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialize(docs)
    return docs

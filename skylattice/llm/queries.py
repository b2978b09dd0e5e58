"""Registered queries of the operators, each over its whole table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann_tree,
    centroids,
    language,
    line_chunks,
    mixing,
    near_dup,
    packing,
    pii,
    secret_scan,
    sharding,
    tiling,
    warc_zst,
    whitening,
)
from .rows import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark, sf):
    """Secrets of every document: counts, digest of the base spans, all spans."""
    return secret_scan.digest(secret_scan.secret_spans(read(spark, sf, "documents")))


def op2_packing(spark, sf):
    """Every document's pieces in sequences of at most 4096 tokens."""
    return packing.digest(packing.pack(read(spark, sf, "documents")))


def op3_decontamination(spark, sf):
    """Pairs of documents and benchmark items that they hold, in whatever order."""
    pairs = tiling.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return pairs.select(
        "doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles")
    )


def op4_near_duplicates(spark, sf):
    """Components of documents of similar four-word shingle sets."""
    return near_dup.near_duplicates(read(spark, sf, "documents"), k=4, percent=80)


def op5_line_chunks(spark, sf):
    """Texts without any repeated run of two or more filled lines."""
    return line_chunks.drop_repeated_runs(read(spark, sf, "documents")).select(
        "doc_id", "text", "removed_chunks", "removed_lines"
    )


def op6_neighbours(spark, sf):
    """The 20 nearest rows of every twentieth vector."""
    return ann_tree.search(read(spark, sf, "embeddings"))


def op7_sharding(spark, sf):
    """Documents in 24 shards of near equal bytes."""
    return sharding.shard_rows(read(spark, sf, "documents"), shards=24)


def op8_personal_data(spark, sf):
    """Personal data of every document: counts, digest of the base spans, all spans."""
    return pii.digest(pii.personal_spans(read(spark, sf, "documents")))


def op9_warc(spark, sf):
    """Pages written as archives and read back."""
    folder = warc_zst.new_folder(spark)
    return warc_zst.read_archives(warc_zst.write_archives(read(spark, sf, "pages"), folder), folder)


def op10_language(spark, sf):
    """The language of every document, learned from those not held out."""
    docs = read(spark, sf, "documents")
    model = language.learn(language.learnable(docs))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op11_whitening(spark, sf):
    """Whitened first four components of every vector."""
    return whitening.digest(*whitening.whiten(read(spark, sf, "embeddings")))


def op12_source_mixing(spark, sf):
    """Words the mix takes of every document."""
    return mixing.digest(mixing.mix(read(spark, sf, "documents"), keep=["doc_id"]))


def op13_centroids(spark, sf):
    """The cluster of every vector after ten rounds."""
    assigned, found, _ = centroids.cluster(read(spark, sf, "embeddings"))
    return centroids.digest(assigned, found)


OPERATORS: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_packing,
        op3_decontamination,
        op4_near_duplicates,
        op5_line_chunks,
        op6_neighbours,
        op7_sharding,
        op8_personal_data,
        op9_warc,
        op10_language,
        op11_whitening,
        op12_source_mixing,
        op13_centroids,
    )
}

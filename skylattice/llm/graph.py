"""Connected components of links: stars within bounded tasks, then small joins over stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .rows import materialize

LINKS_PER_TASK = 200_000
LEAST_FILES = 8
WORTH = 0.8  # stars are merged again while that leaves fewer links than this share


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every linked node but the smallest of its component, with that smallest node.

    Roots hook onto the smallest root beside them and paths are cut short, so at least half of
    the components that are not whole yet disappear in each turn.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    inner = label != np.arange(len(nodes))
    return nodes[label[inner]], nodes[inner]


def _starred(links: DataFrame, limit: int) -> DataFrame:
    """The links of every task as stars: at most one link a node, joining the same nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return stars(*(np.concatenate(ends) for ends in zip(*held)))

        def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
            rows += batch.num_rows
            if rows > 2 * limit:
                held = [merged()]
                rows = len(held[0][0])
                if rows > limit:  # stars of many nodes: send them on and start anew
                    yield out(*held.pop())
                    rows = 0
        if held:
            yield out(*merged())

    return links.mapInArrow(run, "u bigint, v bigint")


def _counted(df: DataFrame, column) -> tuple[DataFrame, int]:
    seen = Observation()
    stored = materialize(df.observe(seen, column.alias("n")))
    return stored, seen.get["n"] or 0


def components(links: DataFrame, per_task: int = LINKS_PER_TASK) -> DataFrame:
    """``(node, label)``: the smallest node reachable over ``links`` (columns ``u``, ``v``).

    Every task turns its links into stars, at most one link a node; stars of several tasks are put
    together, ``per_task`` links in one, and merged again as long as that saves links. Where all fit
    into one task the stars are the components. Otherwise rounds follow: each takes the smallest label
    among neighbours (a map-side combined minimum, so a node with very many links costs one row per
    task), then follows labels of labels, so chains shorten by half, until no label changes.
    Rounds are stored, never kept on one executor. Links with a null end and self links add
    nothing; no links give no rows.
    """
    ends = [F.col(c).cast("bigint").alias(c) for c in ("u", "v")]
    usable = links.where(F.col("u") != F.col("v")).select(*ends)
    left, rows = _counted(_starred(usable, per_task), F.count("*"))
    whole = False
    while rows and not whole:
        tasks = -(-rows // per_task)
        before, whole = rows, tasks == 1
        left, rows = _counted(_starred(left.coalesce(tasks), per_task), F.count("*"))
        if rows > WORTH * before:
            break
    if whole or not rows:
        own = left.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
        return left.select(F.col("v").alias("node"), F.col("u").alias("label")).union(own)
    return _propagated(left, per_task)


def _propagated(links: DataFrame, per_task: int) -> DataFrame:
    both = materialize(
        links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    )
    neighbours = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
    labels, nodes = _counted(
        neighbours.select("node", F.least("node", "near").alias("label")), F.count("*")
    )
    files = max(LEAST_FILES, nodes // per_task)
    moved = nodes
    while moved:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("near"))
        low = labels.join(near, labels.node == near.u).select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        of = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        stepped = low.join(of, "label").select(
            "node", "before", F.least("label", "beyond").alias("label")
        )
        labels, moved = _counted(stepped.coalesce(files), F.count_if(F.col("label") < F.col("before")))
        labels = labels.select("node", "label")
    return labels

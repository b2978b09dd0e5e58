"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree grows by levels. Its top is fitted on a bounded sample (``SAMPLE`` rows of lowest hash); every
row is then routed to a leaf. A leaf of more than ``LEAF_MOST`` different vectors gets a tree of its own,
fitted by a task on a bounded sample of this leaf, and so on: leaves stay of one size however many rows
there are, and only the top is ever on the driver or broadcast. Vectors are extended by one component so that all have the same length; nearest by distance
is then largest by inner product. A query walks the tree with a priority queue over open branches,
closest centre first, and so lists leaves in the order in which they promise neighbours. A leaf's place in
that order is the farthest centre on its path, so the queues of trees below continue that of the tree above:
the leaves of all trees a query has open are ordered together. How many leaves of each level a search
visits is widened until calibration queries, whose true neighbours are known from
a scan of all rows, reach the wanted recall. A query whose leaves hold too few rows walks on.

Visits are a join of queries and rows on the leaf. Its rows are split into cells and the queries that
visit it into slices of bounded size, so a hot leaf (one vector many times over) is many tasks' work.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import bounded_sample, materialize, prepare

SAMPLE = 20_000
BRANCH = 8
LEAF_ROWS = 100  # of the sample
LEAF_MOST = 1_000  # different vectors of a leaf that is not split
FIT_ROWS = 4_000  # about the sample of a leaf that is
FIT_LEAF = 25  # least rows of that sample in a leaf
ROUTE_ROWS = 50_000  # routed by a task at a time
_HASHES = 2**31 - 1
CALIBRATION = 200
RECALL = 0.95
CELL_ROWS = 2_000
PAIRS = 1_000_000  # scores held at a time
TOP = 20


@dataclass
class Tree:
    """Centres by node; children of node i are ``children[i]``; leaves have a number instead."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: dict[int, int]

    @property
    def leaves(self) -> int:
        return len(self.leaf_of)

    def order(
        self, query: np.ndarray, most: int, stock: np.ndarray | None = None, enough: int = 0, above: float = -np.inf
    ) -> list[tuple[int, float]]:
        """The first ``most`` leaves, best bin first, and more until their ``stock`` of rows is ``enough``.

        Each with the farthest centre of its path, ``above`` among them: leaves come in this order.
        """
        near = -(self.centres @ query) * 2 + (self.centres**2).sum(axis=1)
        queue, out, held = [(above, 0)], [], 0
        while queue and (len(out) < most or held < enough):
            far, node = heapq.heappop(queue)
            if node in self.leaf_of:
                out.append((self.leaf_of[node], far))
                held += stock[out[-1][0]] if stock is not None else enough
            for child in self.children[node]:
                heapq.heappush(queue, (max(far, float(near[child])), child))
        return out

    def route(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row: the nearest child, level by level."""
        node = np.zeros(len(rows), dtype=np.int64)
        open_rows = np.arange(len(rows))
        while len(open_rows):
            still = []
            for one in np.unique(node[open_rows]):
                own = open_rows[node[open_rows] == one]
                kids = self.children[one]
                if kids:
                    c = self.centres[kids]
                    at = ((c**2).sum(axis=1) - 2 * rows[own] @ c.T).argmin(axis=1)
                    node[own] = np.array(kids)[at]
                    still.append(own)
            open_rows = np.concatenate(still) if still else np.array([], dtype=np.int64)
        return np.array([self.leaf_of[n] for n in node], dtype=np.int64)


def build(rows: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, steps: int = 12) -> Tree:
    """Hierarchical k-means; a node of few rows, or of rows all alike, is a leaf."""
    centres = [rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1] if rows.ndim > 1 else 1)]
    children: list[list[int]] = [[]]
    leaf_of: dict[int, int] = {}
    random = np.random.default_rng(7)
    stack = [(0, np.arange(len(rows)))]
    while stack:
        node, own = stack.pop()
        x = rows[own]
        distinct = np.unique(x, axis=0) if len(own) > leaf_rows else x[:1]
        if len(own) <= leaf_rows or len(distinct) < 2:
            leaf_of[node] = len(leaf_of)
            continue
        k = min(branch, len(distinct))
        c = distinct[random.choice(len(distinct), k, replace=False)]
        for _ in range(steps):
            at = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
            c = np.array([x[at == i].mean(axis=0) if (at == i).any() else c[i] for i in range(k)])
        at = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        filled = [i for i in range(k) if (at == i).any()]
        if len(filled) < 2:
            leaf_of[node] = len(leaf_of)
            continue
        for i in filled:
            children[node].append(len(centres))
            stack.append((len(centres), own[at == i]))
            centres.append(c[i])
            children.append([])
    return Tree(np.array(centres), children, leaf_of)


def exact_scores(queries: np.ndarray, rows: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Inner products of the pairs ``(query, row)``, summed from the first component on: equal vectors, equal scores."""
    total = np.zeros(len(query))
    for d in range(queries.shape[1]):
        total += queries[query, d] * rows[row, d]
    return total


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, top: int):
    """(query number, id, score) of the ``top`` rows of each query; ties to the smaller id.

    One product of matrices for many queries finds what may be among the best, a second pass over
    these pairs alone sums their scores exactly.
    """
    out = [(np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([]))]
    if not len(rows) or not len(queries):
        return out[0]
    slack = 1e-9 * (1.0 + np.abs(queries).sum(axis=1) * np.abs(rows).max())
    step = max(1, PAIRS // len(rows))
    for start in range(0, len(queries), step):
        q = queries[start : start + step]
        mine = ids[None, :] == own[start : start + step, None]
        rough = np.where(mine, -np.inf, q @ rows.T)
        if len(rows) > top:
            floor = np.partition(rough, -top, axis=1)[:, -top] - slack[start : start + step]
        else:
            floor = np.full(len(q), -np.inf)
        at, row = np.nonzero((rough >= floor[:, None]) & ~mine)
        exact = exact_scores(q, rows, at, row)
        order = np.lexsort((ids[row], -exact, at))
        first = np.searchsorted(at[order], at[order], "left")
        order = order[np.arange(len(order)) - first < top]
        out.append((at[order] + start, ids[row][order], exact[order]))
    return tuple(map(np.concatenate, zip(*out)))


def _usable(vectors: DataFrame) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite & some
    )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, none of them null, as rows."""
    if not len(column):
        return np.zeros((0, 0))
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in parts]).reshape(len(column), -1)


def _extended(rows: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest - (rows**2).sum(axis=1)))
    return np.hstack([rows, rest[:, None]])


_FOUND = "query_id bigint, vec_id bigint, score double"


def _scan(rows: DataFrame, queries: np.ndarray, ids: np.ndarray, top: int) -> DataFrame:
    """Each task's best rows for a bounded set of queries, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own = shared.value
        kept = np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([])
        for batch in batches:
            more = best(q, _matrix(batch.column("x")), batch.column("vec_id").to_numpy(), own, top)
            at, found, score = map(np.concatenate, zip(kept, more))
            order = np.lexsort((found, -score, at))
            first = np.searchsorted(at[order], at[order], "left")
            order = order[np.arange(len(order)) - first < top]
            kept = at[order], found[order], score[order]
        at, found, score = kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[at], pa.int64()), pa.array(found, pa.int64()), pa.array(score)],
            names=["query_id", "vec_id", "score"],
        )

    return _top(rows.select("vec_id", "x").mapInArrow(run, _FOUND), top)


def _top(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    vectors: DataFrame,
    query_filter: str = "vec_id % 20 = 0",
    top: int = TOP,
    recall: float = RECALL,
    sample: int = SAMPLE,
    leaf_most: int = LEAF_MOST,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: neighbours found for the rows of ``query_filter``.

    Leaves of more than ``leaf_most`` different vectors are split on a sample of about ``fit_rows`` of them.
    Vectors that are null, zero or hold null or non-finite components take no part, nor do null
    ids; vectors of another length than most are an error of the table and take no part either.
    Repeated rows are rows like others, but no row is a neighbour of its own id. Fewer candidates
    than ``top`` are returned all; an empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = _usable(vectors)
    width = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not width:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = materialize(rows.where(F.size("x") == width[0]["n"]))
    squared = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    longest = rows.agg(F.max(squared)).first()[0]
    picked = bounded_sample(rows, sample, "vec_id").select("x").collect()
    tree = build(_extended(np.array([r[0] for r in picked], dtype=np.float64), longest))
    # At most 2 * sample / 2 nodes, so this broadcast is bounded by the sample.
    shared = spark.sparkContext.broadcast((tree, longest))

    def leaf(x: pd.Series) -> pd.Series:
        own, far = shared.value
        return pd.Series(own.route(_extended(np.stack(x.to_numpy()), far)))

    placed = rows.withColumn("leaf", F.pandas_udf(leaf, "bigint")("x").cast("string"))
    placed, levels = grow(materialize(placed), longest, leaf_most, fit_rows)
    wanted = placed.where(query_filter)
    chosen = calibration(placed, wanted, top)
    share = recall ** (1 / (len(levels) + 1))
    visits = first_visits(chosen, tree, share)

    at_top = stock_of(placed, 0)
    stock = np.zeros(tree.leaves, dtype=np.int64)
    for r in at_top.collect():  # one row per leaf of the top
        stock[int(r["leaf"])] = r["rows"]

    def bins(x: pd.Series, same: pd.Series) -> pd.Series:
        own, _ = shared.value
        flat = lambda q: np.append(np.asarray(q, dtype=np.float64), 0.0)
        found = [own.order(flat(q), visits, stock, top + n) for q, n in zip(x, same)]
        return pd.Series([[(str(n), far) for n, far in one] for one in found])

    # Rows of the query's own id are no neighbours, so the leaves have to hold as many more.
    repeats = placed.groupBy("vec_id").agg(F.count("*").alias("same")).where("same > 1")
    counted = wanted.join(repeats, "vec_id", "left").withColumn("same", F.coalesce("same", F.lit(1)))
    asks = materialize(
        counted.select(
            F.monotonically_increasing_id().alias("ask"),
            F.col("vec_id").alias("query_id"),
            F.col("x").alias("q"),
            (F.col("same") + top).alias("enough"),
            F.pandas_udf(bins, "array<struct<leaf string, far double>>")("x", "same").alias("bins"),
        )
    )
    front = asks.select("ask", "query_id", "enough", F.inline("bins"))
    asks = asks.select("ask", "q")
    for level, trees in enumerate(levels):
        front = descend(front, asks, trees)
        least = share ** (level + 2)
        front = nearest_leaves(front, stock_of(placed, level + 1), chosen, level + 1, least)

    rows_of = stock_of(placed, len(levels))
    parts = lambda n: F.ceil(F.col(n) / CELL_ROWS).cast("int")
    asks_of = front.groupBy("leaf").agg(F.count("*").alias("asks"))
    split = materialize(rows_of.join(asks_of, "leaf").select("leaf", parts("rows").alias("cells"), parts("asks").alias("slices")))
    if not levels:  # one row per leaf of the top: at most the sample's size
        split = F.broadcast(split)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = (
        front.join(asks, "ask")
        .join(split, "leaf")
        .withColumn("slice", F.pmod(F.xxhash64("ask"), F.col("slices")).cast("int"))
        .select("query_id", "q", F.col("leaf").alias("bin"), "slice", every("cells").alias("cell"))
    )
    shelves = (
        placed.join(split, "leaf")
        .withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int"))
        .select("leaf", "cell", "vec_id", "x", every("slices").alias("slice"))
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("query_id").to_numpy()
        q = _matrix(left.column("q"))
        at, found, score = best(q, _matrix(right.column("x")), right.column("vec_id").to_numpy(), ids, top)
        return pa.table(
            [pa.array(ids[at], pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    found = (
        asks.groupBy("bin", "cell", "slice")
        .cogroup(shelves.groupBy("leaf", "cell", "slice"))
        .applyInArrow(meet, _FOUND)
    )
    return _top(found, top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def stock_of(placed: DataFrame, level: int) -> DataFrame:
    """Rows of every leaf of the first ``level + 1`` levels; the path of a leaf names those above it."""
    return placed.groupBy(at_level("leaf", level).alias("leaf")).agg(F.count("*").alias("rows"))


def at_level(leaf: str, level: int) -> Column:
    return F.substring_index(leaf, ".", level + 1)


def grow(placed: DataFrame, longest: float, most: int, fit_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows in leaves of at most ``most`` different vectors, and the trees of every level below the top.

    A level splits the leaves that the one before made too large. Vectors of a leaf are sampled by a cut on
    their hash, copies once, so a task fits on about ``fit_rows`` rows whatever the leaf holds. Rows go to
    their tree in cells of bounded size. Leaves that k-means cannot part stay.
    """
    levels: list[DataFrame] = []
    code = F.xxhash64("x")

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("code").to_numpy(), kind="stable")
        x = _extended(_matrix(table.column("x")), longest)[order]
        held = table.column("vectors")[0].as_py()
        tree = build(x, leaf_rows=max(FIT_LEAF, most * len(x) // (2 * held)))
        found = [] if tree.leaves < 2 else [(table.column("leaf")[0].as_py(), pickle.dumps(tree))]
        return pa.table(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())],
            names=["leaf", "tree"],
        )

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.select(["vec_id", "x", "leaf"]).slice(0, 0)
        tree = pickle.loads(right.column("tree")[0].as_py())
        at = tree.route(_extended(_matrix(left.column("x")), longest))
        names = [f"{leaf}.{n}" for leaf, n in zip(left.column("leaf").to_pylist(), at)]
        return pa.table([left.column("vec_id"), left.column("x"), pa.array(names, pa.string())], names=["vec_id", "x", "leaf"])

    while True:
        depth = F.size(F.split("leaf", r"\."))
        fresh = placed.where(depth == len(levels) + 1)
        large = materialize(
            fresh.groupBy("leaf")
            .agg(F.count("*").alias("rows"), F.approx_count_distinct(code).alias("vectors"))
            .where(F.col("vectors") > most)
        )
        cut = F.lit(float(fit_rows) * _HASHES) / F.col("vectors")
        picked = (
            fresh.join(large, "leaf")
            .where(F.pmod(code, F.lit(_HASHES)) < cut)
            .groupBy("leaf", code.alias("code"))
            .agg(F.min("x").alias("x"), F.first("vectors").alias("vectors"))
        )
        trees = materialize(picked.groupBy("leaf").applyInArrow(fit, "leaf string, tree binary"))
        if trees.isEmpty():
            return placed, levels
        cells = large.join(trees.select("leaf"), "leaf").select("leaf", F.ceil(F.col("rows") / ROUTE_ROWS).cast("int").alias("cells"))
        moved = fresh.join(cells, "leaf").select(
            "vec_id", "x", "leaf", F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int").alias("cell")
        )
        copies = trees.join(cells, "leaf").select("leaf", "tree", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
        below = moved.groupBy("leaf", "cell").cogroup(copies.groupBy("leaf", "cell")).applyInArrow(route, "vec_id bigint, x array<double>, leaf string")
        stay = placed.join(trees.select("leaf"), "leaf", "left_anti").select("vec_id", "x", "leaf")
        placed = materialize(stay.unionByName(below))
        levels.append(trees)


def descend(front: DataFrame, asks: DataFrame, trees: DataFrame) -> DataFrame:
    """Open leaves that have a tree are replaced by all leaves of that tree, each in its place in the order."""
    asked = front.join(trees.select("leaf"), "leaf")
    slices = asked.groupBy("leaf").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("slices"))
    left = (
        asked.join(slices, "leaf")
        .join(asks, "ask")
        .withColumn("slice", F.pmod(F.xxhash64("ask"), F.col("slices")).cast("int"))
        .select("ask", "query_id", "enough", "leaf", "far", "q", "slice")
    )
    right = trees.join(slices, "leaf").select("leaf", "tree", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    names = ["ask", "query_id", "enough", "leaf", "far"]

    def walk(some: pa.Table, tree: pa.Table) -> pa.Table:
        if not some.num_rows or not tree.num_rows:
            return some.select(names).slice(0, 0)
        own = pickle.loads(tree.column("tree")[0].as_py())
        leaf = some.column("leaf")[0].as_py()
        queries = np.hstack([_matrix(some.column("q")), np.zeros((some.num_rows, 1))])
        found = [own.order(q, own.leaves, above=far) for q, far in zip(queries, some.column("far").to_numpy())]
        row = np.repeat(np.arange(some.num_rows), own.leaves)
        kept = some.select(["ask", "query_id", "enough"]).take(pa.array(row))
        below = pa.array([f"{leaf}.{n}" for one in found for n, _ in one], pa.string())
        return kept.append_column("leaf", below).append_column("far", pa.array([far for one in found for _, far in one], pa.float64()))

    below = left.groupBy("leaf", "slice").cogroup(right.groupBy("leaf", "slice")).applyInArrow(walk, front.select(names).schema)
    return materialize(front.join(trees.select("leaf"), "leaf", "left_anti").select(names).unionByName(below))


def nearest_leaves(front: DataFrame, stock: DataFrame, chosen: Calibration, level: int, least: float) -> DataFrame:
    """The first open leaves of each query, as many as calibration needs, and more until they hold enough rows."""
    order = Window.partitionBy("ask").orderBy("far", "leaf")
    held = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = materialize(
        front.join(stock, "leaf").select("*", F.row_number().over(order).alias("n"), F.coalesce(held, F.lit(0)).alias("held"))
    )
    true = chosen.true.select("query_id", at_level("leaf", level).alias("leaf"), "vec_id").distinct()
    # A bounded set of queries and their neighbours. Where an id has several rows, the last place counts.
    needed = true.join(ranked, ["query_id", "leaf"]).groupBy("query_id", "vec_id").agg(F.max("n").alias("n"))
    pairs = true.select("query_id", "vec_id").distinct().count()
    visits = widen([r["n"] for r in needed.select("n").collect()], pairs, least)
    return ranked.where((F.col("n") <= visits) | (F.col("held") < F.col("enough"))).drop("n", "held", "rows")


@dataclass
class Calibration:
    """A bounded set of queries and the leaves of their true neighbours."""

    queries: np.ndarray
    ids: np.ndarray
    true: DataFrame | None


def calibration(placed: DataFrame, wanted: DataFrame, top: int) -> Calibration:
    sample = bounded_sample(wanted, CALIBRATION, "vec_id").collect()
    queries = np.array([r["x"] for r in sample], dtype=np.float64)
    ids = np.array([r["vec_id"] for r in sample], dtype=np.int64)
    true = _scan(placed, queries, ids, top).join(placed.select("vec_id", "leaf").distinct(), "vec_id")
    return Calibration(queries, ids, materialize(true.select("query_id", "vec_id", "leaf")))


def first_visits(chosen: Calibration, tree: Tree, recall: float) -> int:
    """Leaves of the top to visit: the fewest with which the queries of calibration reach ``recall``."""
    rank = {}
    for number, query in zip(chosen.ids, chosen.queries):
        for n, (leaf, _) in enumerate(tree.order(np.append(query, 0.0), tree.leaves)):
            rank[int(number), str(leaf)] = n + 1
    where = chosen.true.select("query_id", at_level("leaf", 0).alias("leaf")).collect()
    needed = [rank[r["query_id"], r["leaf"]] for r in where]
    return widen(needed, len(needed), recall)


def widen(needed: list[int], of: int, recall: float) -> int:
    """The fewest visits, widened by an eighth at a time, that find the share ``recall`` of all ``of`` neighbours."""
    most, visits = max(needed, default=1), 1
    while visits < most and sum(n <= visits for n in needed) < recall * of:
        visits += max(1, visits // 8)
    return min(visits, most)

"""MinHash near-duplicates with tensored banding, every link confirmed on full shingle sets.

Two collections of ``m`` keys, each of ``r`` minhashes, are computed per set. A table is a pair (i, j) of
keys, one from each collection, so m*m tables of 2*r minhashes cost 2*m*r minhashes instead of
2*m*m*r. Two sets meet in some table exactly if they agree in a key of either collection.

1. Equal sets become one node, so copies cost nothing further.
2. Keys that occur once are dropped before tables are formed: a set meets another only in pairs of
   shared keys.
3. Every node is compared with the smallest node it meets (a linear number of pairs). Confirmed
   links already join most of a group of copies.
4. Groups of nodes that meet, over any chain, but are not one component yet are compared completely:
   the largest component and the rest are cut into blocks of bounded size, and every pair of blocks
   with a node outside the largest component is one task's matrix product. Pairs are not emitted; a
   block pair returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .rows import materialize, prepare, releasing, slices

KEYS = 16
ROWS = 4
BLOCK = 256
CACHED_WORDS = 200_000

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Words(dict):
    """Hashes of words, computed once each; bounded, starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, k: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; A-Z count as a-z.

    Fewer than ``k`` words are one shingle together, none give the empty set.
    """
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) > CACHED_WORDS:
        words.clear()
    h = np.fromiter(map(words.__getitem__, split), dtype=np.uint64, count=len(split))
    width = min(k, len(h))
    if not width:
        return h
    n = len(h) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = total * _P + h[i : i + n]
    return np.unique(_mixed(total))


def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(20_210).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def keys_of(one: np.ndarray, keys: int, rows: int) -> np.ndarray:
    """The 2 * ``keys`` keys of a set, each a hash of ``rows`` minhashes."""
    low = np.array([(one * m).min() for m in _multipliers(2 * keys * rows)])
    low = low.reshape(2 * keys, rows)
    total = np.arange(2 * keys, dtype=np.uint64)
    for i in range(rows):
        total = _mixed(total * _P + low[:, i])
    return total


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


_SETS = "doc_id bigint, n_shingles bigint, code binary, left array<bigint>, right array<bigint>"


def signatures(docs: DataFrame, k: int, keys: int = KEYS, rows: int = ROWS) -> DataFrame:
    """Size, 128-bit code and both collections of keys of every document's set."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        longs = pa.list_(pa.int64())
        for batch in slices(batches):
            n, code, left, right = [], [], [], []
            for text in batch.column("text").to_pylist():
                one = shingles(text, k, words)
                n.append(len(one))
                code.append(xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None)
                both = _signed(keys_of(one, keys, rows)) if len(one) else None
                left.append(both and both[:keys])
                right.append(both and both[keys:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(code, pa.binary()),
                    pa.array(left, longs),
                    pa.array(right, longs),
                ],
                names=["doc_id", "n_shingles", "code", "left", "right"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _SETS)


def meetings(nodes: DataFrame) -> DataFrame:
    """``(u, v)``: each node ``v`` with the smallest node ``u`` of every table entry that holds both."""
    each = nodes.select("node", "size", F.posexplode(F.concat("left", "right")).alias("i", "key"))
    often = each.groupBy("i", "key").agg(F.count("*").alias("n")).where("n > 1").select("i", "key")
    side = lambda left: F.collect_list(
        F.when((F.col("i") < F.col("size")) == F.lit(left), F.struct("i", "key"))
    )
    both = each.join(often, ["i", "key"]).groupBy("node").agg(side(True).alias("left"), side(False).alias("right"))
    entries = both.select("node", F.explode("left").alias("a"), "right").select(
        "node", "a", F.explode("right").alias("b")
    )
    # A table's number goes into the entry's key.
    entries = materialize(entries.select("node", F.xxhash64("a.i", "a.key", "b.i", "b.key").alias("entry")))
    first = entries.groupBy("entry").agg(F.min("node").alias("u"), F.count("*").alias("n")).where("n > 1")
    return (
        entries.join(first.select("entry", "u"), "entry")
        .where(F.col("u") < F.col("node"))
        .select("u", F.col("node").alias("v"))
        .distinct()
    )


def _similar(shared, left, right, percent: int):
    """Whether 100 * intersection >= percent * union."""
    return 100 * shared >= percent * (left + right - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    u = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    v = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    shared = F.size(F.array_intersect("su", "sv"))
    return (
        pairs.join(v, "v")
        .join(u, "u")
        .where(_similar(shared, F.size("su"), F.size("sv"), percent))
        .select("u", "v")
    )


def block_links(own: list[np.ndarray], comp: np.ndarray, first: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between nodes of different components (row numbers).

    Rows up to ``first`` are one block and the others the second one; with ``first`` equal to the
    number of rows the block meets itself. Intersections of all pairs are one matrix product over
    the shingles that occur more than once.
    """
    n = len(own)
    size = np.array([len(s) for s in own])
    every = np.concatenate(own)
    row = np.repeat(np.arange(n), size)
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    a = slice(0, first)
    b = slice(first, n) if first < n else slice(0, n)
    shared = np.zeros((len(range(*a.indices(n))), len(range(*b.indices(n)))), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096  # columns of the incidence matrix at a time
    for low in range(0, int(often.sum()), width):
        s, e = np.searchsorted(column, [low, low + width])
        hot = np.zeros((n, width), dtype=np.float32)
        hot[row[s:e], column[s:e] - low] = 1
        shared += hot[a] @ hot[b].T
    linked = _similar(np.rint(shared).astype(np.int64), size[a, None], size[None, b], percent)
    linked &= comp[a, None] != comp[None, b]
    parent = {int(c): int(c) for c in np.unique(comp)}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found = []
    for i, j in zip(*np.nonzero(linked)):
        j = int(j) + (first if first < n else 0)
        x, y = root(int(comp[i])), root(int(comp[j]))
        if x != y:
            parent[x] = y
            found.append((int(i), j))
    return found


def complete(groups: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``(u, v)``: links between components of a group, from (node, group, comp).

    They join what belongs together: one link is given where several would join the same.
    """
    counts = groups.groupBy("group", "comp").agg(F.count("*").alias("n"))
    of_group = counts.groupBy("group").agg(
        F.max(F.struct("n", "comp")).alias("largest"), F.sum("n").alias("all"), F.count("*").alias("comps")
    )
    open_groups = of_group.where("comps > 1").select(
        "group",
        F.col("largest.comp").alias("main"),
        F.ceil(F.col("largest.n") / block).cast("int").alias("main_blocks"),
        F.ceil((F.col("all") - F.col("largest.n")) / block).cast("int").alias("rest_blocks"),
    )
    placed = groups.join(open_groups, "group").withColumn("main", F.col("comp") == F.col("main"))
    own = F.when(
        F.col("main"),
        F.col("rest_blocks") + F.pmod(F.xxhash64("node"), F.col("main_blocks")).cast("int"),
    ).otherwise(F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int"))
    # Blocks of the rest meet each other, themselves, and those of the largest component.
    placed = placed.withColumn("own", own).withColumn(
        "others",
        F.when(F.col("main"), F.sequence(F.lit(0), F.col("rest_blocks") - 1)).otherwise(
            F.sequence(F.lit(0), F.col("rest_blocks") + F.col("main_blocks") - 1)
        ),
    )
    tasks = placed.select("node", "group", "comp", "own", F.explode("others").alias("other")).select(
        "node",
        "group",
        "comp",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
    )
    rows = tasks.join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("own", "ascending"), ("node", "ascending")])
        comp = table.column("comp").to_numpy()
        own = table.column("own").to_numpy()
        first = int((own == table.column("low")[0].as_py()).sum())
        one = [np.asarray(s.values).view(np.uint64) for s in table.column("shingles")]
        ends = [(comp[i], comp[j]) for i, j in block_links(one, comp, first, percent)]
        return pa.table(
            [pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64())],
            names=["u", "v"],
        )

    return rows.groupBy("group", "low", "high").applyInArrow(run, "u bigint, v bigint")


def shingle_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``(node, shingles)`` of the given nodes only, from their documents' whole texts."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches):
            node, own = [], []
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "code", "text")]
            for doc_id, code, text in zip(*columns):
                one = shingles(text, k, words)
                if xxhash.xxh3_128_digest(one.tobytes()) == code:  # not another text of the id
                    node.append(doc_id)
                    own.append(_signed(one))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(own, pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    wanted = nodes.select(F.col("node").alias("doc_id"), "code")
    rows = docs.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "code", "text")
    # The join has dealt rows out by id, so repeated rows are found without another shuffle.
    return rows.dropDuplicates(["doc_id", "text"]).mapInArrow(run, "node bigint, shingles array<bigint>")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, keys: int = KEYS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``k``-word
    shingles. ``component_id`` is the smallest ``doc_id`` reachable over links; ``kept`` says that it
    is the document's own. Null, empty and blank texts have the empty set and are linked with nothing.
    Rows repeating ``doc_id`` and text are equal sets of one id, so all are kept; a null ``doc_id`` takes
    no part: its component is null and it is kept. Other columns are not read; an empty table gives
    no rows. Candidates come from tensored banding: at exactly 80 percent a link is missed with a
    chance of 0.0005 (far less above); those found are compared on full sets.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    signed = materialize(signatures(texts, k, keys, rows))
    usable = signed.where("code IS NOT NULL AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "left", "right")).alias("first")
    nodes = materialize(
        usable.groupBy("code")
        .agg(first)
        .select("code", F.col("first.doc_id").alias("node"), F.lit(keys).alias("size"), "first.left", "first.right")
    )
    met = materialize(meetings(nodes))
    involved = met.select(F.col("u").alias("node")).union(met.select("v")).distinct()
    sets = materialize(shingle_sets(texts, nodes.select("node", "code").join(involved, "node"), k))
    nearest = met.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")
    comps = components(confirmed(nearest, sets, percent))
    # Nodes that meet over any chain; most such groups are one component already.
    groups = components(met).select(F.col("node").alias("of"), F.col("label").alias("group"))
    lead = lambda node: F.coalesce("label", node)
    grouped = groups.join(comps, groups.of == comps.node, "left").select(
        F.col("of").alias("node"), "group", lead("of").alias("comp")
    )
    joined = components(complete(materialize(grouped.select("node", "group", "comp")), sets, percent))
    of_node = nodes.select("code", "node").join(
        comps.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left"
    ).select("code", lead("node").alias("comp"))
    of_code = of_node.join(
        joined.withColumnRenamed("node", "of"), F.col("comp") == F.col("of"), "left"
    ).select(F.col("code").alias("of"), lead("comp").alias("component"))
    return signed.join(of_code, F.col("code") == F.col("of"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("component", "doc_id"))
        .alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )

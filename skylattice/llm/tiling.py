"""Benchmark decontamination by greedy string tiling.

A benchmark item and a document share a seed when ``min_match`` words in a row agree. Seeds are
joined on their Karp-Rabin hash, rolled over the word numbers of the document; hits are compared
word by word and run together into maximal matches along a diagonal. Tiling then marks the longest
match that overlaps no mark, in item and document alike, again and again; what is left of a partly
marked match goes on as a shorter one. The share of an item's words under tiles is its coverage:
passages count in whatever order they appear.

A benchmark of at most ``block_chars`` characters goes to the tasks as one block, in a single pass over
the documents that shuffles nothing. Beyond that the seeds of items and documents are joined by Spark,
and every pair that shares a seed it cannot do without is tiled by the same code, with the same result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import materialize, prepare, releasing, slices, texts_of

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_CHARS = 8_000_000
WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def rolled(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all windows of ``width`` numbers."""
    n = len(ids) - width + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        total = total * _BASE + ids[k : k + n]
    return total


def tiles(item_at: np.ndarray, doc_at: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, length) from the positions of equal windows.

    Longest first; ties by item position, then by document position.
    """
    order = np.lexsort((item_at, doc_at - item_at))
    a, b = item_at[order], doc_at[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (np.diff(b - a) != 0) | (np.diff(a) != 1)
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(a))) + width - 1
    heap = [(-int(n), int(a[i]), int(b[i])) for n, i in zip(runs, first)]
    heapq.heapify(heap)
    item_marks: set[int] = set()
    doc_marks: set[int] = set()
    found = []
    while heap:
        length, i, d = heapq.heappop(heap)
        length = -length
        free = [k for k in range(length) if i + k not in item_marks and d + k not in doc_marks]
        if len(free) == length:
            found.append((i, d, length))
            item_marks.update(range(i, i + length))
            doc_marks.update(range(d, d + length))
            continue
        start = 0
        for k in range(1, len(free) + 1):  # pieces of the match that are still unmarked
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= width:
                    heapq.heappush(heap, (start - k, i + free[start], d + free[start]))
                start = k
    return found


class Block:
    """Items of one block, ready for a pass over documents."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.vocabulary: dict[str, int] = {}
        self.items = []
        for item_id, text in items:
            words = words_of(text or "")
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if numbers:
                self.items.append((item_id, np.array(numbers, dtype=np.uint64)))
        self.seeds = []  # per width: sorted hashes, and the item and position of each
        for width in sorted({min(min_match, len(ids)) for _, ids in self.items}):
            hashes, item, at = [], [], []
            for n, (_, ids) in enumerate(self.items):
                if min(min_match, len(ids)) == width:
                    h = rolled(ids, width)
                    hashes.append(h)
                    item.append(np.full(len(h), n))
                    at.append(np.arange(len(h)))
            hashes, item, at = map(np.concatenate, (hashes, item, at))
            order = np.argsort(hashes, kind="stable")
            self.seeds.append((width, hashes[order], item[order], at[order]))

    def matches(self, text: str, coverage: float) -> Iterator[tuple]:
        """(item_id, item words, covered words, tiles) of the items covered far enough."""
        number = self.vocabulary.get
        ids = np.array([number(w, 0) for w in words_of(text)], dtype=np.uint64)
        known = ids != 0
        for width, hashes, item, at in self.seeds:
            n = len(ids) - width + 1
            if n <= 0:
                continue
            whole = known[:n].copy()
            for k in range(1, width):
                whole &= known[k : k + n]
            where = np.flatnonzero(whole)
            if not len(where):
                continue
            h = rolled(ids, width)[where]
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            times = high - low
            if not times.any():
                continue
            doc_at = np.repeat(where, times)
            seed = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            seed += np.repeat(low, times)
            for one in np.unique(item[seed]):
                own = item[seed] == one
                item_id, words = self.items[one]
                a, b = at[seed[own]], doc_at[own]
                # Seeds bound what tiles can cover.
                covered = np.zeros(len(words), dtype=bool)
                for k in range(width):
                    covered[a + k] = True
                if covered.sum() < coverage * len(words):
                    continue
                same = np.ones(len(a), dtype=bool)  # equal hashes, compared word by word
                for k in range(width):
                    same &= words[a + k] == ids[b + k]
                found = tiles(a[same], b[same], width)
                total = sum(length for _, _, length in found)
                if found and total >= coverage * len(words):
                    yield item_id, len(words), total, found


_TILE = ("item_at", "doc_at", "words")
_FOUND = "item_words int, covered int, coverage double, tiles array<struct<item_at:int,doc_at:int,words:int>>"
_PAIRS = "doc_id bigint, item_id bigint, " + _FOUND


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")


def block_of(items: DataFrame, min_match: int, block_chars: int) -> Block | None:
    """The items as one block, or None where they hold more than ``block_chars`` characters."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if total > block_chars:
        return None
    return Block([tuple(r) for r in items.orderBy("item_id", "text").collect()], min_match)


def _numbers(words: list[str]) -> np.ndarray:
    code = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.array([code[w] for w in words], dtype=np.uint64)


def _seeds(numbers: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows as signed longs, different for every width."""
    return ((rolled(numbers, width) * _BASE) ^ np.uint64(width)).view(np.int64)


def _item_seeds(min_match: int):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for code, text in zip(batch.column("code").to_pylist(), texts_of(batch, "text")):
                numbers = _numbers(words_of(text))
                if len(numbers):
                    width = min(min_match, len(numbers))
                    seeds = _seeds(numbers, width)
                    yield pa.RecordBatch.from_pydict({
                        "code": np.full(len(seeds), code),
                        "n": np.full(len(seeds), len(numbers), dtype=np.int32),
                        "width": np.full(len(seeds), width, dtype=np.int32),
                        "at": np.arange(len(seeds), dtype=np.int32),
                        "seed": seeds,
                    })

    return run


def needed(at: list[int], seed: list[int], common: list[int], n: int, width: int, coverage: float) -> list[int]:
    """Seeds of an item of which a covered document holds at least one.

    The most common seeds are left out as long as all places of those left out cover less than the
    share asked for, so a document that holds no other seed cannot reach it. Passages that many
    items share, such as instructions, then pair no documents.
    """
    places: dict[int, list[int]] = {}
    for i, one in zip(at, seed):
        places.setdefault(one, []).append(i)
    often = dict(zip(seed, common))
    order = sorted(places, key=lambda one: (-often[one], one))
    covered: set[int] = set()
    for k, one in enumerate(order):
        more = {j for i in places[one] for j in range(i, i + width)} - covered
        if len(covered) + len(more) >= max(1, coverage * n):
            return order[k:]
        covered |= more
    return []


def _needed(coverage: float):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row in batch.to_pylist():
                columns = [[s[name] for s in row["seeds"]] for name in ("at", "seed", "common")]
                kept = needed(*columns, row["n"], row["width"], coverage)
                yield pa.RecordBatch.from_pydict({
                    "code": np.full(len(kept), row["code"]), "seed": np.array(kept, dtype=np.int64)
                })

    return run


def _doc_seeds(widths: list[int]):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, codes = batch.column("doc_id").to_pylist(), batch.column("doc_code").to_pylist()
            for doc_id, code, text in zip(ids, codes, texts_of(batch, "text")):
                numbers = _numbers(words_of(text))
                seeds = np.unique(np.concatenate([_seeds(numbers, w) for w in widths]))
                for i in range(0, len(seeds), 100_000):
                    part = seeds[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(part), pa.int64()), pa.array(np.full(len(part), code)), pa.array(part)],
                        names=["doc_id", "doc_code", "seed"],
                    )

    return run


def _joined(rows: DataFrame, items: DataFrame, min_match: int, coverage: float) -> DataFrame:
    """The pairs by a join of seeds, with ``doc_code``; equal texts of items are compared once.

    Documents are named by id and text hash, so rows that repeat both are paired alike. Hashes only
    choose what is compared: a collision adds a comparison and changes no result.
    """
    items = materialize(items.withColumn("code", F.xxhash64("text")))
    texts = materialize(items.select("code", "text").distinct())
    seeds = materialize(
        texts.mapInArrow(_item_seeds(min_match), "code bigint, n int, width int, at int, seed bigint")
    )
    widths = sorted(r[0] for r in seeds.select("width").distinct().collect())  # at most min_match numbers
    if not widths:
        return rows.sparkSession.createDataFrame([], "doc_code bigint, " + _PAIRS)
    common = seeds.groupBy("seed").agg(F.count_distinct("code").alias("common"))
    wanted = materialize(
        seeds.join(common, "seed")
        .groupBy("code", "n", "width")
        .agg(F.collect_list(F.struct("at", "seed", "common")).alias("seeds"))
        .mapInArrow(_needed(coverage), "code bigint, seed bigint")
    )
    named = rows.withColumn("doc_code", F.xxhash64("text"))
    held = named.mapInArrow(_doc_seeds(widths), "doc_id bigint, doc_code bigint, seed bigint")
    pairs = materialize(held.join(wanted, "seed").select("doc_id", "doc_code", "code").distinct())
    compared = (
        named.alias("d")
        .join(
            pairs.alias("p").hint("merge"),
            F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.doc_code") == F.col("p.doc_code")),
        )
        .join(texts.alias("t").hint("merge"), F.col("p.code") == F.col("t.code"))
        .select("d.doc_id", "d.doc_code", "d.text", F.col("t.text").alias("item"))
    )
    lead = {"doc_id": pa.int64(), "doc_code": pa.int64(), "item": pa.string()}

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for row in batch.to_pylist():
                matches = Block([(None, row["item"])], min_match).matches(row["text"], coverage)
                found += [(row["doc_id"], row["doc_code"], row["item"], *m[1:]) for m in matches]
            yield _batch(found, lead)

    tiled = compared.mapInArrow(tile, "doc_id bigint, doc_code bigint, item string, " + _FOUND)
    # The text decides once more, so that equal hashes join no other item's id.
    tiled = tiled.withColumn("code", F.xxhash64("item"))
    one = items.select("item_id", F.col("text").alias("item"), "code").hint("merge")
    return tiled.join(one, ["code", "item"]).drop("code", "item")


def _batch(found: list[tuple], lead: dict[str, pa.DataType]) -> pa.RecordBatch:
    """(leading columns, item words, covered words, tiles) as a batch of pairs."""
    n = len(lead)
    rows = [
        (*f[:n], f[n], f[n + 1], f[n + 1] / f[n], [dict(zip(_TILE, t)) for t in sorted(f[n + 2])]) for f in found
    ]
    kinds = lead | {"item_words": pa.int32(), "covered": pa.int32(), "coverage": pa.float64()}
    kinds["tiles"] = pa.list_(pa.struct([(name, pa.int32()) for name in _TILE]))
    columns = [pa.array([r[i] for r in rows], type=kind) for i, kind in enumerate(kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs (document, item) whose tiles cover at least ``coverage`` of the item's words.

    Words are runs of letters and digits in lower case. An item of fewer than ``min_match`` words
    has to appear as a whole; an item or document without words (or null) matches nothing. Repeated
    documents and items are paired each; null ids are carried through; other columns are not
    read; an empty table gives no pairs.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    items = _items(benchmark)
    block = block_of(items, min_match, block_chars)
    if block is None:
        return _joined(rows, items, min_match, coverage).select(
            "doc_id", "item_id", "item_words", "covered", "coverage", "tiles"
        )
    shared = spark.sparkContext.broadcast(block)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                found += [(doc_id, *m) for m in shared.value.matches(text, coverage)]
            yield _batch(found, {"doc_id": pa.int64(), "item_id": pa.int64()})

    return rows.mapInArrow(run, _PAIRS)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, all columns, that :func:`contaminated` pairs with no item.

    With a benchmark of one block rows are dropped where they are read, so no join moves the texts;
    beyond it documents are dropped by id and text hash.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = _items(benchmark)
    block = block_of(items, min_match, block_chars)
    if block is None:
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        found = _joined(rows, items, min_match, coverage)
        gone = materialize(found.select(F.col("doc_id").alias("gone_id"), F.col("doc_code").alias("gone_code")).distinct())
        row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        own = F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("gone_id"))
        own &= F.xxhash64(F.col("row.text").cast("string")) == F.col("gone_code")
        return row.join(gone, own, "left_anti").select("row.*")
    shared = spark.sparkContext.broadcast(block)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hit = [next(shared.value.matches(t, coverage), None) for t in texts_of(batch, "text")]
            yield batch.filter(pa.array([h is None for h in hit], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

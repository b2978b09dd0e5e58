"""Minimax contiguous partition of ordered atomic groups into shards; DataFrame functions only.

Groups (rows of equal text) are ordered by their smallest id. The smallest shard capacity for which
a greedy pass needs no more than the given shards is found by binary search over ordered prefix
sums. The search works on a summary of bounded size: some known cut points (exact prefix sums) and,
between them, gaps. A greedy pass over the known points alone gives a capacity that is certainly
enough, one that may cut anywhere inside a gap one that is certainly needed. Gaps between the two
passes are refined from the stored table until both agree, so the capacity is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import materialize

POINTS = 20_000  # known cut points per refinement
CELL_ROWS = 5_000
LAW = "bytes"


@dataclass
class Known:
    """Known prefix sums in order; ``gap[i]`` says whether more lie between points i and i+1."""

    points: list[int]
    gap: list[bool]

    def reach(self, limit: int) -> int:
        """Greatest known prefix sum up to ``limit``."""
        return self.points[bisect_right(self.points, limit) - 1]

    def hope(self, limit: int) -> int:
        """No prefix sum up to ``limit``, known or not, is greater than this."""
        i = bisect_right(self.points, limit) - 1
        return limit if i < len(self.gap) and self.gap[i] else self.points[i]


def passes(step, total: int, capacity: int, shards: int) -> list[int]:
    """Ends of the shards that a greedy pass fills, the last one ``total`` if it suffices."""
    ends, at = [], 0
    for _ in range(shards):
        at = step(at + capacity)
        ends.append(at)
        if at >= total:
            break
    return ends


def smallest(step, total: int, low: int, high: int, shards: int) -> int:
    """Smallest capacity from ``low`` on with which the greedy pass reaches ``total``."""
    while low < high:
        middle = (low + high) // 2
        if passes(step, total, middle, shards)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def _ordered_groups(keyed: DataFrame) -> DataFrame:
    """One row per group: its place in the order, bytes, rows, and exact sums up to its end."""
    groups = keyed.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        groups.repartitionByRange(n, "first", "key").withColumn("part", F.spark_partition_id())
    )
    parts = placed.groupBy("part").agg(F.sum("bytes").alias("part_bytes"))
    # One row per range partition, so this window is as small as the number of partitions.
    before = parts.select(
        "part",
        (F.sum("part_bytes").over(Window.orderBy("part")) - F.col("part_bytes")).alias("bytes_before"),
    )
    inside = Window.partitionBy("part").orderBy("first", "key")
    return materialize(
        placed.withColumn("inside", F.sum("bytes").over(inside))
        .join(F.broadcast(before), "part")
        .select("key", "part", "bytes", "rows", (F.col("inside") + F.col("bytes_before")).alias("end"))
    )


def _points(groups: DataFrame, low: int, high: int, wanted: int) -> list[int]:
    """About ``wanted`` of the prefix sums between ``low`` and ``high``, both excluded."""
    width = max(1, (high - low) // max(1, wanted))
    inside = groups.where((F.col("end") > low) & (F.col("end") < high))
    found = inside.groupBy(F.floor((F.col("end") - low) / width)).agg(F.max("end").alias("end"))
    return sorted(r["end"] for r in found.select("end").collect())


def cuts(groups: DataFrame, shards: int, points: int = POINTS) -> tuple[int, list[int]]:
    """The exact minimax capacity, and the ends of the shards as prefix sums."""
    total, largest = groups.agg(F.max("end"), F.max("bytes")).first()
    if not total:
        return 0, []
    low = max(largest, -(-total // shards))
    found = _points(groups, 0, total, points)
    known = Known([0, *found, total], [True] * (len(found) + 1))
    exact = 1 if total <= points else 0
    while True:
        enough = smallest(known.reach, total, low, total, shards)
        needed = smallest(known.hope, total, low, enough, shards)
        if exact or needed == enough:
            return enough, _even(groups, known, total, enough, shards)
        # Cuts of the answer lie between those of the two passes; refine the gaps there.
        early, late = (passes(known.reach, total, needed, shards), passes(known.hope, total, enough, shards))
        spots: set[int] = set()
        for a, b in zip(early, late):
            first = max(0, bisect_right(known.points, a) - 1)
            spots.update(range(first, min(len(known.gap), bisect_left(known.points, b) + 1)))
        open_gaps = [i for i in sorted(spots) if known.gap[i]]
        if not open_gaps:
            open_gaps = [i for i, gap in enumerate(known.gap) if gap]
        if not open_gaps:
            exact = 1
            continue
        known = _refined(groups, known, open_gaps, points)


def _even(groups: DataFrame, known: Known, total: int, capacity: int, shards: int) -> list[int]:
    """Ends of the shards: as even as the capacity allows, not as full as it allows.

    Each cut is the group end nearest to its even share, if the shard up to there keeps to the
    capacity and the rest still fits the shards left; else it is the greedy pass's.
    """
    shares = [total * j // shards for j in range(1, shards)]
    below = [F.max(F.when(F.col("end") <= t, F.col("end"))) for t in shares]
    above = [F.min(F.when(F.col("end") > t, F.col("end"))) for t in shares]
    row = list(groups.agg(*below, *above).first())
    near = Known(sorted({*known.points, *(p for p in row if p)}), [])
    ends, at = [], 0
    for j, share in enumerate(shares):
        def fits(end: int) -> bool:
            place = end
            for _ in range(shards - j - 1):
                place = near.reach(place + capacity)
            return at <= end <= at + capacity and place >= total

        options = sorted((p for p in (row[j], row[j + len(shares)]) if p), key=lambda p: abs(p - share))
        at = next((p for p in options if fits(p)), near.reach(at + capacity))
        ends.append(at)
        if at >= total:
            break
    return ends if ends and ends[-1] >= total else [*ends, total]


def _with_gaps(groups: DataFrame, edges: list[tuple[int, int]], widths: list[int]) -> DataFrame:
    """The groups that end inside one of the gaps, which are apart and in order, with its number and ``width``.

    Gaps are listed under the equal buckets they touch, of which there are twice as many as gaps, so a
    group meets the few gaps of its bucket. The list has at most four rows a gap.
    """
    start, size = edges[0][0], max(1, -(-(edges[-1][1] - edges[0][0]) // (2 * len(edges))))
    listed = [
        (bucket, n, a, b, width)
        for n, ((a, b), width) in enumerate(zip(edges, widths))
        for bucket in range((a - start) // size, (b - start) // size + 1)
    ]
    frame = groups.sparkSession.createDataFrame(
        listed, "bucket bigint, gap int, low bigint, high bigint, width bigint"
    )
    inside = groups.where((F.col("end") > start) & (F.col("end") < edges[-1][1]))
    inside = inside.withColumn("bucket", F.expr(f"(`end` - {start}) div {size}"))
    return inside.join(F.broadcast(frame), "bucket").where("`end` > low AND `end` < high")


def _refined(groups: DataFrame, known: Known, open_gaps: list[int], points: int) -> Known:
    """Cut points added inside the given gaps, in one job; each gap gets its share of ``points``."""
    share = max(2, points // len(open_gaps))
    edges = [(known.points[i], known.points[i + 1]) for i in open_gaps]
    rows = _with_gaps(groups, edges, [max(1, -(-(b - a) // share)) for a, b in edges])
    found = (
        rows.groupBy("gap", F.floor((F.col("end") - F.col("low")) / F.col("width")).alias("bin"), "width")
        .agg(F.max("end").alias("end"), F.min("end").alias("first"))
        .select("gap", "end", (F.col("first") < F.col("end")).alias("more"))
        .orderBy("gap", "end")
        .collect()  # at most ``points`` and one per gap
    )
    inner: dict[int, list] = {}
    for gap, end, more in found:
        inner.setdefault(open_gaps[gap], []).append((end, more))
    refine = set(open_gaps)
    out_points, out_gap = [known.points[0]], []
    for i, gap in enumerate(known.gap):
        if i in refine:
            # A bin's points lie before its greatest one; past the last bin there is none.
            for end, more in inner.get(i, []):
                out_points.append(end)
                out_gap.append(more)
            out_gap.append(False)
        else:
            out_gap.append(gap)
        out_points.append(known.points[i + 1])
    return Known(out_points, out_gap)


def shard_rows(docs: DataFrame, shards: int = 24, points: int = POINTS) -> DataFrame:
    """One row per document: its size, its shard, and its slot there (gapless from 0).

    The size is the UTF-8 length of the text and 8 (a null text has none and counts 8). Rows of equal
    text form one group, null texts another, and a group is never split; a group that outweighs
    the even share sets the capacity. Groups are ordered by smallest ``doc_id`` (null first), then
    by text hash; slots by group and, within a hot group, by row hash. Repeated rows are rows
    like others; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("")).alias("key"),
    )
    keyed = materialize(keyed)
    groups = _ordered_groups(keyed)
    _, ends = cuts(groups, shards, points)
    ends_column = F.lit(ends) if ends else F.array().cast("array<bigint>")
    groups = groups.withColumn("shard", F.size(F.filter(ends_column, lambda e: e < F.col("end"))))
    rows = keyed.join(groups.select("key", "part", "end", "shard"), "key")
    # Slots without a task per shard: rows are numbered in small cells, cells counted up.
    sizes = groups.groupBy("shard", "part").agg(F.sum("rows").alias("cell_rows"))
    split = sizes.select("shard", "part", F.ceil(F.col("cell_rows") / CELL_ROWS).cast("bigint").alias("cells"))
    rows = rows.join(F.broadcast(split), ["shard", "part"]).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "key"), F.col("cells"))
    )
    rows = materialize(rows.select("doc_id", "size", "text_crc32", "shard", "part", "cell", "end"))
    counted = rows.groupBy("shard", "part", "cell").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("part", "cell")
    before = counted.select("shard", "part", "cell", (F.sum("n").over(upto) - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard", "part", "cell").orderBy("end", "doc_id")
    return (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(before, ["shard", "part", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("before") + F.col("at")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

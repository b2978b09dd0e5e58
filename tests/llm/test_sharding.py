import random
import zlib

import pytest
from llm_cases import documents, hard
from pyspark.sql import functions as F

from skylattice.llm import sharding


def minimax(sizes, shards):
    def fits(capacity):
        used, fill = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if fill + s > capacity:
                used, fill = used + 1, 0
            fill += s
        return used <= shards

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("points", [20_000, 7, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_capacity_is_the_minimum(spark, points, seed):
    rng = random.Random(seed)
    texts = ["x" * rng.choice([1, 5, 40, 41, 300, 2000]) + str(rng.randint(0, 200)) for _ in range(260)]
    texts += ["hot text"] * 100
    rows = sharding.shard_rows(documents(spark, texts), shards=9, points=points).collect()
    group = {}
    for i, t in enumerate(texts):
        first, size = group.get(t, (i, 0))
        group[t] = (first, size + len(t.encode()) + 8)
    sizes = [size for _, size in sorted(group.values())]
    filled = {}
    for r in rows:
        filled[r["shard"]] = filled.get(r["shard"], 0) + r["size"]
    assert max(filled.values()) == minimax(sizes, 9)
    assert set(filled) <= set(range(9))
    place = {r["doc_id"]: r["shard"] for r in rows}
    assert all(len({place[i] for i, x in enumerate(texts) if x == t}) == 1 for t in group)
    order = [place[first] for first, _ in sorted(group.values())]
    assert order == sorted(order)
    for shard in filled:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in rows))
        )
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)


def test_even_sizes(spark):
    rows = sharding.shard_rows(documents(spark, [f"text {i:05}" for i in range(2400)]), shards=24)
    sizes = [r["n"] for r in rows.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 * 18


def test_hard_rows(spark):
    got = sharding.shard_rows(hard(spark)).collect()
    assert len(got) == 11
    assert sorted(r["size"] for r in got if r["doc_id"] in (1, 2)) == [8, 8]
    assert len({r["shard"] for r in got if r["doc_id"] in (5, 6)}) == 1
    assert sharding.shard_rows(hard(spark).limit(0)).count() == 0
    assert sharding.shard_rows(documents(spark, ["only"])).count() == 1


def test_every_row_meets_its_gap(spark):
    """Wide, narrow, touching and single gaps: each row with the gap around it, and the list stays short."""
    rng = random.Random(17)
    for gaps in (1, 2, 60):
        bounds = sorted(rng.sample(range(1, 4000), 2 * gaps) if gaps < 60 else rng.sample(range(1, 300), 60) + rng.sample(range(300, 10**9), 60))
        edges = list(zip(bounds[::2], bounds[1::2])) if gaps < 60 else list(zip(bounds, bounds[1:]))
        ends = {e for a, b in edges for e in (a, a + 1, (a + b) // 2, b - 1, b)} | set(range(0, 4000, 7))
        groups = spark.createDataFrame([(e,) for e in sorted(ends)], "end bigint")
        got = sharding._with_gaps(groups, edges, [b - a for a, b in edges]).select("end", "gap", "width").collect()
        want = [(e, n, b - a) for e in sorted(ends) for n, (a, b) in enumerate(edges) if a < e < b]
        assert sorted(map(tuple, got)) == want

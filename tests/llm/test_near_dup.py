import random

import numpy as np
import pytest
from llm_cases import SCHEMA, brute_components, documents, hard, sentence

from pyspark.sql import functions as F

from skylattice.llm import graph, near_dup
from skylattice.llm.graph import components


def word_sets(texts, k):
    out = {}
    for i, text in enumerate(texts):
        words = (text or "").split()
        width = min(k, len(words))
        out[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} if width else set()
    return out


def mutated(rng, text, share):
    return " ".join(sentence(rng, 1) if rng.random() < share else w for w in text.split())


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_all_pairs(spark, k):
    rng = random.Random(k)
    base = [sentence(rng, 80) for _ in range(6)]
    texts = [mutated(rng, rng.choice(base), rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(150)]
    texts += [None, "", "  ", "one two", "one two", "one three", *base]
    sets = word_sets(texts, k)
    want = brute_components(list(sets), sets)
    got = near_dup.near_duplicates(documents(spark, texts), k=k).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_complete_comparison_crosses_block_borders(spark):
    """Chains that the star round cannot see, in blocks of three."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[s : s + 100]) for s in range(0, 200, 8)]
    sets = word_sets(texts, 4)
    nodes = spark.createDataFrame(
        [(i, 0, i) for i in sets], "node bigint, `group` bigint, comp bigint"
    )
    hashes = near_dup.Words()
    shingles = spark.createDataFrame(
        [(i, near_dup.shingles(t, 4, hashes).view(np.int64).tolist()) for i, t in enumerate(texts)],
        "node bigint, shingles array<bigint>",
    )
    found = near_dup.complete(nodes, shingles, 80, block=3)
    got = {r["node"]: r["label"] for r in components(found).collect()}
    want = brute_components(list(sets), sets)
    assert {i: got.get(i, i) for i in sets} == want


def test_ascii_case_only():
    hashes = near_dup.Words()
    same = lambda a, b: (near_dup.shingles(a, 4, hashes) == near_dup.shingles(b, 4, hashes)).all()
    assert same("A b C d", "a B\tc\x0b\x0cD")
    assert not same("É b c d", "é b c d")
    assert len(near_dup.shingles("a b c d", 4, hashes)) == 1
    assert not same("a b c", "a b c")


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(900, 901)], "u bigint, v bigint")
    got = {r["node"]: r["label"] for r in components(chain).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900}


@pytest.mark.parametrize("per_task", [3, 20, 100_000])
def test_components_at_every_size(spark, per_task):
    """In one task, in several, and in rounds: the same labels."""
    rng = random.Random(per_task)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    links += [(None, 3), (3, None), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "u bigint, v bigint"), per_task).collect()}
    parent = {i: i for i in range(600)}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    linked = {x for u, v in links if None not in (u, v) and u != v for x in (u, v)}
    assert got == {i: root(i) for i in linked}
    assert components(spark.createDataFrame([], "u bigint, v bigint"), per_task).count() == 0


def test_dense_links_become_about_one_a_node(spark):
    """Every node with many hubs, as in a large group of near copies: tasks send on stars only."""
    links = spark.range(3000).select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hub"), F.col("id").alias("v"))
    links = links.select(F.pmod(F.xxhash64("v", "hub"), F.lit(60)).alias("u"), (F.col("v") + 100).alias("v"))
    cut = graph._starred(links.repartition(50, "v"), 100_000)
    assert links.count() == 72_000
    assert cut.count() <= 3000 + 50 * 60
    again = graph._starred(cut.coalesce(1), 100_000)
    assert again.count() == 3060 - 1
    assert components(links).where("label <> 0").count() == 0


def test_stars_keep_components():
    rng = np.random.default_rng(1)
    for n in (2, 10, 300):
        u, v = rng.integers(0, n, 2 * n), rng.integers(0, n, 2 * n)
        low, node = graph.stars(u, v)
        label = dict(zip(node.tolist(), low.tolist()))
        lead = lambda x: label.get(x, x)
        assert len(label) == len(node) and all(lead(a) == lead(b) for a, b in zip(u.tolist(), v.tolist()))
        assert all(x < y for y, x in label.items())


def test_hard_and_empty_tables(spark):
    docs = hard(spark)
    got = near_dup.near_duplicates(docs, k=5).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"] > 0, r["component_id"], r["kept"]))
    assert by[None] == [(True, None, True), (False, None, True)] or by[None] == [(False, None, True), (True, None, True)]
    assert by[5] == [(True, 5, True)] and by[6] == [(True, 5, False)] * 2
    assert [by[i] for i in (1, 2, 3)] == [[(False, i, True)] for i in (1, 2, 3)]
    assert all(by[i] == [(True, i, True)] for i in (4, 7, 8))
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0

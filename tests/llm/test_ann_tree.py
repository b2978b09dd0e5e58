import numpy as np
from pyspark.sql import functions as F

from skylattice.llm import ann_tree
from skylattice.llm.queries import OPERATORS

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def exact(rows, query, top=20):
    x = dict(rows)
    score = {}
    for i, v in rows:
        if i != query:
            total = 0.0
            for a, b in zip(np.float32(x[query]).astype(float), np.float32(v).astype(float)):
                total += a * b
            score[i] = total
    return sorted(score.items(), key=lambda s: (-s[1], s[0]))[:top]


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = ann_tree.search(vectors(spark, rows), sample=1500).collect()
    by = {}
    for r in found:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 3000, 20))
    hits = 0
    for query, got in by.items():
        want = exact(rows, query)
        true = dict(want)
        hits += sum(r["vec_id"] in true for r in got)
        assert all(r["score"] == true[r["vec_id"]] for r in got if r["vec_id"] in true)
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
    assert hits >= 0.9 * 20 * len(by)


def test_hot_vector_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.5]) for i in range(3000)] + [(i, [0.5, 0.1 * i / 3100]) for i in range(3000, 3100)]
    found = ann_tree.search(vectors(spark, rows)).where("query_id = 40").orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(20))


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1, 0]), (1, None), (2, [0, 0]), (3, [float("nan"), 1]), (4, [float("inf"), 1]), (5, [None, 1]), (6, [1, 1]), (None, [1, 1]), (20, [0, 0]), (7, [1, 2, 3])]
    found = ann_tree.search(vectors(spark, rows)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 6, 1.0)]


def test_empty_small_and_clashing(spark):
    none = vectors(spark, [(0, [1.0])]).limit(0)
    assert ann_tree.search(none).count() == 0
    assert ann_tree.search(vectors(spark, [(0, [1.0, 2.0])])).count() == 0
    assert ann_tree.search(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    clash = vectors(spark, [(0, [1.0, 2.0]), (1, [2.0, 2.0])])
    clash = clash.withColumns({n: F.lit("mine") for n in ("x", "leaf", "cell", "score", "rank", "query_id")})
    assert ann_tree.search(clash).count() == 1


def test_every_leaf_is_reached_once():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    tree = ann_tree.build(x, branch=3, leaf_rows=20)
    leaves, far = zip(*tree.order(x[0], tree.leaves))
    assert sorted(leaves) == list(range(tree.leaves)) and list(far) == sorted(far)
    assert set(tree.route(x)) <= set(range(tree.leaves))


def test_every_query_gets_all_its_rows(spark):
    """Tight clusters satisfy the calibration with few leaves; a small one apart needs more."""
    rng = np.random.default_rng(11)
    centres = 20 * np.eye(16)
    rows = [(20 * i + (j > 0) * j, centres[i % 12]) for i in range(60) for j in range(19)]
    rows += [(100_000 + j, centres[15]) for j in range(8)]
    rows.append((100_000, centres[15]))  # a row of the query's own id counts for no neighbour
    data = [(n, (c + rng.normal(size=16) * 0.01).tolist()) for n, c in rows]
    found = ann_tree.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"))
    got = {r["query_id"]: r["n"] for r in found.groupBy("query_id").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {n for n, _ in data if n % 20 == 0}
    assert set(got.values()) == {ann_tree.TOP}


def grouped(rng, n, groups=60, width=12):
    x = rng.normal(size=(groups, width))[rng.integers(0, groups, n)] + rng.normal(size=(n, width)) * 0.15
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def placed_at_top(spark, x, sample):
    tree = ann_tree.build(ann_tree._extended(x[:sample], 1.0))
    at = tree.route(ann_tree._extended(x, 1.0))
    rows = [(i, v.tolist(), str(leaf)) for i, (v, leaf) in enumerate(zip(x, at))]
    return spark.createDataFrame(rows, "vec_id bigint, x array<double>, leaf string")


def test_leaves_stay_of_one_size_and_no_row_is_lost(spark):
    """Ten times the rows, and a vector many times over: as large leaves, but more of them."""
    rng = np.random.default_rng(4)
    sizes = {}
    for n in (600, 6000):
        x = grouped(rng, n)
        x[: n // 3] = x[0]
        placed, levels = ann_tree.grow(placed_at_top(spark, x, 300), 1.0, 100, 300)
        rows = placed.collect()
        assert sorted(r["vec_id"] for r in rows) == list(range(n)) and (n == 600 or len(levels) >= 1)
        assert all(np.array_equal(r["x"], x[r["vec_id"]]) for r in rows)
        leaves = {}
        for r in rows:
            leaves.setdefault(r["leaf"], set()).add(tuple(r["x"]))
        sizes[n] = len(leaves)
        assert max(map(len, leaves.values())) <= 110  # counted approximately
        copies = {r["leaf"] for r in rows if r["vec_id"] < n // 3}
        assert len(copies) == 1
    assert sizes[6000] > 3 * sizes[600]


def test_recall_over_levels(spark):
    """A top of few leaves and two or more levels below it, against all scores."""
    rng = np.random.default_rng(7)
    x = grouped(rng, 5000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = ann_tree.search(table, sample=150, leaf_most=60, fit_rows=200).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = 0
    for query in range(0, 5000, 20):
        score = x @ x[query]
        score[query] = -np.inf
        true = np.lexsort((np.arange(5000), -score))[:20].tolist()
        assert len(got[query]) == 20 and all(abs(s - score[i]) < 1e-12 for i, s in got[query].items())
        hits += len(set(true) & set(got[query]))
    assert hits >= 0.9 * 20 * 250


def test_order_goes_on_below_as_one_queue():
    """Leaves of an upper tree and of the trees below it, ordered together: those of the nearest paths first."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 5))
    top = ann_tree.build(x, branch=3, leaf_rows=150)
    at = top.route(x)
    below = {n: ann_tree.build(x[at == n], branch=3, leaf_rows=20) for n in range(top.leaves)}
    query = x[7]
    first = top.order(query, top.leaves)
    merged = sorted(
        (far, leaf, n) for leaf, above in first for n, far in below[leaf].order(query, below[leaf].leaves, above=above)
    )
    assert all(far >= dict(first)[leaf] for far, leaf, _ in merged)
    own = top.route(x[7:8])[0]
    assert (own, below[own].route(x[7:8])[0]) in [(leaf, n) for _, leaf, n in merged[: len(merged) // 2]]


def test_levels_with_hot_vector_and_repeated_ids(spark):
    """Ties go to smaller ids, ids asked twice and rows of one's own id behave as without levels."""
    rng = np.random.default_rng(3)
    data = [(i, [1.0, 0.5]) for i in range(2000)] + [(2000 + i, [0.5, i / 2000]) for i in range(1000)]
    data += [(20, [0.4, 0.3]), (20, [0.4, 0.3]), (2020, rng.normal(size=2).tolist())]
    table = vectors(spark, data)
    a = ann_tree.search(table, sample=60, leaf_most=20, fit_rows=100, recall=1.0).where("query_id = 40").orderBy("rank").collect()
    assert [r["vec_id"] for r in a] == list(range(20))
    n = ann_tree.search(table, sample=60, leaf_most=20, fit_rows=100).groupBy("query_id").count().collect()
    assert {r["count"] for r in n} == {20} and len(n) == 150


def test_recall_on_the_given_table(spark, small_sf):
    """The registered query on evenly spread vectors, against all scores."""
    folder = small_sf.replace("0.001", "0.01")
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").where("embedding IS NOT NULL").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = {}
    for r in OPERATORS["op6_neighbours"](spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        true = ids[np.lexsort((ids, -score))[:20]].tolist()
        shares.append(len(got[ids[i]].intersection(true)) / 20)
    assert len(shares) >= 20 and np.mean(shares) >= 0.9

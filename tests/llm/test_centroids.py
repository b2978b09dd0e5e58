import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylattice.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows, clusters=8, rounds=10, dimensions=64):
    """Every distance in Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(1024 * float(c)) for c in v]))
    code = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else code(r[0]), r[1]))
    at = [x for _, x in order[:clusters]]

    def assign():
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in at]
            out.append((i, min(range(len(at)), key=lambda k: (d[k], k)), min(d), x))
        return out

    for _ in range(rounds):
        found = assign()
        for k in range(len(at)):
            own = [x for _, c, _, x in found if c == k]
            if own:
                at[k] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    of = [sum(d for _, c, d, _ in found if c == k) for k in range(len(at))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted((repr(i), c, d, of[c], sum(of), sha[c]) for i, c, d, _ in found)


def run(spark, rows, **options):
    assigned, found, shares = centroids.cluster(vectors(spark, rows), **options)
    got = centroids.digest(assigned, found).collect()
    names = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((repr(r["vec_id"]), *[r[n] for n in names]) for r in got), shares


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64) * 0.2) for i in range(300)]
    got, _ = run(spark, rows)
    assert got == brute(rows)


def test_grouped_vectors_skip_most_distances(spark):
    rng = np.random.default_rng(4)
    places = rng.normal(size=(8, 64))
    rows = [(i, places[i % 8] + rng.normal(size=64) * 0.01) for i in range(400)]
    got, shares = run(spark, rows)
    assert got == brute(rows)
    assert shares[-1] < 0.35  # one of eight is the least


def test_ties_copies_nulls_and_odd_rows(spark):
    flat = [0.0] * 64
    one = [1.0] + flat[1:]
    rows = [(i, flat) for i in range(20)] + [(i, one) for i in range(20, 30)] + [(5, flat), (None, one), (None, flat)]
    rows += [(40, None), (41, [1.0]), (42, flat + [0.0]), (43, [None] + flat[1:]), (44, [math.nan] + flat[1:]), (45, [-math.inf] + flat[1:])]
    got, _ = run(spark, rows)
    assert got == brute(rows) and len(got) == 33


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [-0.5] * 64)]
    got, _ = run(spark, rows)
    assert got == brute(rows)
    assert run(spark, rows[:0] + [(1, None)])[0] == []


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e6] * 64), (2, [-1e6] * 64), (3, [3e15] + [0.0] * 63), (4, [-3e15] + [0.0] * 63), (5, [0.25] * 64)]
    got, _ = run(spark, rows, clusters=2)
    want = brute(rows, clusters=2)
    long = lambda n: n if n < 2**63 else None
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == [long(r[2]) for r in want]
    assert {r[4] for r in got} == {long(want[0][4])}


def test_clashing_columns_and_partitions_change_nothing(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=64)) for i in range(120)]
    df = vectors(spark, rows).withColumns({n: F.lit("mine") for n in ("x", "away", "cluster", "distance", "slot", "code")})
    assigned, found, _ = centroids.cluster(df.repartition(7))
    got = sorted((r["vec_id"], r["cluster"], r["distance"]) for r in assigned.collect())
    assert {repr(i): (c, d) for i, c, d in got} == {r[0]: r[1:3] for r in brute(rows)}
    assert len(found) == 8


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 6), st.sampled_from([1, 50, 10**6, 10**12]))
def test_bounds_never_exceed_distances(seed, clusters, scale):
    rng = np.random.default_rng(seed)
    draw = lambda n: [[int(c) for c in v] for v in rng.integers(-scale, scale + 1, (n, 5))]
    pivots, at, x = draw(4), draw(clusters), draw(30)
    away = np.array([[centroids._distance(v, p) for p in pivots] for v in x])
    below = centroids.Bounds.of(at, pivots).below(away)
    for i, v in enumerate(x):
        for j, c in enumerate(at):
            assert below[i, j] ** 2 * (1 - centroids.SLACK) <= sum((a - b) ** 2 for a, b in zip(v, c)) * (1 + centroids.SLACK)


@pytest.mark.parametrize("a", [[0], [2**80, 3], [1, 2, 2]])
def test_distance_of_large_integers(a):
    assert centroids._distance(a, [0] * len(a)) == pytest.approx(math.sqrt(sum(x * x for x in a)), rel=1e-14)

import math
import random
from collections import defaultdict

import pytest
from llm_cases import SCHEMA, documents, hard, sentence
from pyspark.sql import functions as F

from skylattice.llm import mixing

UNIT = 1 << mixing.UNIT_BITS


def shared(words, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again and again."""
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = {s for s in words if not words[s]}
    while True:
        rest = sum(words.values()) - sum(most * words[s] for s in full)
        total = sum(weight[s] for s in words if s not in full)
        target = {s: most * words[s] if s in full else rest * weight[s] / total for s in words}
        above = {s for s in words if s not in full and target[s] > most * words[s]}
        if not above:
            return target
        full |= above


def brute(docs, most=3):
    """Copies of (id, source, size, hash) rows: bisection for the tilt, then the documents end to end."""
    by = defaultdict(list)
    for d in docs:
        by[d[1]].append(d)
    words = {s: sum(d[2] for d in own) for s, own in by.items()}
    target = shared(words, most=most)
    out = {}
    for s, own in by.items():
        low, high = -50.0, 5.0
        for _ in range(200):
            middle = (low + high) / 2
            got = sum(d[2] * min(most, math.exp(min(middle * d[2], 50))) for d in own)
            low, high = (middle, high) if got < target[s] else (low, middle)
        lam = 0.0 if not target[s] else high
        rates = [(d, round(min(most, math.exp(min(lam * d[2], 50))) * UNIT)) for d in sorted(own, key=lambda d: (-d[2], d[3], d[0]))]
        best = None
        for k in range(mixing.OFFSETS):
            at = k * (UNIT // mixing.OFFSETS)
            copies = {}
            for d, r in rates:
                copies[d[0]] = (at + r) // UNIT - at // UNIT
                at += r
            away = abs(sum(copies[d[0]] * d[2] for d in own) - target[s])
            if best is None or away < best[0]:
                best = away, copies
        out |= best[1]
    return out, target


def rows_of(spark, seed, n=400):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.choice([1, 2, 3, 8, 8, 30, 200, rng.randint(1, 90)])) for _ in range(n)]
    texts[5], texts[6] = None, " \t\n"
    names = [None, "b", "a", "é", "Z", "zz"]
    source = [rng.choices(names, [1, 30, 2, 5, 1, 2])[0] for _ in texts]
    data = [(i, t, "en", s, 0) for i, (t, s) in enumerate(zip(texts, source))]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, seed):
    docs = rows_of(spark, seed)
    hashed = docs.select("doc_id", "source", mixing.words(F.col("text")), F.xxhash64("doc_id", "text")).collect()
    want, target = brute([tuple(r) for r in hashed])
    got = {r["doc"]["doc_id"]: r for r in mixing.mix(docs, keep=["doc_id"], cell_rows=3).collect()}
    assert len(got) == 400
    assert {i: r["copies"] for i, r in got.items()} == want
    for r in got.values():
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)


def test_targets_longest_document_and_ceiling(spark):
    got = mixing.digest(mixing.mix(rows_of(spark, 3))).join(rows_of(spark, 3).select("doc_id", "source"), "doc_id").collect()
    by = defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    for own in by.values():
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        away = abs(sum(r["taken"] for r in own) - own[0]["target"])
        assert away <= max(r["size"] for r in own) / 2 + 1
    assert sum(own[0]["target"] for own in by.values()) == pytest.approx(sum(r["size"] for r in got))


def test_rates_are_exponential_in_size(spark):
    got = mixing.mix(rows_of(spark, 4), keep=["doc_id"]).where("size > 0 AND rate < 3").collect()
    tilt = defaultdict(list)
    for r in got:
        tilt[r["source"]].append(math.log(r["rate"]) / r["size"])
    for own in tilt.values():
        assert max(own) - min(own) < 1e-6


def test_layout_changes_nothing(spark):
    docs = rows_of(spark, 5)
    one = sorted(map(repr, mixing.digest(mixing.mix(docs.coalesce(1))).collect()))
    many = sorted(map(repr, mixing.digest(mixing.mix(docs.repartition(13), cell_rows=2)).collect()))
    assert one == many


def test_hot_class_of_copies(spark):
    """Many documents of one size: their copies are counted, not drawn."""
    texts = ["a b c d"] * 3000 + ["e f"] * 10
    rows = [(i, t, "en", "hot" if i < 3000 else "x", 0) for i, t in enumerate(texts)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), keep=["doc_id"], cell_rows=50).collect()
    hot = [r["copies"] for r in got if r["source"] == "hot"]
    assert len(hot) == 3000 and set(hot) == {0, 1}
    assert abs(4 * sum(hot) - (12020 - 60)) <= 4
    assert [r["copies"] for r in got if r["source"] == "x"] == [3] * 10


def test_hard_and_empty_tables(spark):
    docs = hard(spark)
    mixed = mixing.mix(docs)
    got = mixed.collect()
    assert len(got) == docs.count()
    assert all(r["size"] == len((r["doc"]["text"] or "").split()) for r in got)
    copies = mixing.mixture(mixed)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["copies"] for r in got)
    digest = mixing.digest(mixed).collect()
    assert len(digest) == len(got) and all(r["taken"] == 0 for r in digest if r["size"] == 0)
    assert mixing.digest(mixing.mix(docs.limit(0))).count() == 0
    blank = documents(spark, [None, "", " "])
    assert [tuple(r) for r in mixing.digest(mixing.mix(blank)).orderBy("doc_id").collect()] == [(i, 0, 0, 0.0, 0) for i in range(3)]


def test_one_source_keeps_every_document_once(spark):
    docs = documents(spark, [sentence(random.Random(i), i + 1) for i in range(30)])
    assert {r["copies"] for r in mixing.mix(docs).collect()} == {1}


def test_own_size_weights_and_share(spark):
    docs = documents(spark, [f"text {i}" for i in range(60)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 2))
    mixed = mixing.mix(docs, size=F.col("doc_id") + 1, weights=(1, 3), share=0.5).collect()
    total = defaultdict(int)
    for r in mixed:
        total[r["source"]] += r["copies"] * r["size"]
    assert total["s0"] == pytest.approx(0.125 * 1830, abs=30) and total["s1"] == pytest.approx(0.375 * 1830, abs=30)


def test_places_over_many_partitions(spark):
    names = [f"n{i:03}" for i in range(200)] + [None, "é", "a\U0001f600", "￿"]
    sources = spark.createDataFrame([(n, 7) for n in names], "source string, words bigint").repartition(9)
    got = {r["source"]: r["place"] for r in mixing._numbered(sources).collect()}
    want = sorted(names, key=lambda s: (s is None, (s or "").encode()))
    assert got == {s: i for i, s in enumerate(want)}


def test_rows_read_every_round_are_in_few_files(spark, monkeypatch):
    written = []

    def stored(df):
        out = materialize(df)
        written.append((sorted(df.columns), len(out.inputFiles())))
        return out

    materialize = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", stored)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        docs = documents(spark, ["word " * (n % 30) for n in range(90)])
        docs = docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 20))
        assert mixing.mix(docs).count() == 90
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    rounds = [n for columns, n in written if "lam" in columns and "open" in columns]
    classes = [n for columns, n in written if columns == ["n", "size", "source"]]
    assert rounds and classes and set(rounds + classes) == {1}

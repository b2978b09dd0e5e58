"""Stages of the pipeline against what each should keep of its own input."""

import random
import re

from compare import differences, duck
from llm_cases import SCHEMA, brute_components, documents, hard, sentence

import __spark_entry__ as contract
import corpus_pipeline
from skylattice.llm import tiling
from skylattice.llm.oracles import ORACLES
from skylattice.llm.queries import OPERATORS
from skylattice.llm.rows import read

SF = "/root/testdata/sf0.001"
NAMES = ["language", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in OPERATORS} == set(range(1, 14))
    assert {"pipeline", *OPERATORS} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_oracles(spark):
    connection = duck(SF)
    for name, sql in ORACLES.items():
        assert differences(OPERATORS[name](spark, SF), connection, sql) == [], name


def test_language_stage_keeps_what_has_a_language(spark):
    docs = documents(spark, ["the house and the", None, "123 ...", ""])
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]


def test_language_stage_without_labels(spark):
    texts = ["the house and the", None, "123 ...", "", "la maison et la"]
    for langs in ([None] * 5, ["und"] * 5, [None, "en", "en", "en", None]):
        kept = corpus_pipeline.identify_language(spark, documents(spark, texts, langs), SF)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 4], langs


def run_over(spark, monkeypatch, docs):
    stored = read
    monkeypatch.setattr(corpus_pipeline, "read", lambda s, d, name: docs if name == "documents" else stored(s, d, name))
    return corpus_pipeline.run(spark, SF)


def ids_after_run(spark, monkeypatch, docs):
    return sorted(r["doc_id"] for r in run_over(spark, monkeypatch, docs).select("doc_id").distinct().collect())


def test_run_without_labels(spark, monkeypatch):
    rng = random.Random(8)
    docs = documents(spark, [sentence(rng, 40) for _ in range(6)], [None] * 6)
    assert ids_after_run(spark, monkeypatch, docs) == list(range(6))


def test_run_over_hard_and_empty_tables(spark, monkeypatch):
    """Documents without letters go; the long one, the twins' first and those without an id or label stay."""
    kept = [
        r["doc_id"] for r in run_over(spark, monkeypatch, hard(spark)).select("doc_id").distinct().collect()
    ]
    assert set(kept) == {None, 4, 5, 7, 8}
    assert run_over(spark, monkeypatch, spark.createDataFrame([], SCHEMA)).count() == 0


def test_run_keeps_one_of_each_group_of_equal_texts(spark, monkeypatch):
    rng = random.Random(9)
    groups = [
        "\n".join(rng.choice(["", " "]) if rng.random() < 0.2 else sentence(rng, 12) for _ in range(2 + n))
        for n in range(16)
    ]
    groups.append(sentence(rng, 40))
    docs = documents(spark, [g for g in groups for _ in range(3)])
    assert ids_after_run(spark, monkeypatch, docs) == [3 * n for n in range(len(groups))]


def test_line_stage_drops_emptied_documents_only(spark):
    rng = random.Random(3)
    text = "\n".join(sentence(rng) for _ in range(40))
    docs = documents(spark, [text, "own line one\nown line two", "", None])
    kept = corpus_pipeline.dedup_lines(spark, docs.union(documents(spark, [text]).selectExpr("doc_id + 9", "text", "lang", "source", "n_chars")), SF)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert {0, 1, 2, 3} <= set(rows) and rows[0]["text"] == text
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows.values())


def test_near_stage_keeps_one_of_each_group(spark):
    rng = random.Random(4)
    base = sentence(rng, 120)
    near = base.rsplit(" ", 3)[0] + " other words here"
    docs = documents(spark, [base, sentence(rng, 50), near, base, None, ""])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 4, 5]


def test_run_over_given_documents(spark):
    """The whole pipeline, with its filtering stages redone by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = corpus_pipeline.identify_language(spark, docs, SF)
    cut = corpus_pipeline.dedup_lines(spark, given, SF).collect()
    sets = {}
    for r in cut:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
        width = min(5, len(words))
        sets[r["doc_id"]] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()
    component = brute_components(sorted(sets), sets)
    bench = tiling.Block([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()], tiling.MIN_MATCH)
    want = {
        r["doc_id"]
        for r in cut
        if component[r["doc_id"]] == r["doc_id"] and not list(bench.matches(r["text"] or "", tiling.COVERAGE))
    }
    got = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == want
    assert len(want) < docs.count()

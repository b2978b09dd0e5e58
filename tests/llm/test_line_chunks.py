import hashlib
import random

from llm_cases import documents, hard, sentence
from pyspark.sql import functions as F

from skylattice.llm import line_chunks


def brute_chunks(text, window=line_chunks.WINDOW, divisor=line_chunks.DIVISOR):
    lines = text.split("\n")
    codes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        rolled = sum(codes[i - t] * 31**t for t in range(window) if i - t >= 0)
        if i == len(lines) - 1 or rolled % divisor == 0:
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def brute(texts):
    """Texts after removal, in the order of their ids."""
    seen, out = set(), []
    for text in texts:
        if text is None:
            out.append(None)
            continue
        kept = []
        for chunk in brute_chunks(text):
            body = "\n".join(chunk)
            if sum(bool(x.strip(" ")) for x in chunk) > 1:
                if body in seen:
                    continue
                seen.add(body)
            kept += chunk
        out.append("\n".join(kept))
    return out


def test_equal_to_brute_force(spark):
    rng = random.Random(12)
    shared = ["\n".join(sentence(rng, 6) for _ in range(8)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [sentence(rng, 6) for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        texts.append("\n".join(parts))
    texts += [None, "", "\n\n\n", "\n\n\n", texts[0], texts[0]]
    got = line_chunks.drop_repeated_chunks(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == brute(texts)
    assert sum(r["removed_lines"] for r in got) > 50
    assert all((r["removed_chunks"] > 0) == (r["removed_lines"] > 0) for r in got)


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    lines = [sentence(rng, 5) for _ in range(60)]
    plain = {tuple(c) for c in brute_chunks("\n".join(lines))}
    shifted = {tuple(c) for c in brute_chunks("\n".join(["new line", *lines]))}
    assert len(plain & shifted) >= len(plain) - 2


def test_plan_has_no_python(spark):
    plan = line_chunks.drop_repeated_chunks(documents(spark, ["a\nb", "a\nb"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hard_rows(spark):
    rows = hard(spark)
    got = line_chunks.drop_repeated_chunks(rows)
    assert got.columns == [*rows.columns, "removed_chunks", "removed_lines"]
    found = got.collect()
    assert len(found) == 11
    assert all(r["row"] == "mine" and r["chunks"] == "mine" for r in found)
    assert {r["doc_id"]: r["text"] for r in found}[1] is None
    five, six = ([r for r in found if r["doc_id"] == i] for i in (5, 6))
    assert len(six) == 2 and six[0] == six[1]
    assert line_chunks.drop_repeated_chunks(rows.limit(0)).count() == 0


def brute_runs(texts):
    """Texts without the lines of every run of two or more filled lines that occurs earlier."""
    docs = [None if t is None else t.split("\n") for t in texts]
    first, gone = {}, []
    for d, lines in enumerate(docs):
        filled = [i for i, x in enumerate(lines or []) if x.strip(" \r\t")]
        off = set()
        for k, (i, j) in enumerate(zip(filled, filled[1:])):
            if first.setdefault((lines[i], lines[j]), (d, k)) != (d, k):
                off |= {k, k + 1}
        gone.append({
            i for k in off for i in range(filled[k], filled[k + 1] if k + 1 < len(filled) else len(lines))
        })
    return [None if x is None else "\n".join(t for i, t in enumerate(x) if i not in g) for x, g in zip(docs, gone)]


def test_no_repeated_run_stays(spark):
    """Passages of every length from two lines on, anywhere in their texts, all go: recall 1."""
    rng = random.Random(21)
    texts, copied = [], []
    for n in range(60):
        passage = [sentence(rng, 30) for _ in range(2 + n % 6)]
        for _ in range(2):
            own = lambda: [sentence(rng, 6) for _ in range(rng.randint(0, 3))]
            texts.append("\n".join([*own(), *passage[:1], *[""] * rng.randint(0, 1), *passage[1:], *own()]))
        copied.append((2 * n + 1, passage))
    texts += [None, "", "\n\n\n", "a\nb\na\nb", "\n\t\na b\n\nc d\n", "a b\nc d", "c d", "c d"]
    cut = line_chunks.drop_repeated_runs(documents(spark, texts)).orderBy("doc_id")
    got = cut.collect()
    assert [r["text"] for r in got] == brute_runs(texts)
    assert [r["text"] for r in cut.select("doc_id", "text").collect()] == [r["text"] for r in got]
    assert not [d for d, passage in copied if any(line in got[d]["text"] for line in passage)]
    assert sum(r["removed_chunks"] for r in got) == 62
    assert all((r["removed_chunks"] > 0) == (r["removed_lines"] > 0) for r in got)


def test_runs_of_hard_rows(spark):
    rows = hard(spark)
    got = line_chunks.drop_repeated_runs(rows)
    assert got.columns == [*rows.columns, "removed_chunks", "removed_lines"]
    found = got.collect()
    assert len(found) == 11
    assert all(r["row"] == "mine" and r["lines"] == "mine" for r in found)
    assert {r["doc_id"]: r["text"] for r in found}[1] is None
    six = [r for r in found if r["doc_id"] == 6]
    assert len(six) == 2 and [r["text"] for r in six] == ["", ""]
    assert line_chunks.drop_repeated_runs(rows.limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_come_from_chunks_and_the_rest_from_pairs(spark):
    """The chunks' boundaries decide what they find, not what goes in the end."""
    rng = random.Random(4)
    passages = [[sentence(rng, 6) for _ in range(rng.randint(2, 9))] for _ in range(8)]
    texts = ["\n\n".join(sentence(rng, 5) + "\n" + "\n".join(rng.choice(passages)) for _ in range(2)) for _ in range(25)]
    texts += [texts[0], "\n".join(passages[0] * 2), None, "", " \n\t"]
    docs = documents(spark, texts)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("code_of_text"), "text")
    found = []
    for divisor in (1, 3, 10**6):
        found.append(line_chunks._in_repeated_chunks(keyed, ["doc_id", "code_of_text"], 2, divisor).count())
        got = line_chunks.drop_repeated_runs(docs, divisor=divisor).orderBy("doc_id").collect()
        assert [r["text"] for r in got] == brute_runs(texts)
    # With every line a boundary no chunk has two; with none a text is one chunk, and one text is a copy.
    assert found[0] == 0 < found[2] < found[1]

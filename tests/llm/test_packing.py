import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, hard

from skylattice.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def direct(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


ENCODER = packing.word_encoder(PATH)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbZ 09\t\n '’.,!<|>_-éÉßŸÿ×÷ªµΣσςİı中́stremvld", max_size=30))
def test_word_encoder_equals_the_tokenizer(text):
    assert np.frombuffer(ENCODER([text])[0], "<u4").tolist() == direct(text)


def test_special_tokens_in_a_text():
    for text in ("<|endoftext|>", "a<|startoftext|>b it's", "x <|endoftext|> y"):
        assert np.frombuffer(ENCODER([text])[0], "<u4").tolist() == direct(text)


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(100, 150))
def test_windows_hold_every_piece_once_within_capacity(sizes, capacity):
    parts = packing.fill(sizes, capacity)
    assert sorted(i for part in parts for i in part) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in part) <= capacity for part in parts)


def test_differencing_is_near_equal():
    sums = [sum(part) for part in ([s for s in p] for p in packing.difference([8, 7, 6, 5, 4], 2))]
    assert len(sums) == 2
    rng = np.random.default_rng(1)
    sizes = rng.integers(50, 512, 800).tolist()
    sums = [sum(sizes[i] for i in p) for p in packing.difference(sizes, 50)]
    assert max(sums) - min(sums) <= 8


def test_window_count_rises_when_capacity_is_exceeded():
    assert len(packing.fill([60, 60, 60], 100)) == 3


def check_round_trip(rows, texts):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts.items():
        own = sorted(pieces.pop(doc_id), key=lambda r: r["start"])
        ids = b"".join(bytes(r["ids"]) for r in own)
        assert np.frombuffer(ids, "<u4").tolist() == [*direct(text or ""), packing.END]
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert all(r["doc_tokens"] == len(ids) // 4 and len(r["ids"]) == 4 * r["length"] for r in own)
    assert not pieces
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= packing.CAPACITY
    return sequences


def test_round_trip_and_little_padding(spark):
    rng = np.random.default_rng(3)
    texts = {i: "wörd und 12 " * int(rng.integers(0, 700)) for i in range(120)}
    df = documents(spark, [texts[i] for i in texts]).repartition(2)
    rows = packing.pack(df, group_tokens=60_000).collect()
    sequences = check_round_trip(rows, texts)
    total = sum(r["length"] for r in rows)
    assert 1 - total / (len(sequences) * packing.CAPACITY) < 0.08


def test_digest(spark):
    rows = packing.pack(documents(spark, ["some text", None])).collect()
    got = packing.digest(packing.pack(documents(spark, ["some text", None]))).collect()
    assert sorted(r["ids_crc32"] for r in got) == sorted(zlib.crc32(bytes(r["ids"])) for r in rows)


def test_hard_rows(spark):
    rows = packing.pack(hard(spark)).collect()
    assert sum(r["start"] == 0 for r in rows) == 11
    assert packing.pack(hard(spark).limit(0)).count() == 0

import random

import numpy as np
from llm_cases import documents, hard, sentence

from skylattice.llm import tiling


def brute_tiles(item, doc, width):
    """Plain greedy string tiling: longest unmarked match, ties by item then document position."""
    a, b = [False] * len(item), [False] * len(doc)
    out = []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not a[i + n] and not b[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < width:
            return out
        out.append((i, d, n))
        a[i : i + n] = [True] * n
        b[d : d + n] = [True] * n


def test_tiles_equal_plain_tiling():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.randint(1, 4) for _ in range(rng.randint(3, 25))]
        doc = [rng.randint(1, 4) for _ in range(rng.randint(3, 40))]
        at = [(i, d) for i in range(len(item) - 2) for d in range(len(doc) - 2) if item[i : i + 3] == doc[d : d + 3]]
        want = brute_tiles(item, doc, 3)
        if at:
            got = tiling.tiles(np.array([a for a, _ in at]), np.array([b for _, b in at]), 3)
            assert got == want
        else:
            assert want == []


def test_reordered_passages_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(8)
    item = sentence(rng, 40)
    words = item.split()
    turned = " ".join(words[20:] + sentence(rng, 7).split() + words[:20])
    some = " ".join(words[:15])
    docs = documents(
        spark,
        [sentence(rng, 60) + " " + item.upper() + ". " + sentence(rng, 30), turned, some, sentence(rng, 100), None, ""],
    )
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "two words")], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in tiling.contaminated(docs, bench).collect()}
    assert set(found) == {(0, 7), (1, 7)}
    assert len(found[1, 7]["tiles"]) == 2 and found[1, 7]["coverage"] == 1.0
    assert {r["doc_id"] for r in tiling.clean(docs, bench).collect()} == {2, 3, 4, 5}


def pairs_of(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_join_of_seeds_equals_one_block(spark):
    """A benchmark beyond one block: the same pairs, tiles and clean documents."""
    rng = random.Random(6)
    lead = sentence(rng, 9)
    items = [f"{lead} {sentence(rng, n)}" for n in (8, 8, 20, 20, 30, 40)] + [sentence(rng, n) for n in (3, 4, 5, 6, 25)]
    items += [items[0], "aa " * 30, "one two", "", None]
    texts = []
    for _ in range(40):
        words = rng.choice(items[:11]).split()
        cut = rng.randint(0, len(words))
        texts.append(" ".join([sentence(rng), *words[cut:], sentence(rng, rng.randint(0, 9)), *words[:cut], sentence(rng)]))
    texts += [lead, texts[0], texts[0], "aa " * 300, "x one two y", None, "", sentence(rng, 2000) + " " + items[4]]
    docs = documents(spark, texts)
    docs = docs.union(docs.where("doc_id < 3")).union(docs.where("doc_id = 1").selectExpr("null", "text", "lang", "source", "n_chars"))
    ids = [*range(len(items) - 1), None]
    bench = spark.createDataFrame(list(zip(ids, items)), "item_id bigint, text string")
    whole, parts = (tiling.contaminated(docs, bench, block_chars=n) for n in (8_000_000, 300))
    assert parts.schema.simpleString() == whole.schema.simpleString()
    assert pairs_of(parts) == pairs_of(whole) and whole.count() >= 30
    kept = [pairs_of(tiling.clean(docs, bench, block_chars=n)) for n in (8_000_000, 300)]
    assert kept[0] == kept[1] and 0 < len(kept[0]) < docs.count()


def test_needed_seeds_meet_every_document_that_is_covered():
    """Without a needed seed the others cover too little, and what many items share is not needed."""
    rng = random.Random(15)
    for _ in range(200):
        n, width = rng.randint(5, 40), 5
        seed = [rng.randint(0, 12) for _ in range(n - width + 1)]
        common = [1 + one % 7 for one in seed]
        kept = tiling.needed(range(len(seed)), seed, common, n, width, 0.6)
        rest = {j for i, one in enumerate(seed) if one not in kept for j in range(i, i + width)}
        assert kept and len(rest) < 0.6 * n
    shared = tiling.needed(range(16), range(16), [9] * 6 + [1] * 10, 20, 5, 0.6)
    assert not set(shared) & set(range(6))


def test_join_of_seeds_on_hard_rows(spark):
    bench = spark.createDataFrame([(1, "a null id with words"), (None, "été çà")], "item_id bigint, text string")
    pairs = tiling.contaminated(hard(spark), bench, block_chars=1).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, pairs), key=str) == [(7, None), (None, 1)]
    kept = tiling.clean(hard(spark), bench, block_chars=1)
    assert kept.columns == hard(spark).columns and kept.count() == 9
    assert tiling.contaminated(hard(spark).limit(0), bench, block_chars=1).count() == 0
    assert tiling.clean(hard(spark), bench.selectExpr("item_id", "'...' AS text"), block_chars=1).count() == 11


def test_short_items_have_to_appear_whole(spark):
    docs = documents(spark, ["xx alpha beta gamma yy", "alpha beta"])
    bench = spark.createDataFrame([(1, "Alpha, beta gamma")], "item_id bigint, text string")
    assert [r["doc_id"] for r in tiling.contaminated(docs, bench).collect()] == [0]


def test_hard_rows(spark):
    bench = spark.createDataFrame([(1, "a null id with words"), (None, "été çà")], "item_id bigint, text string")
    pairs = tiling.contaminated(hard(spark), bench).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, pairs), key=str) == [(7, None), (None, 1)]
    kept = tiling.clean(hard(spark), bench)
    assert kept.columns == hard(spark).columns and kept.count() == 9
    assert tiling.contaminated(hard(spark).limit(0), bench).count() == 0
    assert tiling.contaminated(hard(spark), bench.limit(0)).count() == 0
    assert tiling.clean(hard(spark), bench.limit(0)).count() == 11

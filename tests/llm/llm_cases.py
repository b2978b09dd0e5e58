"""Hand-written documents shared by the tests."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, langs=None):
    """Documents 0, 1, ... of the given texts."""
    rows = [
        (i, t, langs[i] if langs else "en", "s", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, words=12):
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(words))


def hard(spark):
    """Nulls in every column, empty and blank and very long texts, repeated rows, clashing columns."""
    rng = random.Random(5)
    line = sentence(rng, 30)
    long = "\n".join(sentence(rng, 15) for _ in range(3000))
    rows = [
        (None, "a null id with words enough for shingles", "en", "s", 1),
        (1, None, "en", "s", None),
        (2, "", "en", None, 0),
        (3, " \n\t ", None, "s", 4),
        (4, long, "en", "s", len(long)),
        (5, line + "\n" + line, "en", "s", 9),
        (6, line + "\n" + line, "en", "s", 9),
        (6, line + "\n" + line, "en", "s", 9),
        (7, "été çà 日本語 \U0001f600 ẞ", "fr", "s", 9),
        (8, "one", "de", "s", 3),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    names = "row key code node end shard size first lines chunks gone spans base at rank x leaf cell part payload u v label group comp score lang_pred hits codes file"
    return df.withColumns({name: F.lit("mine") for name in names.split()})


def brute_components(ids, sets, percent=80):
    """Smallest id reachable over links of all pairs."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i] | sets[j])):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}

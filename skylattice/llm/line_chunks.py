"""Line deduplication by content-defined chunks; DataFrame functions only.

``drop_repeated_chunks``: every line has a hash; a polynomial hash rolled over the last ``window`` line
hashes ends a chunk where it is divisible by ``divisor``. Boundaries depend on nearby lines alone, so an
inserted line shifts none beyond it. Chunks of two or more lines whose hash appears more than once are
compared byte by byte, and every occurrence but the first of a text is removed.

A repeated run goes there only where boundaries enclose it, and a run of two lines may hold none unless
every line is one. ``drop_repeated_runs``, which the registered query and the pipeline use, finds repeated
chunks of the filled lines in this way and then completes them: pairs of neighbouring filled lines outside
these chunks are compared, too, equal neighbours join to runs, and every repeated run of two or more filled
lines is found whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import materialize

WINDOW = 2
DIVISOR = 3
_STEP = 31


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def _once(value: Column) -> Column:
    """Evaluate once per row: the optimizer moves no expression into a lambda through this."""
    return F.explode(F.array(value))


def with_chunks(docs: DataFrame, text: str, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """Adds ``lines`` and ``chunks`` (k, first line from 1, last line); none for a null text."""
    rows = docs.withColumn("lines", _once(F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))))
    return _cut(rows, window, divisor)


def _cut(rows: DataFrame, window: int, divisor: int) -> DataFrame:
    """Adds ``chunks`` of the array ``lines``."""
    rows = rows.withColumn("hashes", _once(F.transform("lines", _line_hash)))

    def ends_here(i: Column) -> Column:
        rolled = F.lit(0).cast("bigint")
        for t in range(window):
            rolled = rolled + F.coalesce(F.get("hashes", i - 1 - t), F.lit(0)) * (_STEP**t)
        return (i == F.size("hashes")) | (F.pmod(rolled, F.lit(divisor)) == 0)

    numbers = F.when(F.size("lines") > 0, F.sequence(F.lit(1), F.size("lines"))).otherwise(
        F.array().cast("array<int>")
    )
    rows = rows.withColumn("ends", _once(F.filter(numbers, ends_here)))
    chunk = lambda end, k: F.struct(
        k.alias("k"),
        (F.coalesce(F.get("ends", k - 1), F.lit(0)) + 1).alias("first"),
        end.alias("last"),
    )
    return rows.withColumn("chunks", F.transform("ends", chunk)).drop("hashes", "ends")


def _lines(c: Column) -> Column:
    return F.slice("lines", c["first"], c["last"] - c["first"] + 1)


def _bodies(chunks: DataFrame, *keys: str) -> DataFrame:
    """One row per chunk with at least two lines that are not blank."""
    filled = lambda c: F.size(F.filter(_lines(c), lambda x: F.trim(x) != "")) > 1
    body = lambda c: F.struct(
        c["k"].alias("k"), c["first"].alias("first"), c["last"].alias("last"), F.array_join(_lines(c), "\n").alias("body")
    )
    found = F.transform(F.filter("chunks", filled), body)
    return chunks.select(*keys, F.explode(found).alias("c")).select(
        *keys, "c.k", "c.first", "c.last", "c.body", F.xxhash64("c.body").alias("code")
    )


def drop_repeated_chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` without repeated chunks, and with ``removed_chunks`` and ``removed_lines`` (long).

    Occurrences are ordered by ``doc_id`` (null first), text hash and place; the first stays. Rows that
    repeat both ``doc_id`` and text count as one document and are treated alike. A null text stays
    null, an empty one empty; a document all of whose chunks were removed has the empty text.
    All columns are kept, but for own ones of the two names; the rest travels in a struct, so
    names cannot clash. An empty table gives no rows.
    """
    docs = docs.drop("removed_chunks", "removed_lines")
    keys = ["doc_id", "code_of_text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("code_of_text"),
    )
    chunked = with_chunks(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("code_of_text"),
        F.col("text").cast("string").alias("text"),
    ), "text", window, divisor)
    codes = materialize(_bodies(chunked, *keys).select(*keys, "k", "code").distinct())
    repeated = codes.groupBy("code").count().where("count > 1").select("code")
    hits = (
        codes.join(repeated, "code")
        .groupBy(*keys)
        .agg(F.collect_set("code").alias("codes"))
        .hint("merge")
    )
    same = lambda left, right: left["doc_id"].eqNullSafe(right["doc_id"]) & (
        left["code_of_text"] == right["code_of_text"]
    )
    marked = materialize(
        rows.join(hits, same(rows, hits), "left").select("row", rows["doc_id"], rows["code_of_text"], "codes")
    )
    # Bytes are compared for repeated codes alone.
    suspects = marked.where("codes IS NOT NULL").withColumn("text", F.col("row.text"))
    bodies = (
        _bodies(with_chunks(suspects, "text", window, divisor), *keys, "codes")
        .where(F.array_contains("codes", F.col("code")))
        .select(*keys, "k", "code", "body")
    )
    place = F.struct("doc_id", "code_of_text", "k")
    first = bodies.groupBy("code", "body").agg(F.min(place).alias("first"))
    gone = materialize(
        bodies.join(first, ["code", "body"])
        .where(F.col("first") < place)
        .groupBy(*keys)
        .agg(F.collect_set("k").alias("gone"))
    )
    untouched = marked.where("codes IS NULL").select(
        "row.*", F.lit(0).cast("bigint").alias("removed_chunks"), F.lit(0).cast("bigint").alias("removed_lines")
    )
    # Both joins with texts are merge joins at every size: no side has a bound to broadcast under.
    gone = gone.hint("merge")
    joined = suspects.join(gone, same(suspects, gone), "left").select(
        "row", "text", F.coalesce("gone", F.array().cast("array<int>")).alias("gone")
    )
    cut = with_chunks(joined, "text", window, divisor)
    stays = F.filter("chunks", lambda c: ~F.array_contains("gone", c["k"]))
    cut = cut.withColumn("left_over", F.flatten(F.transform(stays, _lines)))
    lines = (F.size("lines") - F.size("left_over")).cast("bigint")
    columns = [
        F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.array_join("left_over", "\n")).alias("text")
        if c == "text"
        else F.col(f"row.`{c}`")
        for c in docs.columns
    ]
    touched = cut.select(
        *columns, F.size("gone").cast("bigint").alias("removed_chunks"), lines.alias("removed_lines")
    )
    return untouched.union(touched)


def _filled(line: Column) -> Column:
    return F.trim(F.translate(line, "\r\t", "  ")) != ""


def _with_pairs(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``lines`` and ``filled``, the numbers (from 1) of the lines that are not blank."""
    rows = docs.withColumn("lines", _once(F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))))
    numbers = F.when(F.size("lines") > 0, F.sequence(F.lit(1), F.size("lines"))).otherwise(
        F.array().cast("array<int>")
    )
    return rows.withColumn("filled", _once(F.filter(numbers, lambda i: _filled(F.get("lines", i - 1)))))


def _pair(k: Column) -> tuple[Column, Column]:
    """The two filled lines of chunk ``k`` (from 1)."""
    return tuple(F.get("lines", F.get("filled", k - 1 + t) - 1) for t in range(2))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["code_of_text"] == right["code_of_text"])


def _in_repeated_chunks(texts: DataFrame, keys: list[str], window: int, divisor: int) -> DataFrame:
    """``(*keys, k)``: the pairs of neighbouring filled lines inside chunks that occur earlier."""

    def chunked(rows: DataFrame) -> DataFrame:
        rows = _with_pairs(rows, "text")
        filled = F.transform("filled", lambda i: F.get("lines", i - 1))
        return _cut(rows.withColumn("lines", _once(filled)), window, divisor)

    place = F.struct(*keys, "k")
    codes = materialize(_bodies(chunked(texts), *keys).select(*keys, "k", "code"))
    repeated = codes.groupBy("code").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    hits = (
        codes.join(repeated.select("code"), "code")
        .groupBy(*keys)
        .agg(F.collect_set("code").alias("codes"))
        .hint("merge")
    )
    suspects = texts.join(hits, _same(texts, hits)).select(*[texts[c] for c in (*keys, "text")], "codes")
    bodies = materialize(
        _bodies(chunked(suspects), *keys, "codes")
        .where(F.array_contains("codes", F.col("code")))
        .select(*keys, "k", "first", "last", "body")
    )
    earliest = bodies.groupBy("body").agg(F.min(place).alias("earliest"))
    later = bodies.join(earliest, "body").where(F.col("earliest") < place)
    pairs = F.explode(F.sequence(F.col("first"), F.col("last") - 1))
    return materialize(later.select(*keys, pairs.alias("k")).distinct())


def drop_repeated_runs(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """Like ``drop_repeated_chunks``, but no repeated run of two or more filled lines stays.

    A line goes if it and a neighbouring filled line occur earlier as neighbours, too, and blank lines go
    with the line before them; blank lines between neighbours do not count. The first occurrence of every
    line stays. ``removed_chunks`` counts the runs taken out.
    """
    docs = docs.drop("removed_chunks", "removed_lines")
    keys = ["doc_id", "code_of_text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("code_of_text"),
    )
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("code_of_text"),
        F.col("text").cast("string").alias("text"),
    )
    # These go already. An equal pair is in the first occurrence of their chunk, so they need no comparison.
    known = _in_repeated_chunks(texts, keys, window, divisor)
    paired = _with_pairs(texts, "text")
    every = F.when(F.size("filled") > 1, F.sequence(F.lit(1), F.size("filled") - 1))
    coded = F.transform(every, lambda k: F.struct(k.alias("k"), F.xxhash64(*_pair(k)).alias("code")))
    pairs = paired.select(*keys, F.explode(coded).alias("c")).select(*keys, "c.k", "c.code")
    codes = materialize(pairs.join(known, _same(pairs, known) & (pairs["k"] == known["k"]), "left_anti"))
    place = F.struct(*keys, "k")
    # Repeated rows have equal places, so they do not count as repeats.
    repeated = codes.groupBy("code").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    hits = (
        codes.join(repeated.select("code"), "code")
        .select(*keys, "k")
        .unionByName(known.select(*keys, F.lit(None).cast("int").alias("k")))
        .groupBy(*keys)
        .agg(F.collect_set("k").alias("ks"))
        .hint("merge")
    )
    marked = materialize(
        rows.join(hits, _same(rows, hits), "left").select("row", rows["doc_id"], rows["code_of_text"], "ks")
    )
    # Bytes are compared for repeated codes alone.
    suspects = marked.where("ks IS NOT NULL").withColumn("text", F.col("row.text").cast("string"))
    body = lambda k: F.struct(k.alias("k"), F.array_join(F.array(*_pair(k)), "\n").alias("body"))
    bodies = (
        _with_pairs(suspects, "text")
        .select(*keys, F.explode(F.transform("ks", body)).alias("c"))
        .select(*keys, "c.k", "c.body")
    )
    first = bodies.groupBy("body").agg(F.min(place).alias("first"))
    gone = materialize(
        bodies.join(first, "body")
        .where(F.col("first") < place)
        .select(*keys, "k")
        .unionByName(known)
        .groupBy(*keys)
        .agg(F.collect_set("k").alias("gone"))
    )
    untouched = marked.where("ks IS NULL").select(
        "row.*", F.lit(0).cast("bigint").alias("removed_chunks"), F.lit(0).cast("bigint").alias("removed_lines")
    )
    gone = gone.hint("merge")
    # Chunk k is the filled lines k and k + 1, each with the blank lines after it; sets keep this linear.
    both = F.array_sort(F.array_union("gone", F.transform("gone", lambda k: k + 1)))
    joined = suspects.join(gone, _same(suspects, gone), "left").select(
        "row", "text", F.coalesce(both, F.array().cast("array<int>")).alias("gone")
    )
    cut = _with_pairs(joined, "text")
    end = lambda j: F.coalesce(F.get("filled", j), F.size("lines") + 1) - 1
    cut = cut.withColumn("off", F.flatten(F.transform("gone", lambda j: F.sequence(F.get("filled", j - 1), end(j)))))
    stays = F.array_except(F.sequence(F.lit(1), F.size("lines")), "off")
    cut = cut.withColumn("left_over", F.transform(stays, lambda i: F.get("lines", i - 1)))
    # A run starts where the filled line before is not among the lines that go.
    starts = F.array_except("gone", F.transform("gone", lambda j: j + 1))
    columns = [
        F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join("left_over", "\n")).alias("text")
        if c == "text"
        else F.col(f"row.`{c}`")
        for c in docs.columns
    ]
    touched = cut.select(
        *columns, F.size(starts).cast("bigint").alias("removed_chunks"), F.size("off").cast("bigint").alias("removed_lines")
    )
    return untouched.union(touched)

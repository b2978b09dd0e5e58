"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Every document gets a rate, the number of copies it should have. Among all rates up to a ceiling that
give each source its target of words, entropy balancing takes those nearest to one copy each, in
the sense of sum(w log w - w). They are exponentially tilted, w = min(ceiling, exp(lambda * size)), with
one dual variable lambda a source. The dual is convex; its Newton iterations work on the counts of
(source, size), which is all that rates depend on, so documents are read once however many
iterations follow. Sums are decimals, so they and all that follows do not depend on the order of rows.

Rates become copies by systematic rounding: a source's documents, longest first, are laid end to end
with their rates as lengths, and a document has as many copies as whole numbers fall on it. The words
taken then miss the target by at most half of the longest document; of several offsets of the whole
numbers the one that comes nearest is used. Documents of a size are ordered by a hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .rows import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
TOLERANCE = 1e-9
ROUNDS = 80
OFFSETS = 32
UNIT_BITS = 24  # rates are whole numbers of 2**-24 copies
BAND = 1024  # sizes summed together
CELLS = 64
CELL_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place from 0 in the order of code points, null last."""
    ordered = materialize(
        sources.sort(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    # One row per range partition, so this window is as small as their number.
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.col("at") - F.shiftleft("part", 33)
    return ordered.join(before, "part").select("source", "words", (F.col("before") + inside).alias("place"))


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, share: float = 1.0
) -> DataFrame:
    """``(source, words, target)`` from ``(source, words)``.

    Weights repeat over the sources in order and share ``share`` of all words. No target exceeds
    ``most`` times the source's words; the excess is shared among the others by weight, until none
    is above.
    """
    each = F.array(*[F.lit(float(w)) for w in weights])
    weighted = materialize(
        _numbered(sources).withColumn("weight", F.get(each, F.pmod("place", F.lit(len(weights))).cast("int")))
    )
    bound = F.col("words") * F.lit(float(most))
    everything = (weighted.agg(F.sum("words")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        capped = F.lit(level) * F.col("weight") >= bound
        held = weighted.agg(
            F.coalesce(F.sum(F.when(capped, bound)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
            F.count_if(capped),
        ).first()
        if not held[1] or held[2] == full:  # sources that are full stay so while the level rises
            break
        level, full = (everything - held[0]) / held[1], held[2]
    shared = bound if not held[1] else F.least(bound, F.lit(level) * F.col("weight"))
    return weighted.select("source", "words", shared.alias("target"))


def _tilted(lam: str, size: str, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.col(lam) * F.col(size)))


def _files(rows: int) -> int:
    """Files for at most that many small rows."""
    return max(1, -(-rows // CELL_ROWS))


def _exact(column: Column) -> Column:
    """A sum that does not depend on the order of its terms."""
    return F.sum(column.cast("decimal(38,6)")).cast("double")


def duals(classes: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """``(source, words, target, lam)``: the dual variable that gives each source its target.

    ``classes`` counts the documents (``n``) of each (source, size). Newton steps on the logarithm of
    the dual's gradient equation, kept inside a shrinking bracket; a step that leaves it, as beside
    the ceiling, is replaced by its middle.
    """
    spread = classes.groupBy("source").agg(
        _exact(F.col("n") * F.col("size")).alias("first"),
        _exact(F.col("n") * F.col("size").cast("double") * F.col("size")).alias("second"),
    )
    ratio = F.col("target") / F.col("words")
    top = F.log(F.lit(float(most))) + 1  # every document of a word or more is at the ceiling
    open_ = (F.col("target") > 0) & (F.col("target") < F.col("words") * F.lit(float(most)))
    known = goals.select("source", "words", "target").withColumnRenamed("source", "of")
    state = known.join(spread, F.col("of").eqNullSafe(F.col("source")), "left").select(
        F.col("of").alias("source"),
        "words",
        "target",
        F.when(open_, F.log(ratio) * F.col("first") / F.col("second"))
        .when(F.col("target") > 0, top)
        .otherwise(0.0)
        .alias("lam"),
        F.when(open_, F.least(F.lit(0.0), F.log(ratio))).alias("low"),
        F.when(open_, F.when(ratio <= 1, 0.0).otherwise(top)).alias("high"),
        F.coalesce(open_, F.lit(False)).alias("open"),
    )
    # Rounds read these rows over and over; files follow the rows, not the number of shuffle partitions.
    files = _files(known.count())
    state = materialize(state.coalesce(files))
    weight = F.col("n") * F.col("size") * _tilted("lam", "size", most)
    inner = F.when(_tilted("lam", "size", most) < most, weight * F.col("size")).otherwise(0.0)
    filled = classes.where("size > 0").withColumnRenamed("source", "in")
    for _ in range(ROUNDS):
        live = state.where("open")
        sums = (
            filled.join(live, F.col("in").eqNullSafe(F.col("source")))
            .groupBy(F.col("in"))
            .agg(_exact(weight).alias("got"), _exact(inner).alias("slope"))
        )
        at = state.join(sums, F.col("open") & F.col("source").eqNullSafe(F.col("in")), "left")
        under = F.col("got") < F.col("target")
        low = F.when(under, F.col("lam")).otherwise(F.col("low"))
        high = F.when(under, F.col("high")).otherwise(F.col("lam"))
        step = F.when(
            (F.col("slope") > 0) & (F.col("got") > 0),
            F.col("lam") + F.col("got") / F.col("slope") * F.log(F.col("target") / F.col("got")),
        )
        stepped = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        near = F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("target")
        near = near | (stepped == low) | (stepped == high)  # nothing between the two
        more = F.col("open") & ~near
        seen = Observation()
        state = materialize(
            at.select(
                "source",
                "words",
                "target",
                F.when(more, stepped).otherwise(F.col("lam")).alias("lam"),
                low.alias("low"),
                high.alias("high"),
                F.coalesce(more, F.lit(False)).alias("open"),
            )
            .observe(seen, F.count_if("open").alias("open"))
            .coalesce(files)
        )
        if not seen.get["open"]:
            break
    return state.select("source", "words", "target", "lam")


def _laid_out(classes: DataFrame, solved: DataFrame, most: int, offsets: int) -> DataFrame:
    """Every class with its rate and the place where it starts, offset included, in units."""
    rated = (
        classes.withColumnRenamed("source", "in")
        .join(solved, F.col("in").eqNullSafe(F.col("source")))
        .select(
            "source",
            "words",
            "target",
            "size",
            "n",
            F.round(_tilted("lam", "size", most) * (1 << UNIT_BITS)).cast("bigint").alias("rate"),
            F.floor(F.col("size") / BAND).alias("band"),
        )
    )
    rated = materialize(rated)
    length = F.col("n") * F.col("rate")
    bands = rated.groupBy(F.col("source").alias("in"), F.col("band").alias("of")).agg(F.sum(length).alias("all"))
    longer = Window.partitionBy("in").orderBy(F.col("of").desc())  # a row per 1024 sizes
    before = bands.select("in", "of", (F.sum("all").over(longer) - F.col("all")).alias("before"))
    inside = Window.partitionBy("source", "band").orderBy(F.col("size").desc())  # at most 1024 sizes
    placed = materialize(
        rated.withColumn("upto", F.sum(length).over(inside))
        .join(before, F.col("in").eqNullSafe(F.col("source")) & (F.col("of") == F.col("band")))
        .select(
            "source", "words", "target", "size", "n", "rate",
            (F.col("before") + F.col("upto") - length).alias("start"),
        )
    )
    step = (1 << UNIT_BITS) // offsets
    tried = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(offsets - 1))).alias("k"))
    start = F.col("start") + F.col("k") * step
    taken = F.col("size") * (F.shiftright(start + length, UNIT_BITS) - F.shiftright(start, UNIT_BITS))
    missed = (
        tried.groupBy("source", "k")
        .agg(F.sum(taken).alias("taken"), F.max("target").alias("target"))
        .groupBy(F.col("source").alias("in"))
        .agg(F.min(F.struct(F.abs(F.col("taken") - F.col("target")).alias("away"), "k")).alias("best"))
    )
    return placed.join(missed, F.col("in").eqNullSafe(F.col("source"))).select(
        "source", "words", "target", "size", "n", "rate",
        (F.col("start") + F.col("best.k") * step).alias("start"),
    )


def mix(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    size: Column | None = None,
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    share: float = 1.0,
    offsets: int = OFFSETS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(doc, source, size, source_size, target, rate, copies)``, one row per document.

    ``doc`` is a struct of the columns ``keep`` (all by default), so names never clash; ``mixture``
    gives the documents themselves, each as often as it has copies. ``size`` is the number of words
    of ``text`` unless given. A null source is a source of its own, the last; null ids are ids
    like others; null, empty and blank texts have size 0, rate 1 and a copy or none, and take no words.
    Rows that are equal in id, text, source and size may be exchanged, so their copies as a whole are
    defined, not which row has them. A source without words has target 0. No rows give no rows.
    """
    own = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    order = F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in docs.columns])
    rows = materialize(
        docs.select(
            F.struct(*own).alias("doc"),
            F.col(f"`{source}`").cast("string").alias("source"),
            (words(F.col("text")) if size is None else size.cast("bigint")).alias("size"),
            order.alias("at"),
        )
    )
    # Cells are ranges of the hash, so the order of a class does not depend on their number.
    count = rows.count()
    bits = max(CELLS.bit_length() - 1, (count // cell_rows).bit_length())
    rows = rows.withColumn("cell", F.shiftright("at", 64 - bits))
    cells = materialize(rows.groupBy("source", "size", "cell").agg(F.count("*").alias("n")))
    classes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    classes = materialize(classes.coalesce(_files(count)))
    sized = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"))
    solved = duals(classes, targets(sized, weights, most, share), most)
    laid = _laid_out(classes, solved, most, offsets)
    earlier = Window.partitionBy("in", "of").orderBy("cell")  # a row per cell
    starts = cells.select(F.col("source").alias("in"), F.col("size").alias("of"), "cell", "n").withColumn(
        "earlier", F.sum("n").over(earlier) - F.col("n")
    )
    starts = starts.join(
        laid.drop("n"), F.col("in").eqNullSafe(F.col("source")) & (F.col("of") == F.col("size"))
    ).select(
        "in", "of", F.col("cell").alias("within"), "words", "target", "rate",
        (F.col("start") + F.col("earlier") * F.col("rate")).alias("start"),
    )
    inside = Window.partitionBy("source", "size", "cell").orderBy("at", "doc")
    ranked = rows.withColumn("rank", F.row_number().over(inside).cast("bigint"))
    joined = ranked.join(
        starts,
        F.col("source").eqNullSafe(F.col("in"))
        & (F.col("size") == F.col("of"))
        & (F.col("cell") == F.col("within")),
    )
    end = F.col("start") + F.col("rank") * F.col("rate")
    copies = F.shiftright(end, UNIT_BITS) - F.shiftright(end - F.col("rate"), UNIT_BITS)
    return joined.select(
        "doc",
        "source",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.col("rate") / (1 << UNIT_BITS)).alias("rate"),
        copies.alias("copies"),
    )


def mixture(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, a row per copy."""
    each = mixed.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return each.select("doc.*")


def digest(mixed: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of the mixed documents."""
    return mixed.select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )

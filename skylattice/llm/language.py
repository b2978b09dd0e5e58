"""Language identification by hierarchical discrimination.

A text becomes counts of hashed letter bigrams and trigrams, words padded by spaces and everything
but letters read as space. One-versus-rest linear support vector machines predict the language
family; within it one-versus-one machines, one for each pair of languages, vote. Machines minimise
the squared hinge loss on a bounded sample of labelled documents; every text is predicted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import prepare, releasing, slices, texts_of

UNKNOWN = "und"
BITS = 12
SIZE = 1 << BITS
PER_LANGUAGE = 250
SURPLUS = 4
_HASHES = 2**31 - 1
PIECE = 1 << 20  # characters hashed at a time

# Families of common languages by their codes; any other is a family of its own.
FAMILIES = {
    "germanic": "en de nl af da sv no nb nn is lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "semitic": "ar he mt am",
    "indic": "hi bn ur mr gu pa ne",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "sinitic": "zh yue wuu",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang, f"only {lang}")


def _letter_table() -> np.ndarray:
    """Which code points of the first plane are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)


_LETTERS: list[np.ndarray] = []


def counts(text: str) -> np.ndarray | None:
    """Hashed counts of the whole text, scaled to length 1; None without letters."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    letters = _LETTERS[0]
    total = np.zeros(SIZE)
    carry = np.array([32], dtype=np.uint32)
    any_letter = False
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        plain = np.minimum(codes, 0xFFFF)
        is_letter = letters[plain]
        beyond = codes > 0xFFFF
        if beyond.any():
            is_letter = is_letter & ~beyond
            is_letter[beyond] = [chr(c).isalpha() for c in codes[beyond]]
        any_letter = any_letter or bool(is_letter.any())
        c = np.concatenate([carry, np.where(is_letter, codes, np.uint32(32))])
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # runs of spaces count as one
        c = c[keep]
        two = c[:-1] * np.uint32(0x9E3779B1) ^ c[1:] * np.uint32(0x85EBCA77)
        total += np.bincount(_slot(two), minlength=SIZE)
        if len(c) > 2:
            three = two[:-1] * np.uint32(0xC2B2AE3D) ^ c[2:] * np.uint32(0x27D4EB2F)
            total += np.bincount(_slot(three), minlength=SIZE)
        carry = c[-2:] if len(c) > 1 else c
    if not any_letter:
        return None
    total = np.sqrt(total)
    return total / np.linalg.norm(total)


def _slot(hashes: np.ndarray) -> np.ndarray:
    h = hashes ^ (hashes >> np.uint32(15))
    return (h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)


@dataclass
class Machine:
    """Linear support vector machine; positive on the first of its two sides."""

    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def train(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, steps: int = 100) -> Machine:
    """Squared hinge loss by accelerated gradient steps; sides weigh alike whatever their sizes."""
    y = np.where(positive, 1.0, -1.0).astype(x.dtype)
    sides = max(1, positive.sum()), max(1, (~positive).sum())
    weight = np.where(positive, 0.5 / sides[0], 0.5 / sides[1]).astype(x.dtype)
    w, b = np.zeros(x.shape[1], dtype=x.dtype), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    rate = 1.0 / (1.0 / cost + 4.0)  # rows have length 1, the bias adds as much
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead_w + ahead_b))
        pull = weight * y * slack * 2
        new_w = ahead_w - rate * (ahead_w / cost - x.T @ pull)
        new_b = ahead_b + rate * pull.sum()
        t_next = float(1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = new_w + (t - 1) / t_next * (new_w - w)
        ahead_b = new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return Machine(w, b)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    of_family: dict[str, Machine] = field(default_factory=dict)
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], Machine] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of every row."""
        sure = lambda m: 1.0 / (1.0 + np.exp(-np.clip(3.0 * m, -30, 30)))
        n = len(x)
        if not self.families:
            return [UNKNOWN] * n, np.zeros(n)
        margins = np.stack([self.of_family[f].margin(x) for f in self.families], axis=1)
        chosen = margins.argmax(axis=1)
        score = sure(margins.max(axis=1)) if len(self.families) > 1 else np.ones(n)
        out = np.empty(n, dtype=object)
        for i, name in enumerate(self.families):
            rows = np.flatnonzero(chosen == i)
            languages = self.languages[name]
            votes = np.zeros((len(rows), len(languages)))
            trust = np.ones((len(rows), len(languages)))
            for a, b in combinations(range(len(languages)), 2):
                m = self.pairs[languages[a], languages[b]].margin(x[rows])
                votes[:, a] += m >= 0
                votes[:, b] += m < 0
                trust[:, a] = np.minimum(trust[:, a], sure(m))
                trust[:, b] = np.minimum(trust[:, b], sure(-m))
            best = (votes + trust / 2).argmax(axis=1)
            out[rows] = [languages[k] for k in best]
            score[rows] *= trust[np.arange(len(rows)), best]
        return list(out), score


def fit(x: np.ndarray, labels: list[str]) -> Model:
    """Machines for the families and for every pair of languages within one."""
    model = Model()
    if not labels:
        return model
    lang = np.array(labels, dtype=object)
    group = np.array([family(v) for v in labels], dtype=object)
    model.families = sorted(set(group))
    for name in model.families:
        inside = group == name
        if len(model.families) == 2 and model.of_family:  # the other side of the same cut
            (first,) = model.of_family.values()
            model.of_family[name] = Machine(-first.weights, -first.bias)
        elif len(model.families) > 1:
            model.of_family[name] = train(x, inside)
        else:
            model.of_family[name] = Machine(np.zeros(x.shape[1]), 1.0)
        model.languages[name] = sorted(set(lang[inside]))
        for a, b in combinations(model.languages[name], 2):
            rows = (lang == a) | (lang == b)
            model.pairs[a, b] = train(x[rows], lang[rows] == a)
    return model


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the ``per_language`` documents of every language that hash lowest (the bound).

    Rows without language or letters teach nothing. Tasks send features, never texts.
    """
    prepare(labelled.sparkSession)
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id"), F.lit(_HASHES)).alias("at"),
    )
    # A cut on the hash, from the rows of each language, lets about four times the bound through.
    # The counts are one row per language code, few by nature.
    sizes = F.broadcast(rows.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("rows")))
    cut = SURPLUS * per_language * _HASHES / F.col("rows")
    through = rows.join(sizes, F.col("lang") == F.col("of")).where(F.col("at") < cut)
    order = Window.partitionBy("lang").orderBy("at", "text")
    sample = through.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                (lang, x.astype(np.float32).tobytes())
                for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch, "text"))
                if (x := counts(text)) is not None
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())],
                names=["lang", "x"],
            )

    got = sample.select("lang", "text").mapInArrow(run, "lang string, x binary").collect()
    got = sorted((r["lang"], bytes(r["x"])) for r in got)
    x = np.array([np.frombuffer(b, dtype=np.float32) for _, b in got])
    return fit(x, [lang for lang, _ in got])


def identify(
    docs: DataFrame,
    model: Model,
    lang_name: str = "lang_pred",
    score_name: str = "score",
    letters_name: str | None = None,
) -> DataFrame:
    """``docs`` (all columns) with the predicted language and its score.

    ``und`` and score 0 if the text is null or has no letter, or if nothing was learned. Equal texts
    get equal results; an empty table gives no rows. Own columns of the same names are replaced.
    ``letters_name`` adds whether the text has a letter, which no label or model can change.
    """
    spark = docs.sparkSession
    prepare(spark)
    added = [T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    if letters_name:
        added.append(T.StructField(letters_name, T.BooleanType()))
    docs = docs.drop(*[f.name for f in added])
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, *added])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [counts(text) for text in texts_of(batch, "text")]
            known = [i for i, x in enumerate(found) if x is not None]
            languages, scores = [UNKNOWN] * len(found), [0.0] * len(found)
            if known:
                names, values = shared.value.predict(np.array([found[i] for i in known]))
                for i, name, value in zip(known, names, values):
                    languages[i], scores[i] = name, float(value)
            columns = [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            if letters_name:
                columns.append(pa.array([x is not None for x in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *[f.name for f in added]]
            )

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is neither learned from nor held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL").where(~held_out())

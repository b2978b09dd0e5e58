"""Secrets in texts: fixed patterns, and random-looking strings under false-discovery control.

A candidate is a run of encoding characters. Its encoding is the smallest alphabet that holds it.
Three tests ask whether it could have come from writing rather than from a random source; each
takes "as regular as writing" for its null, so that a long random string gives a small p-value:

* chi-squared uniformity over the alphabet, against the non-central law that text-like
  collisions would give (its power grows with the length);
* runs of character classes, against at most half of a random string's changes;
* lag-one serial correlation of alphabet positions, against a correlation of at least one half.

The three normal scores, each limited so that none outvotes the others, are combined (Stouffer).
Every candidate is scored and counts among the tests, plain words included. Benjamini-Hochberg runs
over all candidates of the table separately per length stratum, so short strings, of which there are
many and which can prove little, neither spend nor borrow the error budget of long ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import count_of, materialize, prepare, slices, spans_text, texts_of

# The patterns and kinds of the contract, in its order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RANDOM = "random"

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Alphabets from small to large; digits alone are no secret encoding.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = {name: frozenset(letters) for name, letters in ALPHABETS.items()}
_TEXT_COLLISION = 0.066  # chance that two letters of writing agree
MOST = 4.0  # what one test can add, so that none outvotes the others
_SCALE = 100  # scores are counted in hundredths
STRATA = (24, 32, 48, 64, 128)  # upper ends of the length strata; the last is open

_SCAN = (
    "doc_id bigint, base array<struct<start:int,rank:int,kind:string,end:int>>, "
    "found array<struct<start:int,rank:int,kind:string,end:int,stratum:int,score:int>>"
)


def encoding(token: str) -> str | None:
    """Smallest alphabet that holds the token (padding aside); None for digits alone or none."""
    body = set(token.rstrip("="))
    if not body or body <= set("0123456789"):
        return None
    return next((name for name, letters in _SETS.items() if body <= letters), None)


def _classes(token: str) -> np.ndarray:
    """0 digits, 1 upper, 2 lower; what joins the words of a name makes no change of class.

    A capital before a lower letter counts as lower, and another sign as the letter before it.
    """
    codes = np.frombuffer(token.encode(), dtype=np.uint8)
    classes = np.select([codes < 48, codes < 58, codes < 91, codes == 95], [3, 0, 1, 3], 2)
    classes[:-1][(classes[:-1] == 1) & (classes[1:] == 2)] = 2
    before = np.maximum.accumulate(np.where(classes == 3, 0, np.arange(len(classes))))
    return classes[before]


@lru_cache(maxsize=None)
def _change_rate(letters: str) -> float:
    """Chance that neighbours of a random string differ in class, from all runs of four kinds of signs."""
    kinds = {"0": 0.0, "A": 0.0, "a": 0.0, "+": 0.0}
    for c in letters:
        kinds["0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "+"] += 1 / len(letters)
    rate = 0.0
    for four in product(kinds, repeat=4):
        _, left, right, _ = _classes("".join(four))
        rate += math.prod(kinds[c] for c in four) * float(left != right)
    return rate


def uniformity_score(token: str, letters: str) -> float:
    """Normal score of the lower tail of chi-squared under text-like collisions."""
    n, k = len(token), len(letters)
    counts = np.bincount([letters.index(c) for c in token], minlength=k)
    statistic = float((counts**2).sum()) * k / n - n
    collision = max(_TEXT_COLLISION, 1.6 / k)
    shift = n * (k * collision - 1.0)
    df = k - 1
    scale = (df + 2 * shift) / (df + shift)
    f = (df + shift) ** 2 / (df + 2 * shift)
    root = (max(statistic, 0.0) / scale / f) ** (1 / 3)  # Wilson-Hilferty
    return -(root - (1 - 2 / (9 * f))) / math.sqrt(2 / (9 * f))


def runs_score(token: str, letters: str) -> float:
    """Normal score of the upper tail of class changes under half of a random string's rate."""
    changes = int(np.count_nonzero(np.diff(_classes(token))))
    rate, n = _change_rate(letters) / 2, len(token) - 1
    return (changes - 0.5 - n * rate) / math.sqrt(n * rate * (1 - rate))


def serial_score(token: str, letters: str) -> float:
    """Normal score against a lag-one correlation of one half or more, of either sign."""
    at = np.array([letters.index(c) for c in token], dtype=float)
    x, y = at[:-1] - at[:-1].mean(), at[1:] - at[1:].mean()
    spread = math.sqrt(float((x * x).sum() * (y * y).sum()))
    r = min(0.999, abs(float((x * y).sum()) / spread)) if spread else 0.999
    return (math.atanh(0.5) - math.atanh(r)) * math.sqrt(max(len(token) - 4, 1))


def randomness_score(token: str) -> float | None:
    """Combined normal score; None when no encoding holds the token."""
    name = encoding(token)
    body = token.rstrip("=")
    if name is None or len(body) < 8:
        return None
    letters = ALPHABETS[name]
    tests = (uniformity_score, runs_score, serial_score)
    return sum(min(MOST, test(body, letters)) for test in tests) / math.sqrt(len(tests))


def _spans(text: str) -> tuple[list[tuple], list[tuple]]:
    low = text.lower()
    base = []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        base += [
            (m.start(), 0, "assign", m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 6
        ]
    if "AKIA" in text:
        base += [
            (m.start(), 1, "access", m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= 20
        ]
    base += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    base.sort()
    found = []
    for m in CANDIDATE.finditer(text):
        token = m.group()
        if any(s < m.end() and m.start() < e for s, _, _, e in base):
            continue
        score = randomness_score(token)
        if score is not None:
            stratum = sum(len(token) >= end for end in STRATA)
            points = int(math.floor(max(-40.0, min(40.0, score)) * _SCALE))
            found.append((m.start(), len(KINDS), RANDOM, m.end(), stratum, points))
    return base, found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]
    more = [*span, ("stratum", pa.int32()), ("score", pa.int32())]
    names, wide = [n for n, _ in span], [n for n, _ in more]
    for batch in slices(batches):
        both = [_spans(text) for text in texts_of(batch, "text")]
        base = [[dict(zip(names, s)) for s in b] for b, _ in both]
        found = [[dict(zip(wide, s)) for s in f] for _, f in both]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(base, type=pa.list_(pa.struct(span))),
                pa.array(found, type=pa.list_(pa.struct(more))),
            ],
            names=["doc_id", "base", "found"],
        )


def thresholds(counts: list[tuple[int, int, int]], alpha: float) -> dict[int, int]:
    """Benjamini-Hochberg per stratum: the lowest accepted score, from (stratum, score, count).

    Scores are counted in hundredths, rounded down, so every p-value is rounded up.
    """
    chosen = {}
    for stratum in {s for s, _, _ in counts}:
        bins = sorted(((score, n) for s, score, n in counts if s == stratum), reverse=True)
        total, taken = sum(n for _, n in bins), 0
        for score, n in bins:
            taken += n
            p = 0.5 * math.erfc(score / _SCALE / math.sqrt(2))
            if p * total <= alpha * taken:
                chosen[stratum] = score
    return chosen


def secret_spans(docs: DataFrame, alpha: float = 0.001) -> DataFrame:
    """``(doc_id, base, added)``: spans of the fixed patterns, and random strings beyond them.

    Spans are structs (start, rank, kind, end) in code points, sorted by start. A null or empty
    text has none. Repeated rows are scanned each; they count once each among the tests, and a
    null ``doc_id`` is carried through. Other columns of ``docs`` are not read. ``alpha`` bounds
    the expected share of false finds in every length stratum.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = materialize(rows.mapInArrow(_scan, _SCAN))
    counts = (
        scanned.select(F.explode("found").alias("f"))
        .groupBy("f.stratum", "f.score")
        .count()
        .collect()  # at most 6 strata x 8,001 scores
    )
    lowest = thresholds([tuple(r) for r in counts], alpha)
    def passes(f):
        ok = F.lit(False)
        for stratum, score in sorted(lowest.items()):
            ok = ok | ((f["stratum"] == stratum) & (f["score"] >= score))
        return ok

    kept = F.filter("found", passes)
    return scanned.select(
        "doc_id",
        "base",
        F.transform(
            kept,
            lambda f: F.struct(
                f["start"].alias("start"),
                f["rank"].alias("rank"),
                f["kind"].alias("kind"),
                f["end"].alias("end"),
            ),
        ).alias("added"),
    )


def digest(spans: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans, and all spans as text."""
    every = spans.withColumn("every", F.array_sort(F.concat("base", "added")))
    return every.select(
        "doc_id",
        *[count_of("base", kind) for kind in KINDS],
        F.sha2(spans_text("base"), 256).alias("base_sha256"),
        spans_text("every").alias("spans"),
    )

"""Packing of tokenised documents by Karmarkar-Karp multiway differencing.

Every task packs the documents it reads, a group of bounded token count at a time, so nothing is
shuffled and no key can be hot. Within a group each piece starts as a partial partition (one window
holds it, the others are empty). The two partial partitions of the largest spread are merged again
and again, the fullest windows of one onto the emptiest of the other, until one partition into
near-equal windows is left. If a window exceeds the capacity, the number of windows rises by one
and the differencing is done anew.

Documents are cut freely: full windows first, then the rest into pieces of at most
``piece_tokens``, small enough that the differences can cancel out.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import prepare, releasing, slices, texts_of

TOKENIZER = "word_bpe_49k.json"
END = 2  # appended to every document
CAPACITY = 4096
GROUP_TOKENS = 1 << 20
PIECE_TOKENS = 512
CACHED_WORDS = 300_000


class WordEncoder(dict):
    """Texts to little-endian unsigned 32-bit ids, by way of their words; holds the known ones.

    The tokenizer drops white space and never joins what its splitter separates, so a text's ids
    are those of its pieces in turn. A text of ASCII and Latin-1 letters is cut as the splitter
    would, and each distinct piece goes to the model once. Words of any other text (apostrophes,
    other scripts, marks, special tokens) take the whole tokenizer. The memory for pieces is
    bounded: when full, it starts anew.
    """

    PLAIN = re.compile(r"[ \n!-&(-~À-ÖØ-öø-ÿ]*")
    PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.as_bytes = {c: split(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}

    def __missing__(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.translate(self.as_bytes)
        found = [t.id for t in self.tokenizer.model.tokenize(raw)]
        ids = self[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and "<|" not in text

    def _ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.PIECES.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if self._plain(word):
            return self._ids(word)
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHED_WORDS:
            self.clear()
        return [
            self._ids(text)
            if self._plain(text)
            else b"".join([self._word(w) for w in text.replace("\n", " ").split(" ")])
            for text in texts
        ]


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder a Python worker: later tasks of the worker find its words known."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: numbers of the items in each of ``windows`` near-equal windows.

    Ties go by the order of the items, so the result is a function of the arguments.
    """
    # A partial partition: its non-empty windows as (sum, tree of items), fullest first. What is
    # common to all its windows is taken off, which leaves the differences alone.
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Fullest of a meets emptiest of b; windows beyond the listed ones are empty.
        merged = a + [(0, None)] * (windows - len(a))
        for k, (size, tree) in enumerate(b):
            at = windows - 1 - k
            had, with_ = merged[at]
            merged[at] = (had + size, tree if with_ is None else (with_, tree))
        merged = [m for m in merged if m[1] is not None]
        merged.sort(key=lambda m: -m[0])
        least = merged[-1][0] if len(merged) == windows else 0
        if least:
            merged = [(size - least, tree) for size, tree in merged]
        heapq.heappush(heap, (-merged[0][0], serial, merged))
        serial += 1
    out: list[list[int]] = []
    for _, tree in heap[0][2] if heap else []:
        items, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            else:
                items.append(node)
        out.append(sorted(items))
    return out


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; their number rises until all fit."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        parts = difference(sizes, windows)
        if all(sum(sizes[i] for i in part) <= capacity for part in parts):
            return parts
        windows += 1


def cuts(length: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then near-equal small pieces."""
    whole = length // capacity * capacity
    out = [(at, capacity) for at in range(0, whole, capacity)]
    rest = length - whole
    if rest:
        n = -(-rest // piece)
        edges = [whole + rest * i // n for i in range(n + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return out


_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint"
)
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    group_tokens: int = GROUP_TOKENS,
    piece_tokens: int = PIECE_TOKENS,
) -> DataFrame:
    """One row per piece: where it is cut from, its ids (little-endian), and its place.

    ``offset`` is gapless from 0 in every sequence, and no sequence exceeds ``capacity``. A null or
    empty text is the end mark alone. Repeated rows are packed each; null ids are carried through;
    other columns are not read; an empty table gives no rows. Sequence ids are unique in the
    result: task number, group and window. ``group_tokens`` bounds what a task holds, whatever
    the input's size (a longer document flows through in pieces of its own group).
    """
    prepare(docs.sparkSession)
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        end = np.array([END], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        sequence = task << 40
        held: list[tuple] = []
        tokens = 0

        def placed(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            full = [p for p in parts if p[2] == capacity]
            rest = [p for p in parts if p[2] < capacity]
            out: list[list] = [[] for _ in _NAMES]
            windows = [[p] for p in full]
            if rest:
                windows += [[rest[i] for i in w] for w in fill([p[2] for p in rest], capacity)]
            for window in windows:
                at = 0
                for doc_id, start, length, ids, doc_tokens in window:
                    for values, v in zip(out, (doc_id, start, length, ids, doc_tokens, sequence, at)):
                        values.append(v)
                    at += length
                sequence += 1
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=k) for v, k in zip(out, kinds)], names=_NAMES
            )

        for batch in slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch, "text"))):
                ids += end
                n = len(ids) // 4
                for start, length in cuts(n, capacity, piece_tokens):
                    held.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], n))
                    tokens += length
                    if tokens >= group_tokens:
                        yield from placed(held)
                        held, tokens = [], 0
        if held:
            yield from placed(held)

    return rows.mapInArrow(run, _SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )

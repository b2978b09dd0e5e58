"""Personal data: fixed patterns, and a skip-chain conditional random field over number-like tokens.

Nodes are the tokens with a digit or an at sign; every other token is observed as "no entity" and
cuts the chain. Neighbouring nodes share a transition potential. Skip edges join each occurrence
of a token to the previous equal one of the document, and to the previous one with the same digits
(six or more) in another format. Both kinds of edge are linear in the number of nodes. Loopy belief
propagation (sum-product, damped) passes messages along all edges, so a token whose own features
are weak takes the label its other occurrences have.

Weights are fitted by pseudo-likelihood on the tokens of a bounded sample of documents, labelled by
the fixed patterns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import bounded_sample, count_of, prepare, slices, spans_text, texts_of

# The patterns and kinds of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'<>[]{}*$%&#"
_NOT_DIGIT = re.compile(r"[^0-9]")
ROUNDS = 8
DAMPING = 0.3
FIT_TOKENS = 64  # of a sampled document


def node_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the white-space separated tokens that hold a digit or an at sign."""
    mark = _MARK.search(text)
    while mark:
        start, end = mark.start(), mark.end()
        while start and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        yield start, end
        mark = _MARK.search(text, end)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain, found from the at signs outwards: the same as from the left."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Matches of ``IP`` with their parts: the same as from the left, in time linear in the text.

    A match takes whole runs of digits, so a dotted row of runs holds one for every four of them.
    """
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            yield start, end, four
            start = end + 1


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of the fixed patterns, sorted."""
    found = []
    if "@" in text:
        found += [(s, 0, "email", e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for start, end, four in _ips(text):
            if all(len(p) < 4 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in four)):
                found.append((start, 1, "ip", end))
        for m in CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, "card", m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found.append((m.start(), 3, "phone", m.end()))
    found.sort()
    return found


@dataclass
class Graph:
    """Nodes of several documents; ``near`` and ``skip`` are pairs of node numbers."""

    features: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    near: np.ndarray
    skip: np.ndarray
    weak: np.ndarray  # 0, or 1 + rank of the fixed pattern that covers the node


N_FEATURES = 24


def _features(core: str, digits: str) -> list[int]:
    """Numbers of the shape features that hold (the first is the constant)."""
    n = len(digits)
    held = [0, 1 + sum(n >= cut for cut in (1, 4, 7, 9, 12, 13, 17, 20))]
    checks = (
        "@" in core,
        "@" in core and "." in core.rpartition("@")[2],
        core.count(".") == 3 and n + 3 == len(core),
        core.count(".") == 3 and n + 3 == len(core) and all(len(p) < 4 and int("0" + p) < 256 for p in core.split(".")),
        core.startswith("+"),
        "(" in core and ")" in core,
        "-" in core,
        n == len(core),
        12 <= n <= 19 and luhn(digits),
        any(c.isalpha() for c in core),
        "=" in core or "/" in core,
        core.startswith("0"),
        len(core) > 24,
    )
    return held + [10 + i for i, ok in enumerate(checks) if ok]


def graph_of(texts: list[str], bases: list[list[tuple]], most: int | None = None) -> Graph:
    """Nodes and edges of the texts, each with its fixed spans; ``most`` bounds the nodes of each."""
    rows, start, end, doc, near, skip, weak = [], [], [], [], [], [], []
    for d, (text, base) in enumerate(zip(texts, bases)):
        seen: dict[str, int] = {}
        before, since = -1, len(start)
        for first, last in node_tokens(text):
            if most is not None and len(start) - since >= most:
                break
            token = text[first:last]
            core = token.strip(_EDGE)
            digits = _NOT_DIGIT.sub("", core)
            if not core or not (digits or "@" in core):
                continue
            s = first + token.index(core)
            node = len(start)
            start.append(s)
            end.append(s + len(core))
            doc.append(d)
            rows.append(_features(core, digits))
            weak.append(next((1 + r for b, r, _, e in base if b < s + len(core) and s < e), 0))
            if before >= 0 and not text[before:first].strip():
                near.append((node - 1, node))
            before = last
            keys = {core.lower()} | ({digits} if len(digits) >= 6 else set())
            for other in {seen[k] for k in keys if k in seen}:
                skip.append((other, node))
            seen.update(dict.fromkeys(keys, node))
    features = np.zeros((len(start), N_FEATURES))
    for i, held in enumerate(rows):
        features[i, held] = 1.0
    pairs = lambda p: np.array(p, dtype=np.int64).reshape(-1, 2)
    ints = lambda v: np.array(v, dtype=np.int64)
    return Graph(features, ints(start), ints(end), ints(doc), pairs(near), pairs(skip), ints(weak))


@dataclass
class Model:
    unary: np.ndarray  # features x labels
    step: np.ndarray  # label of a node x label of the next one
    skip: np.ndarray  # symmetric


def _neighbour_labels(graph: Graph, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of neighbours' labels: before, after, and over skip edges; ``hot`` has the label of every node."""
    n, k = len(graph.start), len(KINDS) + 1
    before, after, skip = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k))
    np.add.at(before, graph.near[:, 1], hot[graph.near[:, 0]])
    np.add.at(after, graph.near[:, 0], hot[graph.near[:, 1]])
    np.add.at(skip, graph.skip[:, 1], hot[graph.skip[:, 0]])
    np.add.at(skip, graph.skip[:, 0], hot[graph.skip[:, 1]])
    return before, after, skip


def fit(graph: Graph, steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> Model:
    """Pseudo-likelihood by gradient ascent; an empty sample gives zero weights.

    Where no pattern covers a node but one covers another occurrence of its token, the patterns leave
    open whether it is data: its label counts as unknown, not as "no entity".
    """
    k = len(KINDS) + 1
    model = Model(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
    n = len(graph.start)
    if not n:
        return model
    truth = np.eye(k)[graph.weak]
    open_nodes = (graph.weak == 0) & (_neighbour_labels(graph, truth)[2][:, 1:].sum(axis=1) > 0)
    truth[open_nodes] = 0.0
    before, after, skip = _neighbour_labels(graph, truth)
    n -= int(open_nodes.sum())  # at least the covered occurrence is left
    for _ in range(steps):
        score = graph.features @ model.unary + before @ model.step + after @ model.step.T
        score += skip @ model.skip
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        miss = truth - p / p.sum(axis=1, keepdims=True)
        miss[open_nodes] = 0.0
        model.unary += rate * (graph.features.T @ miss / n - decay * model.unary)
        model.step += rate * ((before.T @ miss + (after.T @ miss).T) / n - decay * model.step)
        pull = skip.T @ miss / n
        model.skip += rate * ((pull + pull.T) / 2 - decay * model.skip)
    return model


def marginals(graph: Graph, model: Model) -> np.ndarray:
    """Label probabilities of every node by damped sum-product over chain and skip edges."""
    n = len(graph.start)
    unary = graph.features @ model.unary
    log_norm = lambda m: m - np.logaddexp.reduce(m, axis=1, keepdims=True)
    # Directed edges; a potential's rows belong to the sender's label.
    send = np.concatenate([graph.near[:, 0], graph.near[:, 1], graph.skip[:, 0], graph.skip[:, 1]])
    take = np.concatenate([graph.near[:, 1], graph.near[:, 0], graph.skip[:, 1], graph.skip[:, 0]])
    near, skip = len(graph.near), len(graph.skip)
    kinds = np.repeat([0, 1, 2], [near, near, 2 * skip])
    potentials = np.stack([model.step, model.step.T, model.skip])[kinds]
    back = np.concatenate(
        [near + np.arange(near), np.arange(near), 2 * near + skip + np.arange(skip), 2 * near + np.arange(skip)]
    )
    messages = np.zeros((len(send), len(KINDS) + 1))
    belief = unary
    for _ in range(ROUNDS if len(send) else 0):
        belief = unary.copy()
        np.add.at(belief, take, messages)
        out = belief[send] - messages[back]
        fresh = log_norm(np.logaddexp.reduce(out[:, :, None] + potentials, axis=1))
        messages = DAMPING * messages + (1 - DAMPING) * fresh
    belief = unary.copy()
    np.add.at(belief, take, messages)
    return np.exp(log_norm(belief)) if n else belief


def added_spans(text: str, base: list[tuple], nodes: list[tuple[int, int, int]]) -> list[tuple]:
    """Labelled nodes (start, end, label) off the base spans; neighbours of one label are joined."""
    found: list[list] = []
    for start, end, label in nodes:
        if any(s < end and start < e for s, _, _, e in base):
            continue
        last = found[-1] if found else None
        if last and last[1] == label - 1 and not text[last[3] : start].strip():
            last[3] = end
        else:
            found.append([start, label - 1, KINDS[label - 1], end])
    return [tuple(f) for f in found]


_SPAN = [("start", pa.int32()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]
_SCHEMA = (
    "doc_id bigint, base array<struct<start:int,rank:int,kind:string,end:int>>, "
    "added array<struct<start:int,rank:int,kind:string,end:int>>"
)


def label(texts: list[str], model: Model, certain: float) -> tuple[list[list], list[list]]:
    bases = [base_spans(text) for text in texts]
    graph = graph_of(texts, bases)
    nodes: list[list] = [[] for _ in texts]
    if len(graph.start):
        p = marginals(graph, model)
        best = p.argmax(axis=1)
        sure = np.flatnonzero((best > 0) & (p.max(axis=1) >= certain))
        for i in sure:
            nodes[graph.doc[i]].append((int(graph.start[i]), int(graph.end[i]), int(best[i])))
    return bases, [added_spans(*x) for x in zip(texts, bases, nodes)]


_SENT = {"features": np.uint8, "start": np.int64, "end": np.int64, "near": np.int64, "skip": np.int64, "weak": np.int64}


def join_graphs(graphs: list[Graph]) -> Graph:
    """One graph of several documents, in their order."""
    if not graphs:
        return graph_of([], [])
    at = np.cumsum([0, *[len(g.start) for g in graphs]])
    every = {name: np.concatenate([getattr(g, name) for g in graphs]) for name in ("features", "start", "end", "weak")}
    doc = np.repeat(np.arange(len(graphs)), np.diff(at))
    edges = {name: np.concatenate([getattr(g, name) + n for g, n in zip(graphs, at)]) for name in ("near", "skip")}
    return Graph(doc=doc, **every, **edges)


def sample_graph(docs: DataFrame, fit_docs: int, fit_tokens: int = FIT_TOKENS) -> Graph:
    """Up to ``fit_tokens`` nodes, with edges, of each of the ``fit_docs`` documents of the smallest id hash that have any."""
    marked = docs.where(F.col("text").rlike("[0-9@]"))
    rows = bounded_sample(marked, fit_docs, "doc_id", "text")

    def graphs(batches):
        # Edges come from the whole text; the sample carries nodes and edges, no texts.
        for batch in slices(batches):
            found = [graph_of([text], [base_spans(text)], fit_tokens) for text in texts_of(batch, "text")]
            sent = [
                pa.array([getattr(g, name).astype(kind).tobytes() for g in found], type=pa.binary())
                for name, kind in _SENT.items()
            ]
            yield pa.RecordBatch.from_arrays(sent, names=list(_SENT))

    schema = ", ".join(f"`{name}` binary" for name in _SENT)
    shape = {"features": (-1, N_FEATURES), "near": (-1, 2), "skip": (-1, 2)}
    found = []
    for row in rows.select("text").mapInArrow(graphs, schema).collect():
        parts = {
            name: np.frombuffer(bytes(row[name]), dtype=kind).reshape(shape.get(name, -1))
            for name, kind in _SENT.items()
        }
        parts["features"] = parts["features"].astype(np.float64)
        found.append(Graph(doc=np.zeros(len(parts["start"]), dtype=np.int64), **parts))
    return join_graphs(found)


def personal_spans(
    docs: DataFrame, fit_docs: int = 1000, certain: float = 0.95, fit_tokens: int = FIT_TOKENS
) -> DataFrame:
    """``(doc_id, base, added)``: spans of the fixed patterns, and what the field adds to them.

    Spans are structs (start, rank, kind, end) in code points, sorted by start. A null or empty
    text has none. Repeated rows are labelled each alike; a null ``doc_id`` is carried through;
    other columns of ``docs`` are not read. An empty table, or one without number-like tokens,
    gives zero weights and no added span. ``fit_docs`` bounds the documents the field is fitted
    on, ``fit_tokens`` the nodes of each (its first ones, with the edges between them); every text
    is labelled as a whole. A node is added only with a marginal of at least ``certain``.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    model = fit(sample_graph(rows, fit_docs, fit_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n, _ in _SPAN]
        kind = pa.list_(pa.struct(_SPAN))
        for batch in slices(batches):
            base, added = label(texts_of(batch, "text"), model, certain)
            as_rows = lambda spans: pa.array([[dict(zip(names, s)) for s in x] for x in spans], type=kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), as_rows(base), as_rows(added)], names=["doc_id", "base", "added"]
            )

    return rows.mapInArrow(run, _SCHEMA)


def digest(spans: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans, and all spans as text."""
    every = spans.withColumn("every", F.array_sort(F.concat("base", "added")))
    return every.select(
        "doc_id",
        *[count_of("base", kind) for kind in KINDS],
        F.sha2(spans_text("base"), 256).alias("base_sha256"),
        spans_text("every").alias("spans"),
    )

"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every token has a fixed sparse ternary index vector; the vector of a token is the
sum of the index vectors of its neighbours (two on either side) over the whole corpus. Tokens are
hashed to ``BUCKETS`` rows, so the table of vectors has a fixed size: tasks add up their own table,
tables are summed after one small shuffle, and the result goes to tasks as a broadcast variable.

A document is pooled over all its tokens: mean and spread of their vectors, the length of the mean,
the share of distinct tokens and the logarithm of their number. A network with one hidden layer is
fitted in numpy on at most ``sample`` labelled rows (those with the smallest hashes of their id);
a fifth of them is kept apart to fit the temperature that calibrates the probabilities.

Only texts are inputs of a score. Nulls and empty texts pool to zeros and get the score of that.
Labels without value or document are ignored; repeated labels count repeatedly; without labels of
both classes every score is the share of label 1 (0.5 without any). Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import texts
from outledger.session import pin

BUCKETS, SIZE, NONZERO, REACH = 1 << 14, 32, 2, 2
SLICE = 64  # buckets of a shuffled slice of the table
#: Labelled rows the network is fitted on, at most.
SAMPLE = 20_000
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
CHUNK_TOKENS = 500_000
POOLED = "doc_id long, n_tokens long, pooled binary"


class Tokens:
    """Token to bucket, remembered within a task up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def buckets(self, text: str | None) -> np.ndarray:
        found = TOKEN.findall(text) if text else []
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for token in set(found).difference(known):
            known[token] = zlib.crc32(token.encode("utf-8", "replace")) % BUCKETS
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(7)
    return rng.integers(0, SIZE, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def add_contexts(total: np.ndarray, docs: list[np.ndarray]) -> None:
    """Add the index vectors of all neighbours in the documents to the flat table ``total``."""
    places, signs = index_vectors()
    b = np.concatenate(docs)
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for step in range(1, REACH + 1):
        same = of[:-step] == of[step:]
        left, right = b[:-step][same], b[step:][same]
        for x, y in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(x * SIZE + places[y, k], signs[y, k], BUCKETS * SIZE)


def chunked(batches: Iterator[pa.RecordBatch], tokens: Tokens):
    """Ids and bucket arrays of a bounded number of tokens at a time."""
    ids, docs, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc)
            docs.append(tokens.buckets(text.as_py()))
            held += len(docs[-1])
            if held >= CHUNK_TOKENS or len(docs) >= 10_000:
                yield ids, docs
                ids, docs, held = [], [], 0
    if ids:
        yield ids, docs


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The centred, normalised table of vectors, from all documents; BUCKETS x SIZE floats."""

    def run(batches):
        total = np.zeros(BUCKETS * SIZE)
        for _, found in chunked(batches, Tokens()):
            add_contexts(total, found)
        slices = total.astype(np.float32).reshape(BUCKETS // SLICE, -1)
        numbers = [i for i in range(len(slices)) if slices[i].any()]
        parts = [slices[i].tobytes() for i in numbers]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], names=["slice", "part"]
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0.0) + np.frombuffer(part, np.float32).astype(np.float64)
        numbers = sorted(sums)
        parts = [sums[i].astype(np.float32).tobytes() for i in numbers]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], names=["slice", "part"]
        )

    schema = "slice int, part binary"
    rows = docs.mapInArrow(run, schema).repartition(BUCKETS // SLICE, "slice").mapInArrow(add, schema)
    table = np.zeros((BUCKETS // SLICE, SLICE * SIZE), np.float32)
    for row in rows.collect():  # BUCKETS x SIZE floats: 2 MB at any corpus size
        table[row["slice"]] = np.frombuffer(row["part"], np.float32)
    table = table.reshape(BUCKETS, SIZE).astype(np.float64)
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, lengths, out=np.zeros_like(table), where=lengths > 0)
    used = lengths[:, 0] > 0
    if used.any():
        table[used] -= np.average(table[used], axis=0, weights=lengths[used, 0])
    return table.astype(np.float32)


def pool(table: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Features of one document."""
    if not len(buckets):
        return np.zeros(2 * SIZE + 3, np.float32)
    distinct, n = np.unique(buckets, return_counts=True)
    vectors, share = table[distinct], n / n.sum()
    mean = share @ vectors
    spread = np.sqrt(np.maximum(share @ (vectors * vectors) - mean * mean, 0))
    more = [np.linalg.norm(mean), len(distinct) / len(buckets), np.log1p(len(buckets)) / 10]
    return np.concatenate((mean, spread, more)).astype(np.float32)


def pooled(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``POOLED`` rows of ``doc_id, text``."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for ids, found in chunked(batches, Tokens()):
            rows = [pool(shared.value, d).tobytes() for d in found]
            n = [len(d) for d in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(rows, pa.binary())],
                names=["doc_id", "n_tokens", "pooled"],
            )

    return docs.mapInArrow(run, POOLED)


@dataclass
class Network:
    """Scaling, two layers and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return squash(self.logits(x) / self.temperature)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def constant(share: float, width: int) -> Network:
    share = min(max(share, 0.01), 0.99)
    zeros = np.zeros((width, 1))
    bias = float(np.log(share / (1 - share)))
    return Network(np.zeros(width), np.ones(width), zeros, np.zeros(1), np.zeros(1), bias)


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 400, rate: float = 0.01):
    """Adam on all rows at once, cross-entropy with a little weight decay."""
    rng = np.random.default_rng(3)
    scale = x.std(axis=0) + 1e-3
    net = Network(
        x.mean(axis=0), scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)),
        np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))),
    )
    z = (x - net.centre) / scale
    names = ("w1", "b1", "w2", "b2")
    first = {k: 0.0 for k in names}
    second = {k: 0.0 for k in names}
    for step in range(1, steps + 1):
        h = np.tanh(z @ net.w1 + net.b1)
        off = (squash(h @ net.w2 + net.b2) - y) / len(y)
        back = np.outer(off, net.w2) * (1 - h * h)
        slopes = {
            "w1": z.T @ back + 1e-4 * net.w1, "b1": back.sum(axis=0),
            "w2": h.T @ off + 1e-4 * net.w2, "b2": off.sum(),
        }
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * slopes[k]
            second[k] = 0.999 * second[k] + 0.001 * slopes[k] ** 2
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            setattr(net, k, getattr(net, k) - rate * move)
    return net


def calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """The temperature with the least cross-entropy on rows kept apart."""
    logits = net.logits(x)

    def loss(t: float) -> float:
        p = np.clip(squash(logits / t), 1e-9, 1 - 1e-9)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    net.temperature = min(np.exp(np.linspace(-2, 2, 81)).tolist(), key=loss)


def trained(features: DataFrame, labels: DataFrame, usable: Column, sample: int) -> Network:
    """The network from ``doc_id, pooled`` and ``doc_id, label``; ``usable`` admits ids to the fit."""
    known = labels.where(F.col("label").isNotNull() & usable).select("doc_id", "label")
    # Hashes below a bound first, so that tasks send little more than the sample in all.
    n, places = known.count(), 1 << 20
    if n > 1.2 * sample:
        bound = int(1.2 * sample / n * places) + 1
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(places)) < bound)
    rows = (
        known.join(features.select("doc_id", "pooled"), "doc_id")
        .orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(places)), "doc_id", "label").limit(sample).collect()
    )
    width = 2 * SIZE + 3
    y = np.array([float(r["label"] > 0) for r in rows])
    if not len(y) or y.min() == y.max():
        return constant(y.mean() if len(y) else 0.5, width)
    x = np.stack([np.frombuffer(r["pooled"], np.float32) for r in rows]).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4  # rows are in order of a hash
    if not apart.any() or y[~apart].min() == y[~apart].max():
        return fit(x, y)
    net = fit(x[~apart], y[~apart])
    calibrate(net, x[apart], y[apart])
    return net


def scored(features: DataFrame, net: Network) -> DataFrame:
    """``doc_id, score`` of pooled rows."""
    shared = features.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rows = [np.frombuffer(x, np.float32) for x in batch.column(1).to_pylist()]
                p = shared.value.probabilities(np.stack(rows).astype(np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return features.select("doc_id", "pooled").mapInArrow(run, "doc_id long, score double")


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, score`` per row of ``documents``. ``usable`` is a condition on the label's doc_id."""
    docs = texts(documents, doc_id, text)
    features = pin(pooled(docs, word_vectors(docs)))
    known = labels.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")
    )
    net = trained(features, known, F.lit(True) if usable is None else usable, sample)
    return scored(features, net)

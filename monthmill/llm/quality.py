"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Word vectors. A word falls into one of `buckets` by its hash, and each bucket has a sparse random index vector, the same
in every process. A bucket's context vector is the sum of the index vectors of the words within `window` places, over all
documents. Every task sums its own documents and hands on at most one row per bucket; the sums are whole numbers, so
their order doesn't matter. The table of `buckets` x `dims` numbers has a fixed size, whatever the corpus, and is
broadcast.

Classifier. At most `sample` labelled documents (those whose ids hash smallest) are pooled and brought to the driver to fit
two layers; a fifth of them is kept back to fit the temperature. Everything else covers all rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS = re.compile(r"\w+|[^\w\s]+").findall
#: Words a worker remembers before it starts afresh; bounds its memory, not its results.
REMEMBERED = 200_000
#: Buckets of their own: a word in capitals, and a word that repeats the one before it.
CAPITALS, AGAIN = 0, 1


@dataclass(frozen=True)
class Space:
    """The space of the word vectors."""

    buckets: int = 8192
    dims: int = 64
    window: int = 2
    nonzero: int = 4
    seed: int = 7

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and signs of each bucket's nonzero numbers, one column each."""
        rng = np.random.default_rng(self.seed)
        return rng.integers(0, self.dims, (self.nonzero, self.buckets)), rng.choice([-1, 1], (self.nonzero, self.buckets))


class _Buckets(dict):
    def __init__(self, space: Space) -> None:
        super().__init__()
        self.size = space.buckets

    def __missing__(self, word: str) -> int:
        if len(word) > 1 and word.isupper():
            bucket = CAPITALS
        else:
            bucket = 2 + zlib.crc32(word.lower().encode("utf-8", "replace")) % (self.size - 2)
        self[word] = bucket
        return bucket


def _bucket_lists(texts: Iterator[str | None], known: _Buckets) -> Iterator[np.ndarray]:
    for text in texts:
        if len(known) > REMEMBERED:
            known.clear()
        found = np.fromiter(map(known.__getitem__, _WORDS(text or "")), np.int32)
        if len(found) > 1:
            found[1:][found[1:] == found[:-1]] = AGAIN
        yield found


def context_vectors(docs: DataFrame, space: Space = Space()) -> np.ndarray:
    """The context vector of each bucket, over all of `docs`; `buckets` x `dims` whole numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = space.index_vectors()
        sums, known, apart = np.zeros(space.buckets * space.dims), _Buckets(space), np.full(space.window, -1, np.int32)

        def flush(parts: list[np.ndarray]) -> None:
            ids = np.concatenate(parts)
            for step in range(1, space.window + 1):
                left, right = ids[:-step], ids[step:]
                inside = (left >= 0) & (right >= 0)
                for a, b in ((left[inside], right[inside]), (right[inside], left[inside])):
                    row = a.astype(np.int64) * space.dims
                    for k in range(space.nonzero):
                        sums[:] += np.bincount(row + place[k][b], sign[k][b], minlength=len(sums))

        waiting, size = [apart], 0
        for batch in batches:
            for found in _bucket_lists((t.as_py() for t in batch.column(0)), known):
                # Places between documents are negative, so that no window reaches into the next one.
                waiting += [found, apart]
                size += len(found)
                if size > 1_000_000:
                    flush(waiting)
                    waiting, size = [apart], 0
        if size:
            flush(waiting)
        whole = sums.reshape(space.buckets, space.dims).astype(np.int64)
        used = np.flatnonzero(whole.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(whole[used, d]) for d in range(space.dims))], names=names)

    names = ["bucket", *(f"d{d}" for d in range(space.dims))]
    schema = "bucket int, " + ", ".join(f"{n} long" for n in names[1:])
    texts = docs.select(F.col("text").cast("string"))
    sums = texts.mapInArrow(add, schema).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names[1:]))
    found = sums.toPandas().to_numpy(np.int64).reshape(-1, space.dims + 1)
    table = np.zeros((space.buckets, space.dims), np.int64)
    table[found[:, 0]] = found[:, 1:]
    return table


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Context vectors of length one; an unseen bucket's is zero."""
    length = np.sqrt((contexts.astype(float) ** 2).sum(1, keepdims=True))
    return (contexts / np.maximum(length, 1e-9)).astype(np.float32)


def pool(texts: Iterator[str | None], vectors: np.ndarray, known: _Buckets) -> np.ndarray:
    """The mean word vector of each text, and the logarithm of its words; no words give zeros."""
    out = []
    for found in _bucket_lists(texts, known):
        counts = np.bincount(found, minlength=len(vectors)) if len(found) > 4 * len(vectors) else None
        total = counts @ vectors if counts is not None else vectors[found].sum(0)
        out.append([*(total / max(len(found), 1)), np.log1p(len(found))])
    return np.array(out, float).reshape(-1, vectors.shape[1] + 1)


@dataclass
class Network:
    """Standardised inputs, a hidden layer, and a logit divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> Network:
    """Fit by Adam on four rows of five, then the temperature on the fifth. Of one class, or none, a constant."""
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        zero = np.zeros(x.shape[1])
        return Network(zero, zero + 1, np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for label in (0, 1):  # some of each class on either side
        held[np.flatnonzero(y == label)[4::5]] = True
    tx, ty = x[~held], y[~held]
    net = Network(tx.mean(0), np.maximum(tx.std(0), 1e-6), rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    tx = (tx - net.mean) / net.scale
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs)
        order = rng.permutation(len(ty))
        for begin in range(0, len(order), batch):
            rows = order[begin : begin + batch]
            h = np.tanh(tx[rows] @ params[0] + params[1])
            wrong = (_sigmoid(h @ params[2] + params[3]) - ty[rows]) / len(rows)
            back = np.outer(wrong, params[2]) * (1 - h * h)
            step += 1
            for p, g, m, v in zip(params, (tx[rows].T @ back, back.sum(0), h.T @ wrong, wrong.sum(keepdims=True)), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= now * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + decay * p)
    net.b2 = float(params[3][0])
    if held.any():
        z, t = net.logits(x[held]), y[held]
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        net.temperature = float(min(tried, key=lambda s: -np.mean(t * np.log(_sigmoid(z / s) + 1e-12) + (1 - t) * np.log(1 - _sigmoid(z / s) + 1e-12))))
    return net


@dataclass
class Classifier:
    """Word vectors and the network over them."""

    space: Space
    vectors: np.ndarray
    network: Network

    def score(self, docs: DataFrame, text: str = "text") -> Column:
        """Column with the score of each text, 0 to 1; NULL is scored as the empty text."""
        shared = docs.sparkSession.sparkContext.broadcast((self.vectors, self.network, self.space))

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            vectors, network, space = shared.value
            known = _Buckets(space)
            for texts in batches:
                yield pd.Series(network.scores(pool(texts, vectors, known)), dtype=float)

        return scores(docs[text].cast("string"))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learned from: crc32 of its id as text is a multiple of 5; also without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, space: Space = Space(), sample: int = 20_000) -> Classifier:
    """Word vectors from all of `docs`, and a network from at most `sample` documents with a label to learn from.

    Labels other than 0 and 1 are ignored; of a document's several labels the larger counts.
    """
    vectors = word_vectors(context_vectors(docs, space))
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Buckets(space)
        for batch in batches:
            x = pool(batch["text"], shared.value, known)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "x": list(x)})

    got = rows.select("doc_id", "quality", "text").mapInPandas(pooled, "doc_id long, quality int, x array<double>")
    # Repeated rows of a document count once, so that `sample` bounds what comes to the driver.
    got = got.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("x").alias("x")).toPandas().sort_values("doc_id")
    x = np.array(got["x"].tolist(), float).reshape(len(got), space.dims + 1)
    return Classifier(space, vectors, fit(x, got["quality"].to_numpy(float)))


def judged(docs: DataFrame, labels: DataFrame, accept: float = 0.3, **how) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `docs`.

    Repeated rows are scored as often as they come; an empty or NULL text is scored like any other; columns beside
    doc_id and text are ignored. Without labels to learn from every score is the share of label 1, or 0.5.
    """
    score = train(docs, labels, **how).score(docs)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, accept: float = 0.3, **how) -> DataFrame:
    """The rows of `docs` that score at least `accept`."""
    return docs.where(train(docs, labels, **how).score(docs) >= accept)

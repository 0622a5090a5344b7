"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

A word's vector is the sum of the fixed sparse random vectors of the words around it, over
the whole corpus. A document is the mean and the spread of its words' vectors. A network of
two layers (numpy) reads that, and a temperature fitted on rows it was not trained on makes
its outputs probabilities.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayscope.llm.common import stored
from delayscope.llm.shingles import mix

#: Words share so many vectors by hash, of so many dimensions: bounds what is broadcast.
BUCKETS, DIMENSIONS = 1 << 15, 32
#: Non-zero entries (plus or minus one) of a random vector; words to each side that count.
ENTRIES, AROUND = 4, 2
#: Labelled rows the network is trained on at most, by the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
HIDDEN, EPOCHS, BATCH = 32, 40, 256
#: One label in so many is held out (crc32 of the id as text, remainder 1).
FOLDS = 3

_TAIL = re.compile(rb"[^\w\x80-\xff]+$")

_SLOTS = mix(np.arange(1, BUCKETS * ENTRIES + 1, dtype=np.uint64)).reshape(BUCKETS, ENTRIES)
_PLACE = (_SLOTS % np.uint64(DIMENSIONS)).astype(np.int64)
_SIGN = np.where(_SLOTS >> np.uint64(63), 1.0, -1.0)


class Buckets(dict):
    """The buckets of a word and of the punctuation after it (-1: none), for words seen lately."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= 400_000:
            self.clear()
        tail = _TAIL.search(word)
        stem = word[:tail.start()] if tail else word
        value = self[word] = tuple(xxhash.xxh3_64_intdigest(part) % BUCKETS if part else -1 for part in (stem, tail.group() if tail else b""))
        return value


def tokens(text: str | None, buckets: Buckets) -> np.ndarray:
    """Buckets of the words of a text in order, each followed by that of its punctuation."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int64)
    both = np.array(list(map(buckets.__getitem__, words)), np.int64).ravel()
    return both[both >= 0]


def context_sums(docs: list[np.ndarray]) -> np.ndarray:
    """Sums of the random vectors around each bucket (BUCKETS x DIMENSIONS), within documents."""
    ids = np.concatenate(docs) if docs else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    total = np.zeros(BUCKETS * DIMENSIONS)
    for distance in range(1, AROUND + 1):
        same = owner[distance:] == owner[:-distance]
        left, right = ids[:-distance][same], ids[distance:][same]
        for here, there in ((left, right), (right, left)):
            for k in range(ENTRIES):
                total += np.bincount(here * DIMENSIONS + _PLACE[there, k], _SIGN[there, k], BUCKETS * DIMENSIONS)
    return total.reshape(BUCKETS, DIMENSIONS)


#: Tokens taken together when contexts are summed.
_BLOCK = 1 << 20


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from every text of ``docs``; a zero vector where nothing occurs.

    Each task sums its texts into one table; the tables are added up bucket by bucket in
    parallel. What reaches the driver is one table, a few megabytes for any corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(), np.zeros((BUCKETS, DIMENSIONS))
        block: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                block.append(tokens(text, buckets))
                held += len(block[-1])
                if held >= _BLOCK:
                    total += context_sums(block)
                    block, held = [], 0
        total += context_sums(block)
        found = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.record_batch([pa.array(found, pa.int32()), pa.array(list(total[found].astype(np.float32)), pa.list_(pa.float32()))], names=["bucket", "vector"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = np.asarray(batch.column(1).flatten()).reshape(-1, DIMENSIONS)
            for bucket, row in zip(batch.column(0).to_pylist(), rows):
                total[bucket] = total[bucket] + row if bucket in total else row.astype(float)
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["bucket", "vector"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, vector array<float>")
    table = parts.repartition("bucket").mapInArrow(add, "bucket int, vector array<double>").toArrow()
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    if table.num_rows:
        vectors[table.column("bucket").to_numpy()] = np.array(table.column("vector").to_pylist())
        # The common direction of all words says nothing about any.
        seen = np.abs(vectors).sum(axis=1) > 0
        vectors[seen] /= np.linalg.norm(vectors[seen], axis=1, keepdims=True) + 1e-12
        vectors[seen] -= vectors[seen].mean(axis=0)
        vectors[seen] /= np.linalg.norm(vectors[seen], axis=1, keepdims=True) + 1e-12
    return vectors.astype(np.float32)


def pooled(docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of each document's words; zeros without words."""
    out = np.zeros((len(docs), 2 * DIMENSIONS), np.float32)
    for i, ids in enumerate(docs):
        if len(ids):
            # By distinct words, weighted: fewer rows for repetitive texts, however long.
            distinct, n = np.unique(ids, return_counts=True)
            rows, share = vectors[distinct], (n / len(ids)).astype(np.float32)
            mean = share @ rows
            out[i, :DIMENSIONS] = mean
            out[i, DIMENSIONS:] = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
    return out


class Network:
    """Two layers: tanh units, then one logit, divided by the temperature."""

    def __init__(self, inputs: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.parts = [
            rng.normal(0, 1 / math.sqrt(inputs), (inputs, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1),
        ]
        self.temperature = 1.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.parts[0] + self.parts[1])
        return hidden, hidden @ self.parts[2] + self.parts[3][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale)[1]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
        """Trained on four rows in five, the temperature set on the fifth."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        check, learn = order[: len(x) // 5], order[len(x) // 5:]
        self.mean, self.scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
        z = (x - self.mean) / self.scale
        m, v = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        step = 0
        for _ in range(EPOCHS):
            rng.shuffle(learn)
            for at in range(0, len(learn), BATCH):
                rows = learn[at:at + BATCH]
                hidden, logit = self._forward(z[rows])
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
                back = np.outer(error, self.parts[2]) * (1 - hidden**2)
                gradients = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
                step += 1
                for i, g in enumerate(gradients):
                    g = g + 1e-4 * self.parts[i]
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.parts[i] -= 0.005 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        if len(check):
            logit, sign = self.logits(x[check]), 2 * y[check] - 1
            choices = np.exp(np.linspace(math.log(0.25), math.log(8), 61))
            losses = [np.logaddexp(0, -sign * logit / t).mean() for t in choices]
            self.temperature = float(choices[int(np.argmin(losses))])
        return self


def held_out() -> Column:
    """Rows labels are not learned from; those without id among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 1, F.lit(True))


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier of quality) and predicted of every document.

    Word vectors cover every text of ``docs``. The network is trained on at most ``rows``
    rows of ``labels``, never on held-out ones; a document with several labels counts as
    good if one says so. Only the text enters the score. Null and empty texts are a
    document without words (all zeros) and get the score of that; where no label, or only
    one kind of label, can be used, every score is the share of good labels (0.5 without
    any). Rows that repeat are scored each, of rows that share a labelled id one is learned
    from; a row without id counts as held out. An empty table gives an empty result; other
    columns are not read. The same rows give the same scores however they are partitioned.
    """
    vectors = word_vectors(docs)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            x = pooled([tokens(t, buckets) for t in batch.column(2).to_pylist()], vectors)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "held_out", "x"])

    read = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    table = stored(read.mapInArrow(features, "doc_id long, held_out boolean, x array<float>"), "pooled")
    chosen = (
        labels.filter(~held_out() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # At most ``rows`` labels are broadcast, and as many short vectors fetched, in an order that
    # no partitioning changes: of rows that share an id the smallest vector counts.
    sample = (
        table.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("x").alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("x", "label").toArrow()
    )
    y = np.array(sample.column("label").to_pylist(), float)
    share = float((y != 0).mean()) if len(y) else 0.5
    network = None
    if len(y) and 0 < share < 1:
        network = Network(2 * DIMENSIONS).fit(np.array(sample.column("x").to_pylist(), float), (y != 0).astype(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(2).flatten(), float).reshape(-1, 2 * DIMENSIONS)
            p = network.probabilities(x) if network else np.full(len(x), share)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p, pa.float64())], names=["doc_id", "held_out", "score"])

    return table.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

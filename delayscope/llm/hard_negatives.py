"""Hard-negative mining with rotated one-bit codes and deterministic score intervals.

A vector v is coded in a few levels. A level rotates what is left of it by a fixed random
rotation, keeps the signs as a code c (a unit vector of equal parts) and the alignment
a = <v, c>, and passes v - a c on. So v = a1 c1 + ... + r, and for an anchor w

    <v, w> = a1 <c1, w> + a2 <c2, w> + ... + <r, w>.

Each <c, w> comes from popcounts of the code against the bit planes of the rotated anchor,
rounded to a few bits; the rounding error is at most a times its length, and the last term
at most |r| |w|, both by Cauchy-Schwarz. That gives an interval which holds the score for
certain. Rows whose interval cannot matter are dropped, the others are scored in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayscope.llm.common import stored
from delayscope.llm.vectors import sound

#: Levels of a code. Each leaves about six tenths of the length that the one before left.
LEVELS = 5
#: Bits to which a component of a rotated anchor is rounded.
PLANES = 5
#: Anchors searched in one pass over all rows: bounds what is sent to the tasks.
ANCHOR_BLOCK = 16_384
#: Rows and anchors compared at a time: keeps the working set in the processor's cache.
_ROWS, _ANCHORS = 1024, 128
_LONG = np.iinfo(np.int64)


class Coder:
    """The rotations, and codes and anchors under them."""

    def __init__(self, d: int, levels: int = LEVELS, seed: int = 1):
        self.d, self.size, self.levels = d, -(-d // 64) * 64, levels
        random = np.random.default_rng(seed)
        self.rotations = [np.linalg.qr(random.standard_normal((self.size, self.size)))[0] for _ in range(levels)]

    def _padded(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((len(v), self.size))
        out[:, : self.d] = v
        return out

    def codes(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes (rows, levels, words), alignments (rows, levels), lengths of what is left)."""
        left = self._padded(v)
        words, alignments = [], []
        for rotation in self.rotations:
            turned = left @ rotation
            signs = turned >= 0
            code = np.where(signs, 1.0, -1.0) / np.sqrt(self.size)
            alignment = (turned * code).sum(axis=1)
            left = left - alignment[:, None] * (code @ rotation.T)
            words.append(np.packbits(signs, axis=1, bitorder="little").view(np.uint64))
            alignments.append(alignment)
        return np.stack(words, axis=1), np.stack(alignments, axis=1), np.sqrt((left * left).sum(axis=1))


class Anchors:
    """Anchors rounded to bit planes under every rotation."""

    def __init__(self, coder: Coder, w: np.ndarray, planes: int = PLANES):
        self.coder = coder
        w = coder._padded(w)
        self.length = np.sqrt((w * w).sum(axis=1))
        self.levels = []
        for rotation in coder.rotations:
            turned = w @ rotation
            low = turned.min(axis=1)
            step = np.maximum((turned.max(axis=1) - low) / (2**planes - 1), 1e-300)
            k = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            rounded = low[:, None] + step[:, None] * k
            bits = [np.packbits((k >> j & 1).astype(bool), axis=1, bitorder="little").view(np.uint64) for j in range(planes)]
            error = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
            self.levels.append((bits, low, step, rounded.sum(axis=1), error))

    def intervals(self, codes, alignments, left, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score (rows, anchors) of coded rows with some of the anchors."""
        estimate = np.zeros((len(codes), len(self.length[at])))
        width = left[:, None] * self.length[None, at]
        scale = 1 / np.sqrt(self.coder.size)
        for level, (bits, low, step, total, error) in enumerate(self.levels):
            code = codes[:, level]
            met = np.zeros(estimate.shape, np.int32)
            for j, plane in enumerate(bits):
                for word in range(code.shape[1]):
                    met += np.bitwise_count(code[:, word, None] & plane[None, at, word]).astype(np.int32) << j
            ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
            inner = 2 * (ones[:, None] * low[None, at] + step[None, at] * met) - total[None, at]
            estimate += alignments[:, level, None] * scale * inner
            width += alignments[:, level, None] * error[None, at]
        # What rounding of the sums themselves can add.
        whole = np.sqrt((alignments * alignments).sum(axis=1) + left * left)
        width += 1e-9 * (1 + whole[:, None] * self.length[None, at])
        return estimate - width, estimate + width


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products row by row, held at the ends of a long."""
    if not len(x):
        return np.empty(0, np.int64)
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if bound < 2.0**62:
        return np.einsum("ij,ij->i", x, y)
    return np.array([min(max(sum(map(int.__mul__, a, b)), _LONG.min), _LONG.max) for a, b in zip(x.tolist(), y.tolist())], np.int64)


CODED = "vec_id long, label long, x array<long>, codes binary, alignments array<double>, rest double"


def coded(rows: DataFrame, coder: Coder) -> DataFrame:
    """Rows (vec_id, label, x) with their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, coder.d)
            codes, alignments, left = coder.codes(x.astype(np.float64))
            yield pa.record_batch([
                *batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(list(alignments), pa.list_(pa.float64())), pa.array(left),
            ], names=["vec_id", "label", "x", "codes", "alignments", "rest"])

    return rows.mapInArrow(run, CODED)


class Block(NamedTuple):
    """Coded rows of a batch as arrays."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    codes: np.ndarray
    alignments: np.ndarray
    rest: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], coder: Coder) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            few = batch.slice(at, _ROWS)
            n = few.num_rows
            yield Block(
                few.column(0).to_numpy(), few.column(1).to_numpy(),
                few.column(2).flatten().to_numpy().reshape(n, coder.d),
                np.frombuffer(b"".join(few.column(3).to_pylist()), np.uint64).reshape(n, coder.levels, -1),
                few.column(4).flatten().to_numpy().reshape(n, coder.levels), few.column(5).to_numpy(),
            )


class Best:
    """The best k (score, id) of each of several searches so far."""

    def __init__(self, searches: int, k: int):
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(searches)]
        #: Scores below this are beaten already.
        self.least = np.full(searches, -np.inf)

    def add(self, search: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(search):
            return
        order = np.lexsort((ids, -scores, search))
        search, scores, ids = search[order], scores[order], ids[order]
        heads = np.flatnonzero(np.concatenate([[True], search[1:] != search[:-1]]))
        place = np.arange(len(search)) - np.repeat(heads, np.diff(np.append(heads, len(search))))
        top = place < self.k
        changed = set()
        for s, score, i in zip(search[top].tolist(), scores[top].tolist(), ids[top].tolist()):
            self.found[s].append((score, i))
            changed.add(s)
        for s in changed:
            self.found[s] = sorted(self.found[s], key=lambda e: (-e[0], e[1]))[: self.k]
            if len(self.found[s]) == self.k:
                self.least[s] = self.found[s][-1][0]

    def rows(self) -> tuple[list[int], list[int], list[int]]:
        flat = [(s, score, i) for s, found in enumerate(self.found) for score, i in found]
        return [r[0] for r in flat], [r[1] for r in flat], [r[2] for r in flat]


def _kth(values: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Per column the k-th largest allowed value, or minus infinity."""
    if len(values) < k:
        return np.full(values.shape[1], -np.inf)
    return np.partition(np.where(allowed, values, -np.inf), len(values) - k, axis=0)[len(values) - k]


def _search(coded_rows: DataFrame, coder: Coder, searches: dict, kind: str, k: int) -> DataFrame:
    """(search, score, vec_id): per task, the best k rows of each search.

    A search has an anchor (id, label, vector), and for negatives a band of scores.
    Positives are other rows of the anchor's label, negatives rows of another label.
    """
    first, names = searches["anchor_of"], ["search", "score", "vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, x = searches["ids"], searches["labels"], searches["x"]
        low, high = searches["low"], searches["high"]
        anchors = Anchors(coder, x.astype(np.float64))
        best = Best(len(first), k)
        starts = np.searchsorted(first, np.arange(len(ids) + 1))
        for block in _blocks(batches, coder):
            for at in range(0, len(ids), _ANCHORS):
                here = slice(at, min(at + _ANCHORS, len(ids)))
                least, most = anchors.intervals(block.codes, block.alignments, block.rest, here)
                same = block.labels[:, None] == labels[None, here]
                allowed = same & (block.ids[:, None] != ids[None, here]) if kind == "positive" else ~same
                # Searches of these anchors, a few of them per anchor.
                wanted = np.arange(starts[here.start], starts[here.stop])
                column = first[wanted] - here.start
                keep = np.zeros(allowed.shape, bool)
                tests = []
                for turn in range(np.bincount(column, minlength=1).max()):
                    own = wanted[np.flatnonzero(wanted - starts[first[wanted]] == turn)]
                    cols = first[own] - here.start
                    lo, hi, ok = least[:, cols], most[:, cols], allowed[:, cols]
                    bar = np.maximum(best.least[own], low[own])
                    if np.isneginf(best.least[own]).any():
                        bar = np.maximum(bar, _kth(lo, ok & (lo >= low[own]) & (hi <= high[own]), k))
                    test = ok & (hi >= bar) & (lo <= high[own])
                    keep[:, cols] |= test
                    tests.append((own, cols, test))
                r, c = np.nonzero(keep)
                scores = np.zeros(keep.shape, np.int64)
                for part in range(0, len(r), 1 << 16):
                    i, j = r[part : part + (1 << 16)], c[part : part + (1 << 16)]
                    scores[i, j] = exact_scores(block.x[i], x[here.start + j])
                for own, cols, test in tests:
                    i, j = np.nonzero(test)
                    s = scores[i, cols[j]]
                    fits = (s >= low[own[j]]) & (s <= high[own[j]])
                    best.add(own[j][fits], s[fits], block.ids[i[fits]])
        s, scores, found = best.rows()
        yield pa.record_batch([pa.array(s, pa.int64()), pa.array(scores, pa.int64()), pa.array(found, pa.int64())], names=names)

    found = coded_rows.mapInArrow(run, "search long, score long, vec_id long")
    order = Window.partitionBy("search").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, *, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
                   anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """The hardest negatives of each anchor and each of its nearest positives.

    Components become floor(scale * c); a score is the integer inner product with the
    anchor, higher first, ties by smaller id. An anchor's positives are its first rows of
    the same label, itself left out; the negatives of a positive are the first rows of
    other labels with low_percent <= 100 * negative / positive <= high_percent (written
    without division, so that a score of zero or less finds what the inequality says).
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Every row is searched for every anchor, in blocks of ``anchor_block`` anchors: a block
    and its bounds go to the tasks, each of which returns its best few per search, and a
    ranking over these few gives the result. No row is left out by chance: an interval
    that holds the score decides what need not be scored.

    Rows with a null id, label or vector, or with a component that is null or not finite,
    take no part, nor do vectors of another than the most common length. Rows that repeat
    an id count once, with the smallest (label, vector). Components are held within
    62 bits, scores at the ends of a long. An empty table gives an empty result; other columns are not
    read, whatever they are called.
    """
    spark = vectors.sparkSession
    slim = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    limit = float(2**62)
    whole = F.transform("vector", lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-limit)), F.lit(limit))).cast("long"))
    clean = stored(sound(slim, "vector").select("vec_id", "label", whole.alias("x"), "is_anchor"), "vectors")
    # Only ids move to find repeated ones.
    repeated = stored(clean.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"), "repeated-ids")
    if not repeated.isEmpty():
        one = clean.join(repeated, "vec_id").groupBy("vec_id").agg(F.min(F.struct("label", "x", "is_anchor")).alias("r")).select("vec_id", "r.*")
        clean = stored(clean.join(repeated, "vec_id", "left_anti").unionByName(one), "single-vectors")
    head = clean.select(F.size("x").alias("d")).first()
    if head is None:
        return spark.createDataFrame([], MINED)
    coder = Coder(head["d"])
    rows = stored(coded(clean.select("vec_id", "label", "x"), coder), "coded-vectors")
    chosen = stored(clean.filter("is_anchor").select("vec_id", "label", "x"), "anchors")
    blocks = -(-chosen.count() // anchor_block)
    results = []
    for b in range(blocks):
        part = chosen.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        n = part.num_rows
        if not n:
            continue
        ids, x = part.column("vec_id").to_numpy(), np.concatenate([c.flatten().to_numpy() for c in part.column("x").chunks]).reshape(n, coder.d)
        anchors = {"ids": ids, "labels": part.column("label").to_numpy(), "x": x}
        every = {**anchors, "anchor_of": np.arange(n), "low": np.full(n, -np.inf), "high": np.full(n, np.inf)}
        near = _search(rows, coder, every, "positive", positives).orderBy("search", "rank").toArrow()
        if not near.num_rows:
            continue
        owner, score = near.column("search").to_numpy(), near.column("score").to_numpy()
        # Whole numbers, as a score times a percentage can pass a long.
        low = np.array([-(-low_percent * s // 100) for s in score.tolist()], float)
        high = np.array([high_percent * s // 100 for s in score.tolist()], float)
        banded = {**anchors, "anchor_of": owner, "low": low, "high": high}
        hard = _search(rows, coder, banded, "negative", negatives)
        pairs = spark.createDataFrame(pa.table({
            "search": pa.array(np.arange(len(owner))), "anchor_id": pa.array(ids[owner]), "positive_id": near.column("vec_id"), "positive_score": near.column("score"),
        }))
        results.append(stored(
            hard.join(pairs, "search").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")),
            "hard-negatives",
        ))
    if not results:
        return spark.createDataFrame([], MINED)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out

"""Repeated substrings, removed byte by byte: suffixes grouped at the threshold of their factors.

A byte goes when a string of 400 bytes that covers it starts somewhere else too. Suffixes
that agree in their first 400 bytes stand together in suffix order; among them a position
with a smaller one in its run has an earlier match (its longest previous factor has 400
bytes or more), one with a larger one a later match. Only that threshold is asked for, so
no suffix array and no factor lengths are built: suffixes are grouped by a 128-bit
fingerprint of their first 400 bytes, and positions are compared within groups.

Of all suffixes only those can have a match whose anchor, the 128-byte string of smallest
hash within their 400 bytes, occurs twice; equal strings have equal anchors. Anchors change
about once in 140 bytes, so that they are counted instead of positions, and suffixes meet
by anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.llm import bloom
from delayscope.llm.common import discard, stored, text_of
from delayscope.llm.shingles import mix

LENGTH = 400
ANCHOR = 128
_REACH = LENGTH - ANCHOR + 1
#: Starts looked at together; longer texts are taken in pieces that overlap.
_PIECE = 1 << 16
#: Anchors in more places than this take the way of counting every suffix by itself.
HOT_PLACES = 1024
#: Bytes of suffix contexts that are sorted together: they take about a hundred times that.
_CHUNK = 256 << 10
#: Rows with whole texts that are unpacked together.
_ROWS = 64

# Odd bases of two polynomial fingerprints modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, from the zeroth."""
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        factors = np.full(n + 1, factor, np.uint64)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


class Fingerprints:
    """Fingerprints of all windows of a byte array, in a few passes over it."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, *_powers(base, 1 << 12)

    def of(self, data: np.ndarray, width: int) -> np.ndarray:
        n = len(data)
        if n > len(self.up):
            self.up, self.down = _powers(self.base, n + n // 4)
        # Zero bytes count too: every byte is raised by one.
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return (sums[width:] - sums[:-width]) * self.down[:n - width + 1]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima within blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    square = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(square, axis=1).ravel()
    return np.minimum(ahead[:n - width + 1], behind[width - 1:n])


def anchor_runs(data: np.ndarray, prints: Fingerprints) -> tuple[np.ndarray, ...]:
    """(anchor, first start, number of starts, twice) of the runs of suffixes with one anchor.

    ``twice`` says that the anchor stands in more than one place within the run, as it does
    where text repeats with a short period.
    """
    anchors, starts, lengths, twice = [], [], [], []
    last = len(data) - LENGTH + 1
    for at in range(0, max(last, 0), _PIECE):
        piece = data[at:min(at + _PIECE, last) + LENGTH - 1]
        hashes = mix(prints.of(piece, ANCHOR))
        lowest = sliding_minimum(hashes, _REACH)
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(lowest[1:] != lowest[:-1]) + 1, np.arange(0, len(lowest), 2 * _REACH)]))
        anchors.append(lowest[cuts])
        starts.append(cuts + at)
        lengths.append(np.diff(np.append(cuts, len(lowest))))
        reach = np.lib.stride_tricks.sliding_window_view(hashes, _REACH)
        ends = cuts + lengths[-1] - 1
        twice.append(cuts + reach[cuts].argmin(axis=1) != ends + _REACH - 1 - reach[ends][:, ::-1].argmin(axis=1))
    if not anchors:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(map(np.concatenate, (anchors, starts, lengths, twice)))


def window_prints(contexts: list[bytes], prints: tuple[Fingerprints, Fingerprints]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both fingerprints of every suffix of the contexts, and the suffixes per context."""
    lengths = np.array([len(c) for c in contexts])
    counts = lengths - LENGTH + 1
    data = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum(lengths) - lengths
    at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return prints[0].of(data, LENGTH)[at], prints[1].of(data, LENGTH)[at], counts


def matches(first: np.ndarray, second: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix: whether an equal one has a smaller position, a larger position."""
    order = np.argsort(first, kind="stable")
    a, b, p = first[order], second[order], position[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    starts = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    earlier, later = np.empty(len(p), bool), np.empty(len(p), bool)
    earlier[order] = p > np.minimum.reduceat(p, starts)[run]
    later[order] = p < np.maximum.reduceat(p, starts)[run]
    return earlier, later


def flagged_runs(flags: np.ndarray, context: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first start, last start) of the runs of neighbouring flagged suffixes."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    c, s = context[at], start[at]
    new = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1] + 1)])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    return c[heads], s[heads], s[tails]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the batches, unpacked a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            few = batch.slice(at, _ROWS)
            yield from zip(*(few.column(i).to_pylist() for i in range(few.num_columns)))


SPANS = "text_id long, start long, stop long"


def _spans(batch_ids, first, last) -> pa.RecordBatch:
    return pa.record_batch([
        pa.array(batch_ids, pa.int64()), pa.array(first, pa.int64()), pa.array(np.asarray(last) + LENGTH, pa.int64()),
    ], names=["text_id", "start", "stop"])


def _runs_of(texts: DataFrame) -> DataFrame:
    """(anchor, text_id, start, n, twice) of every text of (text_id, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(_BASES[0])
        for batch in batches:
            for text_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                anchor, start, n, twice = anchor_runs(np.frombuffer(body.as_buffer(), np.uint8), prints)
                yield pa.record_batch([
                    pa.array(anchor.view(np.int64)), pa.array(np.full(len(anchor), text_id, np.int64)), pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array(twice),
                ], names=["anchor", "text_id", "start", "n", "twice"])

    return texts.mapInArrow(run, "anchor long, text_id long, start long, n int, twice boolean")


def _contexts_of(texts: DataFrame) -> DataFrame:
    """(anchor, hot, text_id, doc_id, start, context) from (text_id, doc_id, body, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text_id, doc, body, runs in _slices(batches):
            yield pa.record_batch([
                pa.array([r["anchor"] for r in runs], pa.int64()), pa.array([r["hot"] for r in runs], pa.bool_()),
                pa.array([text_id] * len(runs), pa.int64()), pa.array([doc] * len(runs), pa.int64()),
                pa.array([r["start"] for r in runs], pa.int64()),
                pa.array([body[r["start"]:r["start"] + r["n"] + LENGTH - 1] for r in runs], pa.binary()),
            ], names=["anchor", "hot", "text_id", "doc_id", "start", "context"])

    return texts.mapInArrow(run, "anchor long, hot boolean, text_id long, doc_id long, start long, context binary")


def _ranks(docs: list, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions as numbers in the order (document, start); documents without id come last."""
    document = np.array([(1 << 63) - 1 if d is None else d for d in docs], np.int64)
    rank = np.empty(len(starts), np.int64)
    rank[np.lexsort((starts, document[owner]))] = np.arange(len(starts))
    return rank


def _matched_together(contexts: DataFrame, first_stays: bool) -> DataFrame:
    """Spans of the suffixes with a match, anchor by anchor, many anchors at a time."""

    def solve(rows: list[tuple], prints) -> pa.RecordBatch:
        h1, h2, counts = window_prints([r[4] for r in rows], prints)
        owner = np.repeat(np.arange(len(rows)), counts)
        start = np.repeat(np.array([r[3] for r in rows]), counts) + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        earlier, later = matches(h1, h2, _ranks([r[2] for r in rows], start, owner))
        which, head, tail = flagged_runs(earlier if first_stays else earlier | later, owner, start)
        return _spans([rows[k][1] for k in which.tolist()], head, tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = tuple(Fingerprints(b) for b in _BASES)
        rows: list[tuple] = []
        held = 0
        for row in _slices(batches):
            if held >= _CHUNK and row[0] != rows[-1][0]:
                yield solve(rows, prints)
                rows, held = [], 0
            rows.append(row)
            held += len(row[4])
        if rows:
            yield solve(rows, prints)

    dealt = contexts.select("anchor", "text_id", "doc_id", "start", "context").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, SPANS)


def _matched_singly(contexts: DataFrame, first_stays: bool) -> tuple[DataFrame, ...]:
    """The same for anchors in very many places, whose suffixes no task could hold; then the stored tables it reads.

    Whole contexts are counted first: inside a passage that many documents share nearly all
    are alike, and one stands for the rest. Only the suffixes of distinct contexts are then
    counted one by one, by fingerprint.
    """
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_id", "start")
    known = stored(contexts.withColumn("mark", F.sha2("context", 256)), "hot-contexts")
    groups = stored(known.groupBy("mark").agg(F.min(place).alias("first"), F.max(place).alias("last")), "hot-groups")
    same = known.join(groups, "mark").withColumn("place", place)
    repeated = (F.col("place") != F.col("first")) if first_stays else (F.col("first") != F.col("last"))
    whole = same.filter(repeated).select("text_id", "start", (F.col("start") + F.octet_length("context")).alias("stop"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = tuple(Fingerprints(b) for b in _BASES)
        for text_id, doc, start, context in _slices(batches):
            h1, h2, counts = window_prints([context], prints)
            n = int(counts[0])
            yield pa.record_batch([
                pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array([text_id] * n, pa.int64()),
                pa.array([doc] * n, pa.int64()), pa.array(np.arange(start, start + n), pa.int64()),
            ], names=["h1", "h2", "text_id", "doc_id", "start"])

    one = same.filter("place = first").select("text_id", "doc_id", "start", "context")
    suffixes = stored(one.mapInArrow(spread, "h1 long, h2 long, text_id long, doc_id long, start long"), "hot-suffixes")
    runs = stored(suffixes.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last"), "hot-runs")
    back = suffixes.join(runs, ["h1", "h2"])
    if first_stays:
        back = back.filter(place != F.col("first"))
    return whole.unionByName(back.select("text_id", "start", (F.col("start") + LENGTH).alias("stop"))), known, groups, suffixes, runs


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def cut(body: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text, and how many maximal runs went."""
    left, runs, at = [], 0, 0
    for start, stop in sorted(spans):
        if start > at or not runs:
            left.append(body[at:start])
            runs += 1
        at = max(at, stop)
    left.append(body[at:])
    return b"".join(left), runs


def repeated_bytes(docs: DataFrame, keep: str = "none", with_bytes: bool = False) -> DataFrame:
    """Per document what goes: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (and kept_bytes).

    ``keep="none"`` removes every byte that a string of 400 bytes covers which also starts
    elsewhere, in the same document or another, at overlapping places too; ``keep="first"``
    only where such a string starts earlier, by (doc_id, start), so that first copies stay.
    Strings are judged on the input, as UTF-8 bytes; none reaches across documents.

    Texts that occur more than once are decided by their digest and enter the search once.
    Null text is empty; texts under 400 bytes lose nothing. A null doc_id comes last in
    order. Rows that repeat entirely are copies of each other (with ``keep="first"``, of
    equal rows all with the smallest id count as first). An empty table gives an empty
    result; other columns are not read.
    """
    first_stays = keep == "first"
    body = text_of().cast("binary")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body")).withColumn("sha256", F.sha2("body", 256))
    source = source.withColumn("text_id", F.xxhash64("sha256"))
    slim = stored(source.select("doc_id", "text_id", "sha256", F.octet_length("body").cast("long").alias("n_bytes")), "texts")
    copies = stored(slim.groupBy("sha256").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "copies")
    texts, slim = slim, stored(slim.join(copies, "sha256"), "texts-with-copies")
    discard(texts)
    if not with_bytes:
        discard(copies)

    runs = stored(_runs_of(source.filter(F.octet_length("body") >= LENGTH).select("text_id", "body")), "anchor-runs")
    where = F.xxhash64("text_id", "start")
    anchors = stored(
        runs.groupBy("anchor").agg(F.min(where).alias("a"), F.max(where).alias("b"), F.count(F.lit(1)).alias("places"), F.max("twice").alias("twice"))
        .filter("a <> b OR twice").select("anchor", (F.col("places") > HOT_PLACES).alias("hot")), "repeated-anchors",
    )
    by_text = stored(
        runs.join(anchors, "anchor").groupBy("text_id").agg(F.collect_set(F.struct("anchor", "hot", "start", "n")).alias("runs")),
        "runs-by-text",
    )
    firsts = slim.groupBy("text_id").agg(F.min("doc_id").alias("first_id"))
    discard(runs, anchors)
    by_text, grouped = stored(by_text.join(firsts, "text_id"), "runs-of-first"), by_text
    discard(grouped)
    near = bloom.maybe_among(source.select("text_id", "doc_id", "body"), "text_id", by_text)
    texts = near.join(by_text, (near["text_id"] == by_text["text_id"]) & near["doc_id"].eqNullSafe(by_text["first_id"]))
    contexts = stored(_contexts_of(texts.select(near["text_id"], "doc_id", "body", "runs")), "contexts")
    discard(by_text)
    single, *hot = _matched_singly(contexts.filter("hot"), first_stays)
    spans = _matched_together(contexts.filter("NOT hot"), first_stays).unionByName(single)
    spans = stored(spans.groupBy("text_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    discard(contexts, *hot)

    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    if first_stays:
        copied = copied & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    placed = slim.join(spans.select("text_id", F.lit(True).alias("some")), "text_id", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    gone = placed.filter(copied).select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(nothing).alias("kept_sha256"),
        F.lit(b"").alias("kept_bytes"),
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes")
        for doc, data, found in _slices(batches):
            kept, n_runs = cut(data, [(s["start"], s["stop"]) for s in found])
            row = (doc, len(data), len(data) - len(kept), n_runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else b"")
            yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=list(names))

    # The spans meet the ids first, so that the texts themselves move once.
    partly = placed.filter(~copied & F.col("some")).select("doc_id", "text_id").distinct()
    partly = stored(partly.join(spans, "text_id"), "partly")
    chosen = bloom.maybe_among(source.select("text_id", "doc_id", "body"), "text_id", partly)
    ids = partly.select("text_id", F.col("doc_id").alias("cut_id"), "spans")
    changed = chosen.join(ids, "text_id").filter(F.col("doc_id").eqNullSafe(F.col("cut_id"))).select("doc_id", "body", "spans").mapInArrow(apply, RESULT)
    if with_bytes:
        same = source.withColumn("n_bytes", F.octet_length("body").cast("long")).join(spans, "text_id", "left_anti")
        same = same.join(copies, "sha256").filter(~copied)
    else:
        same = placed.filter(~copied & F.col("some").isNull()).withColumn("body", F.lit(b""))
    same = same.select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"), F.col("body").alias("kept_bytes"))
    result = gone.unionByName(changed).unionByName(same).withColumn("removed", F.col("n_removed") > 0)
    return result if with_bytes else result.drop("kept_bytes")

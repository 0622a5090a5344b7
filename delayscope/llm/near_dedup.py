"""Near-duplicate documents: SetSketch registers, bands, likelihood estimate, exact check.

The sketch of a set has m registers; register i is the largest of 1 - log_b(h_i(x)) over
the elements, h_i(x) exponential with rate a, rounded down and truncated to 16 bits: minima
on an exponential scale. Sketches merge by the register-wise maximum, and with b near 1
registers of two sets agree about as often as their Jaccard similarity says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from delayscope.llm import bloom
from delayscope.llm.common import discard, few_rows, stored, unused
from delayscope.llm.linking import candidate_pairs, link, shared_buckets
from delayscope.llm.shingles import WORDS, WordHashes, mix, shingle_set, words_of

#: Lowest bits of registers that make a mark, 64 to a word, and in how many similar sets may differ.
MARK_WORDS, MARK_DIFFERENCES = 3, 50

BASE, RATE, TOP = 1.001, 20.0, 65535
#: 40 bands of five registers: at similarity 0.75 a pair shares no band once in 5e4.
ROWS, BANDS = 5, 40
REGISTERS = ROWS * BANDS
PERCENT = 75
#: Pairs whose estimate is this far below the threshold are not checked: over eight
#: standard deviations of an estimate from 200 registers.
MARGIN = 0.25

_seeds = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
_MULTIPLY, _ADD = _seeds[:REGISTERS] | np.uint64(1), _seeds[REGISTERS:]


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (one row per set) of non-empty sets of element hashes."""
    if not sets:
        return np.empty((0, REGISTERS), np.uint16)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    elements = np.concatenate(sets)
    lowest = np.empty((REGISTERS, len(sets)), np.uint64)
    for i in range(REGISTERS):
        lowest[i] = np.minimum.reduceat(elements * _MULTIPLY[i] + _ADD[i], starts)
    uniform = (lowest.T.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    levels = np.floor(1 - np.log(exponential) / np.log(BASE))
    return np.clip(levels, 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, grid: int = 201) -> np.ndarray:
    """Most likely Jaccard similarity of each pair of sketches, given the set sizes.

    The numbers of registers where the first is larger, smaller or equal are multinomial;
    their chances follow from the sizes and the similarity. Maximum over a grid.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, grid)[None, :] * np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = chance(u - v * j), chance(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = [np.where(n > 0, n * np.log(np.maximum(x, 1e-300)), 0.0) for n, x in ((more, p), (less, q), (same, 1 - p - q))]
    best = np.argmax(sum(terms), axis=1)
    return j[np.arange(len(best)), best]


SKETCHED = "doc_id long, row_key long, n_shingles long, s1 long, s2 long, registers binary"
#: Shingles sketched at a time: keeps the working set in the processor's cache.
_BLOCK = 60_000


def sketches(docs: DataFrame) -> DataFrame:
    """Per document: id, a hash of its text, size of its shingle set, two order-free digests
    of the set, registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in few_rows(batches):
            sets = [shingle_set(words_of(t), hashes) for t in batch.column(2).to_pylist()]
            registers: list[bytes | None] = [None] * len(sets)
            block: list[int] = []
            held = 0
            for i, s in enumerate(sets):
                if len(s):
                    block.append(i)
                    held += len(s)
                if block and (held >= _BLOCK or i == len(sets) - 1):
                    for k, row in zip(block, sketch([sets[k] for k in block])):
                        # The registers, then their lowest bits.
                        registers[k] = row.tobytes() + np.packbits(row & 1).tobytes()
                    block, held = [], 0
            yield pa.record_batch([
                batch.column(0), batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                pa.array(np.array([mix(s ^ _ADD[0]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                pa.array(registers, pa.binary()),
            ], names=["doc_id", "row_key", "n_shingles", "s1", "s2", "registers"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("row_key"), text.alias("text")).mapInArrow(run, SKETCHED)


def shingle_table(docs: DataFrame) -> DataFrame:
    """(id, elements): the whole shingle set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in few_rows(batches):
            sets = [shingle_set(words_of(t), hashes).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "elements"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "id long, elements array<long>")


@F.pandas_udf(DoubleType())
def _estimated(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    left, right = (np.frombuffer(b"".join(x[:2 * REGISTERS] for x in s), np.uint16).reshape(len(s), REGISTERS) for s in (a, b))
    return pd.Series(estimate(left, right, n_a.to_numpy(float), n_b.to_numpy(float)))


def parities(registers: str) -> Column:
    """The lowest bits of the registers, 64 to a number."""
    words = [F.conv(F.hex(F.substring(registers, 16 * REGISTERS // 8 + 1 + 8 * i, 8)), 16, -10).cast("long") for i in range(MARK_WORDS)]
    return F.array(*words)


def possible(a: Column, b: Column) -> Column:
    """Whether two marks (size, parities) can belong to similar sets.

    Registers that differ agree in their lowest bit half the time. Similar sets differ in
    24 of 192 bits on average; over five standard deviations more are allowed.
    """
    differing = sum((F.bit_count(a["bits"][i].bitwiseXOR(b["bits"][i])) for i in range(MARK_WORDS)), F.lit(0))
    return (PERCENT * F.greatest(a["n"], b["n"]) <= 100 * F.least(a["n"], b["n"])) & (differing <= MARK_DIFFERENCES)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of every document (doc_id, text) under shingle-set similarity >= 0.75.

    Returns doc_id, n_shingles, component_id (smallest id reachable) and kept
    (doc_id = component_id). Sets are of distinct five-word shingles; documents with fewer
    words have their whole sequence as one, those without words none and no links. A set
    is identified by its hashes of 64 bits.

    Documents of equal sets are one node from the start, so a group of copies costs one
    comparison. Nodes meet in bands of equal registers; marks of their parities, then a
    joint likelihood over all registers drop clearly unlike pairs, and the rest is decided
    on the full sets. ``linking.link`` keeps the pairs in proportion to the rows of the bands.

    Null text is empty. Rows that share an id are one node: whatever links to one of them
    links to the other. Rows without id keep the component of their equals (null if none).
    An empty table gives an empty result; other columns are not read.
    """
    return _decided(docs).drop("row_key")


def _decided(docs: DataFrame) -> DataFrame:
    """The same with the hash of the text, which tells rows without id apart."""
    slim = stored(sketches(docs), "sketches")
    full = slim.filter("n_shingles > 0")
    same = ["n_shingles", "s1", "s2"]
    classes = stored(full.groupBy(*same).agg(F.min("doc_id").alias("node")), "classes")
    members = stored(full.join(classes, same).select("doc_id", "row_key", "node", "n_shingles", "registers"), "members")
    nodes = stored(members.filter("doc_id = node").select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "registers").dropDuplicates(["id", "n", "registers"]), "nodes")
    members = stored(members.select("doc_id", "row_key", "node", "n_shingles"), "slim-members")
    alone = stored(slim.filter("n_shingles = 0").select("doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id")), "without-words")
    discard(slim, classes)

    band = 2 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("registers", i * band + 1, band)) for i in range(BANDS)))
    mark = F.struct("n", parities("registers").alias("bits")).alias("mark")
    shared = shared_buckets(nodes.select(F.explode(keys).alias("key"), "id", mark))
    pairs, large = candidate_pairs(shared, possible)
    discard(shared)
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(large.select("id")).distinct(), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = bloom.maybe_among(texts, "id", wanted).join(wanted, "id", "left_semi")
    sets = stored(shingle_table(texts.select(F.col("id").alias("doc_id"), "text")), "sets")
    compact = stored(nodes.join(wanted, "id", "left_semi"), "compact-nodes")
    discard(nodes)

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in frame.columns if c != "id"))

    def verify(pairs: DataFrame) -> DataFrame:
        likely = stored(
            pairs.join(side(compact, "b"), "b").join(side(compact, "a"), "a")
            .filter(PERCENT * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))
            .filter(_estimated("registers_a", "registers_b", "n_a", "n_b") >= PERCENT / 100 - MARGIN)
            .select("a", "b"), "likely-pairs",
        )
        both = F.size(F.array_intersect("elements_a", "elements_b"))
        return (
            likely.join(side(sets, "b"), "b").join(side(sets, "a"), "a")
            .filter(100 * both >= PERCENT * (F.size("elements_a") + F.size("elements_b") - both))
            .select("a", "b").distinct()
        )

    def elements(ids: DataFrame) -> DataFrame:
        return sets.join(ids, "id").select("id", F.lit(0).alias("kind"), F.explode("elements").alias("element")).distinct()

    components = link(pairs, large, verify, elements, PERCENT, possible)
    named = components.select(F.col("id").alias("node"), "component")
    linked = members.join(named, "node", "left").select("doc_id", "row_key", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    result = stored(linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates")
    discard(members, alone, sets, compact, pairs, large, wanted)
    return result


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: of each component the row (or the rows) with its smallest id.

    Null and empty texts and texts without words are in no group and stay, as do rows
    without id that equal nothing; a row without id that has an equal with one goes. Rows
    that repeat stay or go together. An empty table stays empty; no column name clashes.
    """
    own, key = unused(docs.columns, "kept_id", "kept_key")
    kept = _decided(docs).filter("kept").select(F.col("doc_id").alias(own), F.col("row_key").alias(key)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(kept[own]) & (F.xxhash64(docs["text"].cast("string")) == kept[key])
    return docs.join(kept, same, "left_semi")

"""SimHash near-duplicates: fingerprints met through a vantage-point tree, pairs exact.

A fingerprint has 64 bits; two documents are linked when theirs differ in at most two. A
vantage-point tree partitions the distinct fingerprints by Hamming distance: a node has a
point and a radius, fingerprints within the radius go inside, the others outside. By the
triangle inequality the distances of two linked fingerprints from the point differ by at
most two, so that of a linked pair which a node separates, the inner one lies within two of
the boundary. Such fingerprints also visit the outer shard. So every linked pair meets in
some shard, and a branch further away is never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.llm.common import stored
from delayscope.llm.linking import connected_components
from delayscope.llm.shingles import words_of

WORDS = 3
BITS = 64
#: Linked fingerprints differ in so many bits at most.
DIFFERING = 2
#: The seed of the shingle hashes, as the contract fixes it.
SEED = 42
#: Fingerprints the first tree is fitted on, a sample by hash: bounds what the driver holds.
SAMPLE_ROWS = 1 << 15
#: Rows that a shard may have to be searched by one task.
SHARD_ROWS = 2048
#: A split is worth it when the larger side has less than this part of the node's rows.
SHRINK = 0.85
#: Shingles hashed together: bounds the memory a very long text takes.
_BLOCK = 1 << 16


def fingerprint(text: str | None, n: int = WORDS) -> int:
    """The fingerprint of a text: bit by bit, what over half of its shingles' hashes have.

    Shingles are of n words joined by spaces, repeats included; fewer words are one shingle,
    no words give zero.
    """
    words = words_of(text)
    if not words:
        return 0
    width = min(n, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, f) of every document; f has the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "f"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, f long")


class Tree:
    """A vantage-point tree as arrays: of each node its point, radius and two children.

    A leaf has the radius -1; its number is the shard.
    """

    def __init__(self):
        self.point: list[int] = []
        self.radius: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []

    def add(self) -> int:
        for column in (self.point, self.radius, self.inner, self.outer):
            column.append(-1)
        self.point[-1] = 0
        return len(self.point) - 1

    def route(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) of all shards that fingerprints belong to or visit."""
        point, radius = np.array(self.point, np.uint64), np.array(self.radius, np.int64)
        inner, outer = np.array(self.inner), np.array(self.outer)
        row, node = np.arange(len(f)), np.zeros(len(f), np.int64)
        rows, shards = [], []
        while len(row):
            leaf = radius[node] < 0
            rows.append(row[leaf])
            shards.append(node[leaf])
            row, node = row[~leaf], node[~leaf]
            distance = np.bitwise_count(f[row] ^ point[node]).astype(np.int64)
            inside, far = distance <= radius[node], distance > radius[node] - DIFFERING
            row, node = np.concatenate([row[inside], row[far]]), np.concatenate([inner[node[inside]], outer[node[far]]])
        return np.concatenate(rows), np.concatenate(shards)


def best_radius(counts: np.ndarray) -> tuple[int, int]:
    """The radius of least pair work, and the rows of its larger side, from rows by distance."""
    total = np.cumsum(counts)
    inside = total
    outside = total[-1] - np.concatenate([np.zeros(DIFFERING, np.int64), total[:-DIFFERING]])
    cost = inside.astype(float) ** 2 + outside.astype(float) ** 2
    radius = int(np.argmin(cost))
    return radius, int(max(inside[radius], outside[radius]))


def fit(sample: np.ndarray, rows: int, shard_rows: int = SHARD_ROWS, tries: int = 4) -> Tree:
    """A tree for ``rows`` fingerprints of which ``sample`` (distinct, uint64) is a part.

    A node is split as long as it is expected to have more than half of ``shard_rows``
    rows, holds enough of the sample to tell, and the split shrinks it.
    """
    tree = Tree()
    share = rows / max(len(sample), 1)
    open_nodes = [(tree.add(), sample)]
    while open_nodes:
        node, part = open_nodes.pop()
        if len(part) * share <= shard_rows // 2 or len(part) < 32:
            continue
        options = []
        for p in part[:: max(1, len(part) // tries)][:tries].tolist():
            distance = np.bitwise_count(part ^ np.uint64(p)).astype(np.int64)
            radius, larger = best_radius(np.bincount(distance, minlength=BITS + 1))
            options.append((larger, p, radius, distance))
        larger, p, radius, distance = min(options, key=lambda o: o[:3])
        if larger >= SHRINK * len(part):
            continue
        tree.point[node], tree.radius[node] = p, radius
        tree.inner[node], tree.outer[node] = tree.add(), tree.add()
        open_nodes.append((tree.inner[node], part[distance <= radius]))
        open_nodes.append((tree.outer[node], part[distance > radius - DIFFERING]))
    return tree


def local_links(f: np.ndarray, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest one of its component) of the components inside a shard.

    All distinct fingerprints are compared, a block at a time; only those with some link
    are then walked, component by component.
    """
    f = np.unique(f)
    some = np.concatenate([
        (np.bitwise_count(f[i : i + block, None] ^ f[None, :]) <= DIFFERING).sum(axis=1) > 1 for i in range(0, len(f), block)
    ] or [np.empty(0, bool)])
    left = f[some]
    members, roots = [], []
    while len(left):
        first, reached = left[0], [left[:1]]
        left, at = left[1:], 0
        while at < len(reached):
            for x in reached[at]:
                near = np.bitwise_count(left ^ x) <= DIFFERING
                if near.any():
                    reached.append(left[near])
                    left = left[~near]
            at += 1
        found = np.concatenate(reached)[1:]
        members.append(found)
        roots.append(np.full(len(found), first))
    if not members:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(members), np.concatenate(roots)


def _searched(shards: DataFrame) -> DataFrame:
    """(a, b) of the links inside the shards, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(parts: list[np.ndarray]) -> pa.RecordBatch:
            a, b = local_links(np.concatenate(parts).view(np.uint64))
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        shard, parts = None, []
        for batch in batches:
            keys, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for part, key in zip(np.split(f, cuts), keys[np.concatenate([[0], cuts])].tolist() if len(keys) else ()):
                if key != shard and parts:
                    yield links(parts)
                    parts = []
                shard = key
                parts.append(part)
        if parts:
            yield links(parts)

    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a long, b long")


def _by_flips(members: DataFrame) -> DataFrame:
    """(a, b) of the links in shards that no point splits: dense clusters.

    Two fingerprints that differ in two bits at most have a common neighbour, equal to each
    or one flip away. All that share such a neighbour are linked with each other, so the
    smallest of them links them all; 65 keys a fingerprint, combined before they move.
    """
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("f").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    keyed = members.select("f").distinct().select("f", F.explode(F.concat(F.array("f"), flips)).alias("key"))
    least = stored(keyed.groupBy("key").agg(F.min("f").alias("b"), F.max("f").alias("most")).filter("b <> most").select("key", "b"), "flip-keys")
    return stored(keyed, "flips").join(least, "key").filter("f <> b").select(F.col("f").alias("a"), "b").distinct()


def _split(large: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(members of the shards after a further split, what could not be split).

    The point of each shard and its radius come from counts by distance.
    """
    points = stored(large.groupBy("shard").agg(F.min_by("f", F.xxhash64(F.lit(level), "f")).alias("point")), "vantage-points")
    apart = stored(large.join(points, "shard").withColumn("d", F.bit_count(F.col("f").bitwiseXOR(F.col("point")))), "distances")
    counts = apart.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("d") <= r).alias(f"in_{r}") for r in range(BITS)))
    options = F.array(*(
        F.struct(
            (F.pow(F.col(f"in_{r}").cast("double"), 2) + F.pow((F.col("n") - (F.col(f"in_{r - DIFFERING}") if r >= DIFFERING else 0)).cast("double"), 2)).alias("cost"),
            F.lit(r).alias("radius"),
            F.greatest(F.col(f"in_{r}"), F.col("n") - (F.col(f"in_{r - DIFFERING}") if r >= DIFFERING else 0)).alias("larger"),
        )
        for r in range(BITS)
    ))
    best = stored(counts.select("shard", "n", F.array_min(options).alias("best")).select("shard", F.col("best.radius").alias("radius"), (F.col("best.larger") < SHRINK * F.col("n")).alias("splits")), "radii")
    sided = stored(apart.join(best, "shard"), "sides")
    inside = sided.filter("splits AND d <= radius").select(F.xxhash64("shard", F.lit(2 * level)).alias("shard"), "f")
    outside = sided.filter(f"splits AND d > radius - {DIFFERING}").select(F.xxhash64("shard", F.lit(2 * level + 1)).alias("shard"), "f")
    return inside.unionByName(outside), sided.filter("NOT splits").select("shard", "f")


def links(distinct: DataFrame, shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints (column f) within two bits.

    The first tree is fitted on a sample of at most about ``sample_rows``, taken by hash.
    Shards that are larger than ``shard_rows`` are split on, with points of their own;
    those that no point splits are dense and are joined through common neighbours.
    """
    rows = distinct.count()
    part = max(1, -(-rows // sample_rows))
    sample = distinct.filter(F.pmod(F.xxhash64(F.lit(7), "f"), F.lit(part)) == 0).toArrow().column("f").to_numpy()
    tree = fit(np.sort(sample.view(np.uint64)), rows, shard_rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(0).to_numpy()
            row, shard = tree.route(f.view(np.uint64))
            yield pa.record_batch([pa.array(shard, pa.int64()), pa.array(f[row])], names=["shard", "f"])

    members = stored(distinct.select("f").mapInArrow(route, "shard long, f long"), "shards")
    found, level = [], 1
    while True:
        sizes = stored(members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows).select("shard"), "large-shards")
        if sizes.isEmpty():
            found.append(_searched(members))
            break
        found.append(_searched(members.join(sizes, "shard", "left_anti")))
        members, dense = _split(stored(members.join(sizes, "shard"), "to-split"), level)
        found.append(_by_flips(dense))
        members, level = stored(members, "split-shards"), level + 1
    all_links = found[0]
    for more in found[1:]:
        all_links = all_links.unionByName(more)
    return all_links


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document (doc_id, text).

    Returns doc_id, fingerprint (16 lower-case hex digits) and component_id, the smallest
    doc_id that links reach, its own included. Links join fingerprints that differ in two
    bits at most; equal ones are one node from the start, so a group of copies costs
    nothing however large.

    Null text is empty; texts without words have the fingerprint zero, linked like any
    other. Very long texts are hashed a block at a time. Rows that repeat or share an id
    are rows of their own; null ids reach the component of their links (null if nothing
    else is there). An empty table gives an empty result; other columns are not read.
    """
    slim = stored(fingerprints(docs), "fingerprints")
    classes = stored(slim.groupBy("f").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    linked = connected_components(links(classes.select("f"))).withColumnRenamed("id", "f")
    placed = stored(classes.join(linked, "f", "left").select("f", F.coalesce("component", "f").alias("root"), "first"), "placed-fingerprints")
    smallest = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "smallest-ids")
    named = stored(placed.join(smallest, "root").select("f", "component_id"), "named-fingerprints")
    return slim.join(named, "f").select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")


def drop_simhash_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: of each component the row or rows
    with its smallest id; rows without id go where their component has an id, else stay."""
    found = simhash_duplicates(docs)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_doc_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept_doc_id"]), "left_semi")

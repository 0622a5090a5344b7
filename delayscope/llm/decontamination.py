"""Benchmark decontamination: size-partitioned MinHash containment search.

The question is how much of a short item lies inside a document of any length. Documents
are partitioned by the size of their shingle set; a partition's signature is a MinHash in
many more bins than its largest set has shingles, so that it always resolves a long document
as finely as a short one. An item's shingles are then looked up among a document's minima,
and what is found is verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.llm.common import stored, unused
from delayscope.llm.shingles import WORDS, WordHashes, shingle_set, words_of

PERCENT = 75
#: Bins per shingle of the largest set of a partition. A shared shingle is no minimum of its
#: bin once in 2,000 times at most; an item of ten shingles, eight of them shared, is missed
#: once in 1e26 times. Bins cost nothing: only those that hold something are looked at.
BINS_PER_SHINGLE = 1024
#: Items searched for in one pass over the documents: bounds what is broadcast, at about
#: a megabyte per thousand items.
BLOCK_ITEMS = 20_000

def partition_bits(size: int) -> int:
    """The partition of a set: sizes up to 2^k, k = 0, 1, 2, ..."""
    return max(0, int(size - 1).bit_length()) if size else 0


def minima(elements: np.ndarray) -> np.ndarray:
    """The minima of the non-empty bins of a one-permutation MinHash of sorted hashes.

    The bins are ranges of the hash: the first value in each range is its minimum. Their
    number follows from the partition of the set's size.
    """
    if not len(elements):
        return elements
    bits = partition_bits(len(elements)) + BINS_PER_SHINGLE.bit_length() - 1
    bins = elements >> np.uint64(64 - min(bits, 63))
    return elements[np.concatenate([[True], bins[1:] != bins[:-1]])]


class Index:
    """Items by the hashes of their shingles; exact shingles for the verification."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        hashes = WordHashes()
        self.ids = [i for i, _ in items]
        self.exact = [exact_shingles(words_of(t)) for _, t in items]
        words = [words_of(t) for _, t in items]
        #: Items of fewer words than a shingle, by their number of words.
        self.short: dict[int, dict[bytes, list[int]]] = {}
        for k, w in enumerate(words):
            if 0 < len(w) < WORDS:
                self.short.setdefault(len(w), {}).setdefault(b" ".join(w), []).append(k)
        sets = [shingle_set(w if len(w) >= WORDS else [], hashes) for w in words]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(elements)
        self.keys, self.owner = elements[order], owner[order]

    def candidates(self, elements: np.ndarray) -> set[int]:
        """Items one of whose shingles is among the document's minima."""
        found: set[int] = set()
        lowest = minima(elements)
        left = np.searchsorted(self.keys, lowest, side="left")
        hit = left < len(self.keys)
        hit[hit] = self.keys[left[hit]] == lowest[hit]
        if hit.any():
            right = np.searchsorted(self.keys, lowest[hit], side="right")
            for a, b in zip(left[hit].tolist(), right.tolist()):
                found.update(self.owner[a:b].tolist())
        return found


    def short_ones(self, words: list[bytes]) -> set[int]:
        """Short items that stand in the text as a run of words."""
        found: set[int] = set()
        for width, known in self.short.items():
            for run in {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)} & known.keys():
                found.update(known[run])
        return found


def exact_shingles(words: list[bytes]) -> frozenset[bytes]:
    """The shingles themselves, words joined by a blank (which no word holds)."""
    width = min(WORDS, len(words))
    return frozenset(b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)) if width else frozenset()


LINKS = "item_id long, doc_id long, n_item long, n_shared long"


def contained_items(docs: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, doc_id, n_item, n_shared) wherever a document holds 75 % of an item's shingles.

    Shingles are distinct runs of five words, A-Z lower-cased. An item of fewer words is one
    shingle of its own width, held by every document in which its words stand in a row. Texts without words hold
    nothing and lie in nothing. n_item is the size of the item's set, n_shared what the
    document's set shares with it. However far apart in the document the shared shingles
    lie, they count.

    Items are the stated query set: blocks of a bounded number of them are broadcast and
    met by every document, which is read in place. Null texts are empty; rows that repeat
    give their links again; ids can be null. Empty tables give an empty result; other
    columns are not read.
    """
    numbered = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n_blocks = max(1, -(-numbered.count() // block))
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for number in range(n_blocks):
        # Twice the mean block is beyond all chance for a hash of thousands of items.
        here = numbered if n_blocks == 1 else numbered.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == number)
        # Part of the function below, which Spark broadcasts when it is large.
        index = Index([(r["item_id"], r["text"]) for r in here.toLocalIterator()])

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known, hashes = index, WordHashes()
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = words_of(text)
                    some = known.candidates(shingle_set(words, hashes)) if words else ()
                    held = exact_shingles(words) if some else ()
                    for k in some:
                        item = known.exact[k]
                        shared = len(item & held)
                        if 100 * shared >= PERCENT * len(item):
                            rows.append((known.ids[k], doc, len(item), shared))
                    rows.extend((known.ids[k], doc, 1, 1) for k in known.short_ones(words))
                yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["item_id", "doc_id", "n_item", "n_shared"])

        links = source.mapInArrow(search, LINKS)
        found = links if found is None else found.unionByName(links)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns.

    Null and empty texts hold nothing and stay; rows without id are judged by their text,
    rows that repeat alike. No items leave all documents, an empty table stays empty;
    helper columns get names that are free.
    """
    (key,) = unused(docs.columns, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    links = contained_items(keyed.select(F.col(key).alias("doc_id"), "text"), items)
    tainted = stored(links.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(tainted, key, "left_anti").select(*docs.columns)

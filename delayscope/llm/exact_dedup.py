"""Exact deduplication: a two-pass Bloom filter singles out the rows that may have a copy.

Only those rows are shuffled by their digest; every other row goes straight to the result.
Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayscope.llm import bloom
from delayscope.llm.common import WHITE, stored, text_of, unused

def normalised(text: Column) -> Column:
    """The text without any white space of the set the contract names."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE, text)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One slim row per document: id, code points, normalised SHA-256 and a 64-bit hash."""
    text = text_of(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.char_length(text).cast("long").alias("n_points"),
        F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256"),
    ).withColumn("hash", F.xxhash64("text_sha256"))


def _probe(rows: DataFrame, seed: int, bits: int) -> DataFrame:
    """Rows plus ``hit``: whether another row falls into the same filter slot."""
    hashed = F.col("hash")
    counted = rows.groupBy(bloom.slot(hashed, seed, bits).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return bloom.probe(rows, hashed, bloom.bitmaps(counted.filter("n > 1")), seed, bits)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     bits_per_row: int = bloom.BITS_PER_ENTRY) -> DataFrame:
    """Group of equal texts of every document.

    Texts are equal when they are the same after white space is deleted; null is the
    empty text. Of a group the row with the most code points stays, at a tie the smallest
    id (a null id last). Returns doc_id, keep_id, group_size, kept, text_sha256.

    Pass one counts the rows per filter slot and keeps the repeated slots as bitmaps; only
    rows in such a slot enter pass two, which does the same with another hash and so far
    fewer rows. Rows that both filters mark are grouped by digest. A filter wrongly marks
    some unique rows (they come out of the grouping as groups of one) and never misses a
    copy. A hot text is counted before it moves, and the join that brings a group's
    winner back to its rows is one that adaptive execution splits.

    Rows that repeat entirely share an id: each of them is returned, and each equals the
    winner by id. An empty table gives an empty result; other columns are not read.
    """
    slim = stored(fingerprints(docs, id_column, text_column), "exact-fingerprints")
    bits = bloom.filter_bits(slim.count(), bits_per_row)
    first = _probe(slim, 1, bits)
    second = stored(
        first.filter("hit").drop("hit"), "exact-first-pass"
    )
    marked = _probe(second, 2, bits)
    unique = first.filter("NOT hit").drop("hit").unionByName(marked.filter("NOT hit").drop("hit"))
    suspects = marked.filter("hit").drop("hit")
    groups = suspects.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"),
        # The largest (code points, inverted id): most code points first, then the smallest id.
        F.max(F.struct("n_points", F.bitwise_not(F.col("doc_id").cast("long")).alias("inverted"))).alias("best"),
    ).select("text_sha256", "group_size", F.bitwise_not(F.col("best.inverted")).alias("keep_id"))
    # Stored first: the join then has plain shuffles on both sides, which can be split.
    copies = suspects.join(stored(groups, "exact-groups"), "text_sha256")
    columns = ["doc_id", "keep_id", "group_size", F.col("keep_id").eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256"]
    alone = unique.withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(1).cast("long"))
    return alone.select(columns).unionByName(copies.select(columns))


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: of each group of equal texts its winner.

    Null text is the empty text. A row without id stays where its text equals no other, or
    where no row of its group has an id; rows that repeat entirely stay or go together. An
    empty table stays empty; helper columns get names that are free.
    """
    own, digest = unused(docs.columns, "kept_id", "kept_sha256")
    found = exact_duplicates(docs, id_column, text_column).filter("kept")
    kept = found.select(F.col("doc_id").alias(own), F.col("text_sha256").alias(digest)).distinct()
    same = docs[id_column].eqNullSafe(kept[own]) & (F.sha2(normalised(F.coalesce(docs[text_column].cast("string"), F.lit(""))).cast("binary"), 256) == kept[digest])
    return docs.join(kept, same, "left_semi")

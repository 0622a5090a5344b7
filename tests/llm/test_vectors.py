"""Hard negatives, whitening and SimHash against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from delayscope.llm import hard_negatives, queries, simhash, whitening
from tests.llm.fixtures import WHITE, components, documents, frame

SCHEMA = "vec_id long, embedding array<float>, label int, search long, x string, score int"


def vectors(seed=5, n=230, d=24):
    """Rows with clusters, ties, nulls, NaN, infinities, other lengths and repeated rows."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, d))
    rows = [(i, [float(np.float32(v)) for v in centres[i % 6] + 0.4 * rng.standard_normal(d)], i % 4) for i in range(n)]
    rows[30] = (30, rows[31][1], rows[31][2])
    rows += [(900, None, 1), (901, [None] * d, 1), (902, [float("nan")] + [0.0] * (d - 1), 1), (903, [float("inf")] * d, 2),
             (904, [1.0] * 3, 1), (905, [], 1), (None, [0.5] * d, 1), (906, [0.5] * d, None), (907, [0.0] * d, 3), rows[12], rows[50]]
    return rows


def as_table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)


def whole(row, scale):
    return [int(np.floor(scale * c)) for c in row]


def mined(rows, anchors):
    rows = {i: (whole(v, 256), lab) for i, v, lab in rows if i is not None and lab is not None and v and len(v) == 24 and all(c is not None and np.isfinite(c) for c in v)}
    out = set()
    for a in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(rows[a][0], rows[b][0])), b) for b in rows if b != a)
        same = [(b, -s) for s, b in scored if rows[b][1] == rows[a][1]][:5]
        other = [(b, -s) for s, b in scored if rows[b][1] != rows[a][1]]
        for p, ps in same:
            fits = [(b, s) for b, s in other if 50 * ps <= 100 * s <= 95 * ps][:3]
            out |= {(a, p, k + 1, b, ps, s) for k, (b, s) in enumerate(fits)}
    return out


def test_hard_negatives(spark):
    from pyspark.sql import functions as F

    rows = vectors()
    table = as_table(spark, rows)
    want = mined(rows, lambda i: i % 10 == 0)
    assert len(want) > 50
    for block in (1000, 7):
        found = hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, anchor_block=block).collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_hard_negatives_of_nothing(spark):
    from pyspark.sql import functions as F

    table = as_table(spark, vectors())
    assert hard_negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(table, F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(table.filter("vec_id = 900"), F.lit(True)).count() == 0


def test_intervals_hold_the_score_and_drop_rows():
    rng = np.random.default_rng(2)
    x = np.floor(200 * rng.standard_normal((400, 100))).astype(np.int64)
    coder = hard_negatives.Coder(100)
    codes, alignments, left = coder.codes(x.astype(float))
    low, high = hard_negatives.Anchors(coder, x[:40].astype(float)).intervals(codes, alignments, left, slice(0, 40))
    scores = x @ x[:40].T
    assert ((low <= scores) & (scores <= high)).all()
    # The interval is useful: most rows are ruled out against the tenth best score.
    assert (high < np.sort(scores, axis=0)[-10]).mean() > 0.5


def test_scores_past_a_long_are_held():
    big = np.full((1, 8), 2**61, np.int64)
    assert hard_negatives.exact_scores(big, big)[0] == 2**63 - 1
    assert hard_negatives.exact_scores(big, -big)[0] == -(2**63)
    assert hard_negatives.exact_scores(np.array([[3, -4]]), np.array([[5, 6]]))[0] == -9


def test_whitening(spark):
    rows = vectors()
    clean = [(i, v) for i, v, _ in rows if v and len(v) == 24 and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([whole(v, 64) for _, v in clean]) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    scaled = n * x - s
    cov = (scaled / n).T @ (scaled / n) / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    found = whitening.whiten(as_table(spark, rows)).collect()
    assert len(found) == n * 24
    assert {r["n"] for r in found} == {n} and max(r["identity_error"] for r in found) < 1e-9
    got = defaultdict(dict)
    for r in found:
        got[r["vec_id"], r["deviation"]][r["component"]] = r["whitened"]
        assert abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9
    signs = None
    for (i, _), row in zip(clean, scaled):
        own = got[i, int((row.astype(object) ** 2).sum())]
        want = (row / n) @ u / np.sqrt(e)
        here = np.array([own[c + 1] for c in range(24)])
        signs = np.sign(here * want) if signs is None else signs
        assert np.abs(here - signs * want).max() < 1e-8


def test_whitening_without_spread(spark):
    table = as_table(spark, vectors())
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id IN (900, 901, 905)")).count() == 0
    alike = as_table(spark, [(i, [1.0, 2.0], 0) for i in range(5)])
    assert whitening.whiten(alike).count() == 0
    line = as_table(spark, [(i, [float(i), 2.0 * i, 1.0], 0) for i in range(9)])
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9


def test_whitened_rows_are_numbered_without_gaps(spark):
    rows = spark.range(1000).repartition(7).selectExpr("id AS vec_id").filter("vec_id % 3 > 0")
    numbered = whitening.indexed(rows).collect()
    assert sorted(r["index"] for r in numbered) == list(range(len(numbered)))


def naive_fingerprint(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in re.split(WHITE, low) if x]
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    rows = documents()
    prints = {i: naive_fingerprint(t) for i, t, _ in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = {i: (f"{prints[i]:016x}", c) for i, c in components(prints, links).items()}
    docs = frame(spark, rows).withColumn("f", simhash.F.lit("clash"))
    found = simhash.simhash_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == want and len(found) == len(rows)
    kept = simhash.drop_simhash_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_simhash_of_nothing_and_of_odd_ids(spark):
    docs = frame(spark, documents())
    assert simhash.simhash_duplicates(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (None, "A b  c"), (7, "a b c"), (7, "a b c"), (None, "z")], "doc_id long, text string")
    assert [(r["doc_id"], r["component_id"]) for r in simhash.simhash_duplicates(odd).orderBy("doc_id").collect()] in ([(None, 7), (None, 7), (None, None), (7, 7), (7, 7)], [(None, 7), (None, None), (None, 7), (7, 7), (7, 7)], [(None, None), (None, 7), (None, 7), (7, 7), (7, 7)])


def clustered(seed, families, size, flips=4):
    rng = np.random.default_rng(seed)
    found = []
    for centre in rng.integers(0, 2**64, families, np.uint64):
        masks = np.zeros(size, np.uint64)
        for _ in range(flips):
            masks ^= np.left_shift(np.uint64(1), rng.integers(0, 64, size).astype(np.uint64))
        found.append(centre ^ masks)
    return np.unique(np.concatenate([*found, rng.integers(0, 2**64, 800, np.uint64)]))


@pytest.mark.parametrize("families, size, shard_rows", [(40, 12, 64), (1, 900, 64), (3, 300, 128)])
def test_shards_and_flips_find_the_components_of_all_pairs(spark, families, size, shard_rows):
    f = clustered(families, families, size)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 2
    signed = f.view(np.int64).tolist()
    want = components(signed, [(signed[a], signed[b]) for a, b in zip(*(x.tolist() for x in np.nonzero(near))) if a < b])
    table = spark.createDataFrame([(v,) for v in signed], "f long")
    found = [(r["a"], r["b"]) for r in simhash.links(table, shard_rows, sample_rows=400).collect()]
    got = components(signed, found)
    assert got == want


def test_linked_fingerprints_meet_in_some_shard():
    f = clustered(9, 60, 8)
    tree = simhash.fit(f, len(f), 64)
    row, shard = tree.route(f)
    held = defaultdict(set)
    for r, s in zip(row.tolist(), shard.tolist()):
        held[r].add(s)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 2
    assert all(held[a] & held[b] for a, b in zip(*(x.tolist() for x in np.nonzero(near))))
    assert len(set(shard.tolist())) > 8 and len(row) < 6 * len(f)


def test_queries_have_a_row_for_everything(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    assert queries.QUERIES["op13_simhash"](spark, small).count() == n
    assert {r["component"] for r in queries.QUERIES["op12_whitening"](spark, small).select("component").distinct().collect()} == set(range(1, 33))

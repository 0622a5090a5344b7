"""Exact, near, line and substring deduplication against brute force."""

import hashlib
import random
import re

import pytest

from delayscope.llm import exact_dedup, line_dedup, near_dedup, substring_dedup
from delayscope.llm.linking import candidate_pairs, connected_components, link, prefix_pairs, shared_buckets
from tests.llm.fixtures import components, documents, frame, line_components, near_components, repeated, words


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


def test_exact(docs, rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    found = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert len(found) == len(rows)
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = found[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(members), i == keep)
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.drop_exact_duplicates(docs).columns == docs.columns


def test_exact_of_nothing_and_of_null_ids(spark, docs):
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (7, "a"), (7, "a")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup.exact_duplicates(odd).collect()} == {(None, 7, 4), (7, 7, 4)}
    least = -(2**63)
    odd = spark.createDataFrame([(least, "a"), (5, "a"), (None, "b"), (None, "a")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.exact_duplicates(odd).collect()} == {
        (least, least, True), (5, least, False), (None, None, True), (None, least, False),
    }
    assert sorted((r["text"], r["doc_id"]) for r in exact_dedup.drop_exact_duplicates(odd).collect()) == [("a", least), ("b", None)]


def test_near(docs, rows):
    want = near_components(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert found == want
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_near_of_nothing(docs):
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def family(rng, n, size=150, changes=12, at=0):
    """Texts made from one by some changed words each: alike to some others, unlike to most."""
    base = words(rng, size)
    texts = []
    for k in range(n):
        now = list(base)
        for i in rng.sample(range(size), rng.randint(0, changes)):
            now[i] = f"w{at}x{k}y{i}"
        texts.append(" ".join(now))
    return texts


def test_near_in_a_large_family_of_changed_copies(spark):
    rng = random.Random(12)
    texts = family(rng, 90) + family(rng, 40, changes=4, at=1) + [" ".join(words(rng, 80)) for _ in range(30)]
    rows = [(i, t, "en") for i, t in enumerate(rng.sample(texts, len(texts)))]
    want = near_components(rows)
    assert len({c for _, c in want.values()}) > 35
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert found == want


def test_near_with_null_ids_and_repeated_rows(spark):
    text = " ".join(words(random.Random(3), 60))
    rows = [(None, text, "a"), (None, "one two three", "a"), (5, text, "b"), (5, text, "b"), (9, text + " more", "c"), (9, text + " more", "c"), (None, None, "d")]
    docs = frame(spark, rows).withColumn("kept_id", near_dedup.F.lit(1))
    found = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in near_dedup.near_duplicates(docs).collect())
    assert found == [(-1, 0, -1), (-1, 1, -1), (-1, 56, 5), (5, 56, 5), (5, 56, 5), (9, 57, 5), (9, 57, 5)]
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["lang"]) for r in left.collect()) == [(-1, "a"), (-1, "d"), (5, "b"), (5, "b")]


def test_sketches_merge_and_estimate():
    import numpy as np

    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:3000]
    s, t, u = near_dedup.sketch([a, b, pool])
    assert (near_dedup.merge(s, t) == u).all()
    (j,) = near_dedup.estimate(s[None], t[None], np.array([2000.0]), np.array([2500.0]))
    assert abs(j - 0.5) < 0.12


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 130)] + [(5, 5)]
    nodes = {n for e in edges for n in e}
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == components(nodes, edges)


def numbers_as_sets(spark, width=8):
    """Id i holds i..i+width: neighbours share width of width + 2 elements."""
    from pyspark.sql import functions as F

    return lambda ids: ids.select("id", F.lit(0).alias("kind"), F.explode(F.sequence("id", F.col("id") + width)).alias("element"))


@pytest.mark.parametrize("repeats", [1, 12])
def test_link_finds_chains_inside_one_bucket(spark, repeats):
    ids = [1000 * k + i for k in range(repeats) for i in (1, 2, 3, 9, 10, 20, 21, 22, 30)]
    shared = shared_buckets(spark.createDataFrame([(0, i) for i in ids], "key long, id long"))
    pairs, large = candidate_pairs(shared)
    assert (large.count() > 0) == (repeats > 1)
    found = {r["id"]: r["component"] for r in link(pairs, large, lambda p: p.filter("abs(a - b) <= 1"), numbers_as_sets(spark), 75).collect()}
    small = {1: 1, 2: 1, 3: 1, 9: 9, 10: 9, 20: 20, 21: 20, 22: 20, 30: 30}
    assert {i: found.get(i, i) for i in ids} == {i: 1000 * (i // 1000) + small[i % 1000] for i in ids}


def test_pairs_of_a_bucket_of_unlike_members_grow_in_proportion(spark):
    """Members share half of their elements, as documents do around a common passage."""
    from pyspark.sql import functions as F

    checked = {}
    for n in (200, 400, 800):
        shared = shared_buckets(spark.createDataFrame([(0, i) for i in range(n)], "key long, id long"))
        seen = spark.sparkContext.accumulator(0)

        def verify(pairs, seen=seen):
            seen.add(pairs.count())
            return pairs.filter("false")

        def elements(ids):
            return ids.select("id", F.lit(0).alias("kind"), F.explode(F.concat(F.sequence(F.lit(-30), F.lit(-1)), F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.col("id") * 100 + k))).alias("element"))

        assert link(*candidate_pairs(shared), verify, elements, 75).count() == 0
        checked[n] = seen.value
    assert all(checked[n] <= 2 * n for n in checked), checked


def test_pairs_within_families_grow_in_proportion(spark):
    """What tells the members of one family apart is common in others; members share half of their elements."""
    from pyspark.sql import functions as F

    families, members = 30, 20
    shared = shared_buckets(spark.range(families * members).select((F.col("id") % families).alias("key"), "id"))
    seen = spark.sparkContext.accumulator(0)

    def verify(pairs):
        seen.add(pairs.count())
        return pairs.filter("false")

    def elements(ids):
        core = F.transform(F.sequence(F.lit(1), F.lit(70)), lambda k: (F.col("id") % families) * 1000 + k)
        own = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: -F.floor(F.col("id") / families) * 100 - k)
        return ids.select("id", F.lit(0).alias("kind"), F.explode(F.concat(core, own)).alias("element"))

    assert link(*candidate_pairs(shared), verify, elements, 75).count() == 0
    assert seen.value <= 2 * families * members, seen.value


def test_a_family_in_many_buckets_meets_few_of_its_members(spark):
    """Each of 40 buckets holds half of a family: the links are a few for each member, not one for each of its buckets."""
    from pyspark.sql import functions as F

    for n in (200, 800):
        rows = spark.range(n).select("id", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("key")).filter(F.xxhash64("id", "key") % 2 == 0)
        shared = shared_buckets(rows.select(F.col("key").cast("long"), "id"))
        seen = []

        def verify(pairs, seen=seen):
            seen.append(pairs.count())
            return pairs

        found = link(*candidate_pairs(shared), verify, None, 75)
        assert found.count() == n and found.select("component").distinct().count() == 1
        assert seen[0] <= 8 * n, seen


def test_prefix_pairs_leave_no_alike_pair_out(spark):
    rng = random.Random(4)
    sets = {}
    for i in range(240):
        base = sets[rng.randrange(i)] if i and rng.random() < 0.7 else {rng.randrange(400) for _ in range(rng.randint(1, 60))}
        sets[i] = {e if rng.random() > 0.08 else rng.randrange(400) for e in base} | {rng.randrange(400) for _ in range(rng.randint(0, 3))}
    rows = [(i, i, 0, e) for i, s in sets.items() for e in s]
    table = spark.createDataFrame(rows, "id long, c long, kind int, element long")
    for percent in (75, 45):
        found = {(r["a"], r["b"]) for r in prefix_pairs(table, percent).collect()}
        want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        assert want <= found and len(want) > 40
        if percent == 75:
            assert len(found) < 240 * 239 / 2 / 8


def test_places_in_sets_take_no_join_by_id(spark, monkeypatch):
    """A join of elements with their sets makes a row for each element of each large set."""
    from delayscope.llm import linking

    plans, real = [], linking.stored
    monkeypatch.setattr(linking, "stored", lambda df, label: plans.append(df._jdf.queryExecution().analyzed().toString()) or real(df, label))
    table = spark.createDataFrame([(i, i, 0, e) for i in range(4) for e in range(i, i + 20)], "id long, c long, kind int, element long")
    assert prefix_pairs(table, 75).count() > 0
    joins = [line for plan in plans for line in plan.splitlines() if "Join " in line]
    assert joins and not [line for line in joins if "(id#" in line], joins


def test_lines(docs, rows):
    want = line_components(rows)
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_decisions(docs).collect()}
    assert found == want


def test_documents_without_repeated_lines(spark):
    rows = [
        (1, "a line that stays here\n\nanother line of text", "en"), (2, "a line that stays here\nand one of its own", "en"),
        (3, "A line that stays here ", "en"), (4, None, "en"), (5, "", "en"),
    ]
    docs = frame(spark, rows)
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {
        1: "a line that stays here\n\nanother line of text", 2: "and one of its own", 4: None, 5: "",
    }
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_lines_with_null_ids_repeated_rows_and_clashing_names(spark):
    rows = [(None, "first line of it\nsecond line here", "a"), (4, "first line of it\nanother one", "b"), (4, "first line of it\nanother one", "b"), (None, None, "c")]
    clash = {n: line_dedup.F.lit("x") for n in ("gone_lines", "some_left", "text_key", "text_lines", "some", "gone", "key_of_text", "normal", "line")}
    docs = frame(spark, rows).withColumns(clash)
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert sorted((r["lang"], r["text"], r["some"], r["text_key"]) for r in left.collect() if r["text"]) == [
        ("a", "second line here", "x", "x"), ("b", "first line of it\nanother one", "x", "x"), ("b", "first line of it\nanother one", "x", "x"),
    ]
    assert left.count() == 4


def test_lines_around_a_common_passage(spark):
    """A passage in many long lines, some of which are alike and most of which are not."""
    rng = random.Random(21)
    passage = words(rng, 40)
    lines = []
    for k in range(60):
        own = words(rng, 5 + k)
        line = " ".join(own[: k // 2] + passage + own[k // 2 :])
        lines.append(line)
        if k % 3 == 0:
            lines.append(line.replace(own[0], own[0] + "s", 1))
    rows = [(i, line, "en") for i, line in enumerate(lines)]
    want = line_components(rows)
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_decisions(frame(spark, rows)).collect()}
    assert found == want


def kept_lines(spark, lines):
    """The number of the line that stays for each line of one document."""
    found = line_dedup.line_decisions(frame(spark, [(1, "\n".join(lines), "en")])).collect()
    return {r["line_no"]: r["keep_line_no"] for r in found}


def test_periodic_lines_meet_whatever_their_length(spark):
    phrases = ["ab cd ", "-- | ", "12 345 ", "total sum ", "x = y + ", "no no yes "]
    lines = [(phrase * n).strip() for phrase in phrases for n in (20, 40, 400)]
    assert kept_lines(spark, lines) == {i: i // 3 * 3 for i in range(len(lines))}


def jaccard(a, b):
    x, y = ({line[i : i + 5] for i in range(max(1, len(line) - 4))} for line in (a, b))
    return len(x & y) / len(x | y)


def mistyped(rng, line, letters):
    """The line after one letter after another was changed, as long as it stays alike."""
    now = line
    while True:
        p = rng.randrange(len(now))
        then = now[:p] + rng.choice(["", rng.choice(letters), rng.choice(letters) + now[p]]) + now[p + 1 :]
        if jaccard(line, then) < 0.75 or then != then.strip() or not then:
            return now
        now = then


def test_alike_lines_of_one_to_four_words_meet(spark):
    rng = random.Random(8)
    lines = ["contact us", "contact us!", "read more", "read more.", "internationalisation", "internationalisations"]
    for n in range(400):
        line = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 12))) for _ in range(1 + n % 4))
        lines += [line, mistyped(rng, line, "abcdefghijklmnop")]
    assert kept_lines(spark, lines) == {i: i // 2 * 2 for i in range(len(lines))}


@pytest.mark.parametrize("script", ["spaced", "unspaced"])
def test_alike_lines_of_every_length_meet(spark, script):
    rng = random.Random(9)
    letters = "abcdefghijklmnoprstuvw" if script == "spaced" else "".join(map(chr, range(0x4E00, 0x4E00 + 800)))
    lines = []
    for n in range(1000):
        if script == "spaced":
            line = " ".join("".join(rng.choices(letters, k=rng.randint(1, 10))) for _ in range(12 + n % 80))
        else:
            line = "".join(rng.choices(letters, k=20 + n % 400))
        lines += [line, mistyped(rng, line, letters)]
    found = kept_lines(spark, lines)
    assert sum(found[i] != i // 2 * 2 for i in range(len(lines))) <= 1


def test_line_sizes_and_unions_are_exact():
    from delayscope.llm import line_signatures

    rng = random.Random(4)
    lines = ["a", "ab", "abcde", "aaaaaaaaaaaa", "x" * 3000, "caf\u00e9 \U0001f600 ok", *(" ".join(words(rng, n)) for n in (1, 2, 3, 40, 400))]
    lines += [line + "s" for line in lines]
    sets = [{line[i : i + 5] for i in range(max(1, len(line) - 4))} for line in lines]
    sizes, minima = line_signatures.signatures(lines)
    assert sizes.tolist() == [len(s) for s in sets]
    assert line_signatures.band_keys(minima).shape == (line_signatures.BANDS, len(lines))
    pairs = [(i, j) for i in range(len(lines)) for j in range(len(lines))][:480]
    found = line_signatures.union_sizes([lines[i] for i, _ in pairs], [lines[j] for _, j in pairs])
    assert found.tolist() == [len(sets[i] | sets[j]) for i, j in pairs]
    assert sorted(i for block in line_signatures.blocks(lines * 100) for i in block) == list(range(len(lines) * 100))


@pytest.mark.parametrize("held", [1 << 20, 200])
def test_buckets_of_any_size_in_bounded_memory(held):
    """Buckets of 1, 2, 3, 10 and 700 members, which come piece by piece and repeatedly."""
    import numpy as np

    from delayscope.llm import line_signatures

    rng = random.Random(5)
    members = {key: set(range(n)) for key, n in enumerate([1, 2, 3, 10, 700] * 20)}
    entries = [(k, i) for k, m in members.items() for i in m] * 2
    rng.shuffle(entries)
    buckets = line_signatures.Buckets(most=10, held=held)
    large, least = set(), []
    for at in range(0, len(entries), 97):
        k, i = zip(*entries[at : at + 97])
        for keys, ids in buckets.add(np.array(k, np.uint64), np.array(i, np.int64)):
            large |= set(zip(keys.tolist(), ids.tolist()))
            least.append(buckets.held)
    (keys, ids), (sizes, small) = buckets.finish()
    large |= set(zip(keys.tolist(), ids.tolist()))
    assert large == {(k, i) for k, m in members.items() if len(m) > 10 for i in m}
    lists = np.split(small, np.cumsum(sizes)[:-1])
    assert sorted(map(list, lists)) == sorted(sorted(m) for m in members.values() if 1 < len(m) <= 10)
    assert all(n <= 10 * len(members) for n in least)


def test_buckets_take_a_few_times_the_memory_of_their_entries():
    import tracemalloc

    import numpy as np

    from delayscope.llm import line_signatures

    rng = np.random.default_rng(7)
    n = 1 << 17
    tracemalloc.start()
    buckets = line_signatures.Buckets(most=10)
    for _ in range(n // 1024):
        list(buckets.add(rng.integers(0, 1 << 62, 1024).astype(np.uint64), rng.integers(0, 1 << 62, 1024)))
    buckets.finish()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 4 * 16 * n, peak / n


def test_a_task_gets_its_share_of_the_bucket_keys(spark):
    """Keys are dealt evenly, none of the tasks takes several times the number it is asked to."""
    from pyspark.sql import functions as F

    lines = spark.range(1000).select(F.col("id").alias("node"), F.repeat(F.hex(F.xxhash64("id")), 3).alias("normal"))
    found = line_dedup.shared_buckets(lines.unionByName(lines.withColumn("node", -F.col("node") - 1)), 2000, task_keys=1000)
    buckets = found.withColumn("task", F.spark_partition_id())
    sizes = [r["n"] for r in buckets.groupBy("task").agg(F.sum(F.size("ids")).alias("n")).collect()]
    assert len(sizes) == 80 and sum(sizes) == 80000 and max(sizes) <= 1300, sizes


def test_batches_are_taken_a_few_rows_at_a_time():
    import pyarrow as pa

    from delayscope.llm.common import few_rows

    batches = [pa.record_batch([list(range(k))], names=["x"]) for k in (0, 1, 600)]
    found = list(few_rows(iter(batches), 256))
    assert [b.num_rows for b in found] == [1, 256, 256, 88]
    assert [x for b in found for x in b.column(0).to_pylist()] == [0, *range(600)]


def test_a_hot_bucket_leaves_by_itself():
    import numpy as np

    keys = np.array([7] * 50 + [8, 8, 9], np.uint64)
    ids = np.concatenate([np.arange(50), [1, 1, 2]]).astype(np.int64)
    rows = line_dedup._packed(keys, ids, 4, 10).to_pylist()
    hot = [r for r in rows if r["part"] >= 4]
    assert sorted(i for r in hot for i in np.frombuffer(r["ids"], np.int64)) == list(range(50)) and len(hot) == 4
    told = [r for r in rows if r["large"]]
    assert [np.frombuffer(r["large"], np.uint64).tolist() for r in told] == [[7]] and told[0]["part"] == 7 % 4
    assert sum(len(r["keys"]) // 8 for r in rows if r["part"] < 4) == 2


def test_a_bucket_of_unlike_members_comes_apart():
    """Long lines that met by chance give few pairs and no large bucket; near copies among them are one."""
    import numpy as np

    from delayscope.llm import line_signatures

    rng = np.random.default_rng(6)
    marks = rng.integers(0, 1 << 24, 300).astype(np.uint32) << np.uint32(8) | rng.integers(100, 130, 300).astype(np.uint32)
    marks[200:240] = marks[200]
    buckets = line_signatures.Buckets(most=1024)
    assert not list(buckets.add(np.full(200, 7, np.uint64), np.arange(200), marks[:200]))
    assert not list(buckets.add(np.full(100, 8, np.uint64), np.arange(200, 300), marks[200:]))
    (keys, ids), (a, b) = buckets.finish_pairs()
    assert len(np.unique(keys)) == 1 and set(range(200, 240)) <= set(ids.tolist()) and len(ids) < 50
    assert 0 < len(a) < 0.06 * 200 * 199 / 2 and (a < b).all() and line_signatures.possible(marks[a], marks[b]).all()


def test_bucket_keys_move_in_few_bytes():
    import numpy as np
    import pyarrow as pa

    from delayscope.llm import line_signatures

    rng = np.random.default_rng(8)
    n, parts = 1 << 18, 50
    keys, ids = rng.integers(0, 1 << line_signatures.KEY_BITS, n).astype(np.uint64), rng.integers(0, 1 << 62, n)
    rows = line_dedup._short(line_dedup._packed(keys, ids, parts, 32, rng.integers(0, 1 << 32, n).astype(np.uint32)), parts).to_pylist()
    moved = sum(pa.compress(r[c], "lz4_raw").size for r in rows for c in ("keys", "ids", "marks"))
    assert moved <= 15.5 * n, moved / n
    found = [line_dedup._whole_keys(pa.py_buffer(r["keys"]), len(r["ids"]) // 8, r["part"], parts) for r in rows]
    assert np.array_equal(np.sort(np.concatenate(found)), np.sort(keys))
    owner = dict(zip(ids.tolist(), keys.tolist()))
    assert all(owner[i] == k for r, f in zip(rows, found) for i, k in zip(np.frombuffer(r["ids"], np.int64).tolist(), f.tolist()))


def test_alike_lines_bear_alike_marks():
    """Of the buckets that alike lines share, marks part them in few."""
    import numpy as np

    from delayscope.llm import line_signatures

    rng = random.Random(10)
    lines = [" ".join("".join(rng.choices("abcdefghijklmnoprst", k=rng.randint(2, 9))) for _ in range(1 + n % 60)) for n in range(240)]
    changed = [mistyped(rng, line, "abcdefghijklmnoprst") for line in lines]
    (sizes, minima), (sizes_b, minima_b) = line_signatures.signatures(lines), line_signatures.signatures(changed)
    met = line_signatures.band_keys(minima) == line_signatures.band_keys(minima_b)
    marks = line_signatures.possible(line_signatures.bucket_marks(sizes, minima), line_signatures.bucket_marks(sizes_b, minima_b))
    assert met.sum() > 1000 and marks[met].mean() > 0.98
    other = np.roll(line_signatures.bucket_marks(sizes_b, minima_b), 1, axis=1)
    assert line_signatures.possible(line_signatures.bucket_marks(sizes, minima), other).mean() < 0.1


def test_lines_are_put_in_lower_case_as_one_text(spark):
    """As line by line: a sigma at the end of a line is a final one there."""
    from pyspark.sql import functions as F

    text = "\u039f\u0394\u039f\u03a3\n\u039f\u0394\u039f\u03a3\u0391 \u0130X\n\v Two Words\t\n \r\n\u1e9e\u00c4"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = line_dedup.lines_of(docs, F.lower("text")).select("line_no", line_dedup.normal_form(F.col("line")).alias("n")).collect()
    apart = line_dedup.lines_of(docs, F.col("text")).select("line_no", F.lower(F.btrim("line", F.lit(" \t\n\v\f\r"))).alias("n")).collect()
    assert whole == apart and len(whole) == 5 and whole[2]["n"] == "two words" and whole[3]["n"] == ""


@pytest.mark.parametrize("hot", [1024, 1])
def test_substrings(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_PLACES", hot)
    found = {r["doc_id"]: r for r in substring_dedup.repeated_bytes(docs, with_bytes=True).collect()}
    for i, (n, removed, runs, left) in repeated(rows).items():
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, removed, runs)
        assert bytes(r["kept_bytes"]) == left and r["kept_sha256"] == hashlib.sha256(left).hexdigest()


def test_substrings_keep_no_table_longer_than_needed(spark, docs):
    import os

    from delayscope.sinks.scratch import scratch_path

    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file://")
    before = set(os.listdir(folder))
    assert substring_dedup.repeated_bytes(docs).count() == docs.count()
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"texts-with-copies", "spans", "partly"}


def test_substrings_keep_the_first_copy(spark):
    passage = "".join(random.Random(1).choices("abcdefgh ", k=900))
    docs = frame(spark, [(1, f"AAAA {passage} BBBB", "en"), (2, f"CCCC {passage} DDDD", "en"), (3, None, "en")])
    found = {r["doc_id"]: bytes(r["kept_bytes"]) for r in substring_dedup.repeated_bytes(docs, keep="first", with_bytes=True).collect()}
    assert found[1] == f"AAAA {passage} BBBB".encode()
    assert found[2].startswith(b"CCCC") and found[2].endswith(b"DDDD") and len(found[2]) < 200
    assert found[3] == b"" and substring_dedup.repeated_bytes(docs.limit(0)).count() == 0

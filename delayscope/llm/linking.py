"""From hash buckets to connected components, with pairs in proportion to the buckets' rows.

Built-in functions only. Ids can be of any orderable type; within a component the
smallest id is the representative.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayscope.llm import bloom
from delayscope.llm.common import discard, stored

#: Members of a bucket among which all pairs are looked at.
SMALL_BUCKET = 16
#: How often the members of a larger bucket meet one of them, chosen anew each time.
TURNS = 2
#: Ratio of the sizes of neighbouring size classes.
CLASS_RATIO = 1.1


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the undirected edges (a, b): distributed union-find.

    Every node has a parent, at first itself. A step lets nodes and their parents hook onto
    the smallest grandparent among their neighbours, then halves the paths; it ends when no
    grandparent changes. The number of steps is about the logarithm of the longest path,
    two or three for the stars that buckets give. Tables are stored before they are joined:
    both join inputs are then plain shuffles, which adaptive execution splits where one hub
    has a large share of all edges; the tables of a step go when the next one is written.
    Self links and repeated edges do no harm; no edges give no rows.
    """
    both = edges.filter("a <> b").select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
    links = stored(both.select("e.u", "e.v"), "links")
    # The first step needs no join: every node is its own grandparent.
    near = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.col("u").alias("f"), F.least("u", "m").alias("m"))
    before = forest = None
    while True:
        hooks = near.select(F.explode(F.array(F.struct(F.col("u").alias("id"), "m"), F.struct(F.col("f").alias("id"), "m"))).alias("h"))
        parents = stored(hooks.groupBy("h.id").agg(F.min("h.m").alias("f")), "parents")
        up = parents.select(F.col("id").alias("f"), F.col("f").alias("g"))
        last, forest = forest, stored(parents.join(up, "f").select("id", "f", "g"), "forest")
        discard(parents, last)
        now = forest.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("id", "g")), F.sum((F.col("f") != F.col("g")).cast("int"))).first()
        if now == before or not now[0]:
            discard(links)
            return forest.select("id", F.col("f").alias("component"))
        before = now
        around = links.join(forest.select(F.col("id").alias("v"), "g"), "v").groupBy("u").agg(F.min("g").alias("m"))
        near = around.join(forest, around["u"] == forest["id"]).select("u", "f", F.least("m", "g").alias("m"))


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """The distinct (key, id, ...) of keys that occur more than once.

    Nearly all keys occur once. They are counted by themselves first; a Bloom filter of
    the repeated ones then lets only rows through that may belong to them.
    """
    repeated = stored(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "repeated-keys")
    near = bloom.maybe_among(buckets, "key", repeated)
    shared = stored(near.join(repeated, "key", "left_semi").dropDuplicates(["key", "id"]), "shared-buckets")
    discard(repeated)
    return shared


def candidate_pairs(shared: DataFrame, possible: Callable[[Column, Column], Column] | None = None,
                    most: int = SMALL_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b) of the small buckets, rows (key, id, mark) of the larger ones).

    ``possible`` tests the marks of two members and spares unlike ones any further check;
    a small bucket has at most ``most`` members, so that there are most / 2 pairs a row.
    """
    if "mark" not in shared.columns:
        shared = shared.withColumn("mark", F.lit(0))
    sizes = stored(shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bucket-sizes")
    small = stored(shared.join(sizes.filter(F.col("n") <= most), "key").select("key", "id", "mark"), "small-buckets")
    large = stored(shared.join(sizes.filter(F.col("n") > most), "key").select("key", "id", "mark"), "large-buckets")
    x, y = small.select("key", F.col("id").alias("a"), F.col("mark").alias("m")), small.select("key", F.col("id").alias("b"), F.col("mark").alias("o"))
    alike = F.lit(True) if possible is None else possible(F.col("m"), F.col("o"))
    pairs = stored(x.join(y, "key").filter((F.col("a") < F.col("b")) & alike).select("a", "b").distinct(), "small-pairs")
    discard(sizes, small)
    return pairs, large


def _labelled(rows: DataFrame, components: DataFrame | None, end: str, label: str) -> DataFrame:
    """The rows with the component of the id in column ``end``."""
    if components is None:
        return rows.withColumn(label, F.col(end))
    found = components.select(F.col("id").alias(end), F.col("component").alias(label))
    return rows.join(found, end, "left").withColumn(label, F.coalesce(label, end))


def _open(rows: DataFrame, components: DataFrame | None) -> DataFrame:
    """(key, id, mark, c) of the buckets whose members lie in different components."""
    labelled = stored(_labelled(rows, components, "id", "c").select("key", "id", "mark", "c"), "labelled-buckets")
    unfinished = stored(labelled.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least <> most").select("key"), "unfinished-keys")
    found = stored(labelled.join(unfinished, "key"), "open-buckets")
    discard(labelled, unfinished)
    return found


def _with_pivots(rows: DataFrame, turn: int, possible) -> DataFrame:
    """Pairs of the members of open buckets with one of them, another one in each turn.

    The order that chooses is the same in all buckets of a turn: a family of copies that
    shares many buckets meets the same few members in all of them, not others in each.
    """
    chance = F.xxhash64(F.lit(turn), "id").alias("chance")
    pivots = stored(
        rows.groupBy("key").agg(F.min(F.struct(chance, F.col("id").alias("p"), F.col("c").alias("pc"), F.col("mark").alias("p_mark"))).alias("pivot")).select("key", "pivot.*"), "pivots",
    )
    likely = F.lit(True) if possible is None else possible(F.col("mark"), F.col("p_mark"))
    meet = rows.join(pivots, "key").filter((F.col("c") != F.col("pc")) & likely)
    return meet.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b"))


def _families(rows: DataFrame) -> DataFrame:
    """(c, family) of the components in the open buckets (key, c): those that a chain of buckets joins."""
    inside = rows.select("key", "c").distinct()
    heads = inside.groupBy("key").agg(F.min("c").alias("a"))
    stars = stored(inside.join(heads, "key").select("a", F.col("c").alias("b")).distinct(), "bucket-stars")
    found = connected_components(stars).select(F.col("id").alias("c"), F.col("component").alias("family"))
    discard(stars)
    return found


def size_class(n: Column) -> Column:
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.log(F.lit(CLASS_RATIO))).cast("int")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may have a Jaccard similarity of ``percent`` or more, none left out.

    ``sets`` has (id, c, kind, element), and n, the size of the set, if that is known: the
    distinct elements of each set of an id, of which only sets of one kind are compared, and
    ids of one component c not at all. Elements are
    put in order, those first that no other component has, then from the rarest to the most
    common. If two sets are so alike, what both have from their first common element on must
    suffice for the overlap; so an element is a key of a set only at places, and for
    partners of sizes, where that can be. Elements that many sets share stand last and are
    keys of none but sets that consist of little else.
    """
    t = percent / 100
    whole = Window.partitionBy("id", "kind")
    # Joins and groups by one number sort several times faster than by a kind and an element.
    hashed = sets.withColumn("kind", F.xxhash64("kind")).withColumn("element", F.xxhash64("kind", "element"))
    known = stored(hashed if "n" in sets.columns else hashed.withColumn("n", F.count(F.lit(1)).over(whole)), "set-elements")
    spread = stored(
        known.groupBy("element").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.count(F.lit(1)).alias("f"))
        .filter("least <> most").select("element", "f"), "common-elements",
    )
    # Elements of no other component come first; counted from the end, they need not be there.
    order = whole.orderBy(F.col("f").desc(), F.col("element").desc())
    placed = known.join(spread, "element").withColumn("left", F.row_number().over(order))
    # What is left from this place on, and the largest partner for which it suffices.
    left = F.col("left")
    most = F.least(left * (1 + t) / t - F.col("n"), F.col("n") / t) + 1e-6
    keyed = placed.filter(left >= t * F.col("n") - 1e-9).withColumns({
        "own": size_class(F.col("n")), "partner": F.explode(F.sequence(size_class(F.floor(F.col("n") * t)), F.greatest(size_class(most), size_class(F.floor(F.col("n") * t))))),
    })
    # Sets that meet by chance in the hash of a key are told apart by whoever checks the pairs.
    key = F.xxhash64("element", F.least("own", "partner"), F.greatest("own", "partner")).alias("key")
    keys = stored(keyed.select(key, "id", "c", F.col("n").cast("int").alias("n"), "left"), "prefix-keys")
    other = keys.select("key", *(F.col(x).alias(f"{x}_b") for x in ("id", "c", "n", "left")))
    need = (F.col("n") + F.col("n_b")) * t / (1 + t) - 1e-6
    fits = (F.col("id") < F.col("id_b")) & (F.col("c") != F.col("c_b")) & (F.least("left", "left_b") >= need) & (F.least("n", "n_b") >= t * F.greatest("n", "n_b") - 1e-6)
    pairs = stored(keys.join(other, "key").filter(fits).select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct(), "prefix-pairs")
    discard(known, spread, keys)
    return pairs


def link(pairs: DataFrame, large: DataFrame, verify: Callable[[DataFrame], DataFrame], elements: Callable[[DataFrame], DataFrame],
         percent: int, possible: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(id, component) of the ids that some verified pair links.

    ``pairs`` and ``large`` are what ``candidate_pairs`` gives; ``verify`` keeps the similar
    ones of pairs (a, b). Members of one component need no check among themselves: of the
    small buckets' pairs one for each id comes first, then those that still lie in different
    components. Members of a large bucket meet one of them chosen at random, twice: each
    is in many buckets, and near copies, however many, are joined by these few pairs. Whoever
    is left in a bucket of several components is unlike most of it; these ids are compared by
    ``prefix_pairs`` over their ``elements`` (id, kind, element), so that a bucket of
    unlike members costs no pairs among them. Ids that no chain of such buckets joins never
    met and are not compared: how rare an element is is counted among those that did, so that
    what sets a copy apart from the rest of its family comes first, however common elsewhere.
    """
    components: DataFrame | None = None

    def joined(found: DataFrame) -> DataFrame | None:
        found = stored(found, "verified")
        if found.isEmpty():
            return components
        now = connected_components(found) if components is None else _joined(components, found)
        discard(found)
        return now

    rows = _open(large, None)
    for turn in range(TURNS):
        if turn:
            ends = _labelled(_labelled(pairs, components, "a", "c"), components, "b", "d")
            chosen = ends.filter("c <> d").select("a", "b")
        else:
            chosen = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        components = joined(verify(chosen.unionByName(_with_pivots(rows, turn, possible)).distinct()))
        before, rows = rows, _open(rows.drop("c"), components)
        discard(before)
    rest = stored(rows.select("id", "c").distinct(), "rest")
    if not rest.isEmpty():
        families = _families(rows)
        sets = elements(rest.select("id")).join(rest.join(families, "c"), "id")
        sets = sets.withColumn("kind", F.struct("family", "kind")).drop("family")
        components = joined(verify(prefix_pairs(sets, percent)))
        discard(families)
    discard(rows, rest)
    return _none(pairs) if components is None else components


def _none(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).filter(F.lit(False))


def _joined(components: DataFrame, found: DataFrame) -> DataFrame:
    """The components after further links, found between members of different ones."""

    def root(end: str) -> DataFrame:
        return components.select(F.col("id").alias(end), F.col("component").alias(f"c_{end}"))

    ends = found.join(root("a"), "a", "left").join(root("b"), "b", "left")
    above = connected_components(ends.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")))
    above = above.select(F.col("id").alias("component"), F.col("component").alias("top"))
    lone = above.join(components.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("id"), F.col("top").alias("component"))
    moved = components.join(above, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    return stored(moved.unionByName(lone), "joined")


"""Small tables with the awkward cases, and brute-force versions of the operators."""

import random
import re
from collections import Counter, defaultdict

WHITE = r"[\x20\x09-\x0D]+"
SYLLABLES = "an be co di el fu ga ho in ju ke lo mi no or pa".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def documents(seed=3):
    """(doc_id, text, lang): copies, near copies, shared passages, periodic text, null, empty, very long."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.randint(60, 200))) + "." for _ in range(12)]
    texts = [None, "", " \t\n", "one two", "one  two", "Solo", *base, base[0], base[0].replace(" ", "  "), base[1].upper()]
    for text in base[:6]:
        changed = text.split()
        for i in rng.sample(range(len(changed)), 3):
            changed[i] = "changed"
        texts.append(" ".join(changed))
    passage = " ".join(words(rng, 110))
    texts += [f"{base[k]}\n{passage}\n{base[k + 1]}" for k in (7, 8, 9)]
    texts += ["ab cd " * 300, "x" * 5000, " ".join(words(rng, 6000)), "same line\n" * 40]
    return [(i, t, "en") for i, t in enumerate(texts)]


def frame(spark, rows):
    """As a table with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.selectExpr("*", "'x' AS key", "1 AS node", "2 AS id", "3 AS slot", "4 AS component", "5 AS n")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, n=5):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in re.split(WHITE, low) if x]
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_components(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


def repeated(rows, length=400):
    """(bytes, removed, runs, what is left) of each text when all repeated strings go."""
    bodies = {i: (t or "").encode() for i, t, _ in rows}
    seen = Counter(b[k:k + length] for b in bodies.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in bodies.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out


def line_components(rows, percent=75, width=5):
    """The first place of the line that stays for each line that is not blank."""
    first, place = {}, {}
    for i, t, _ in rows:
        for k, line in enumerate((t or "").split("\n")):
            normal = line.strip(" \t\n\v\f\r").lower()
            if normal:
                place[i, k] = normal
                first.setdefault(normal, (i, k))
    sets = {n: {n[k:k + width] for k in range(max(1, len(n) - width + 1))} for n in first}
    by_place = {first[n]: s for n, s in sets.items()}
    links = [(a, b) for a in by_place for b in by_place if a < b and 100 * len(by_place[a] & by_place[b]) >= percent * len(by_place[a] | by_place[b])]
    found = components(by_place, links)
    return {p: found[first[n]] for p, n in place.items()}


def pieces_by_document(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    return by

"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

A disguised word (look-alike characters, letters set apart, letters repeated) is a lattice
of the letters each character may stand for. The Viterbi path through it under a character
trigram model of the corpus restores the word. The restored words are scored by a logistic
model over a lexicon of words and word beginnings learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayscope.llm.common import WHITE, discard, few_rows, stored

#: Labelled rows the model is fitted on at most: those of the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
#: Features the model keeps at most.
LEXICON = 4096
#: Log-likelihood gain a feature must have: about one chance in a million of coming by luck.
LEAST_GAIN = 12.0
#: Lengths of the word beginnings that are features beside the whole word.
BEGINNINGS = range(3, 8)
#: One label in so many is held out (crc32 of the id as text, remainder 0).
FOLDS = 5

# The letters a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Characters that may stand between the letters of a word to set them apart.
BETWEEN = ".-_*~'`,/\\ "
#: Cost (negative log chance) of a look-alike, of a separator, of dropping anything else.
LOOK_ALIKE, SEPARATOR, DROPPED = 1.0, 0.5, 6.0
#: Cost of a space inside a word beside two letters or more: of all such spaces few are.
SPACED = 2.0

EDGE, OTHER, CLASSES = 0, 27, 28
_CLASS = np.full(256, EDGE, np.int32)
_CLASS[np.arange(ord("a"), ord("z") + 1)] = np.arange(1, 27)
_CLASS[np.arange(ord("A"), ord("Z") + 1)] = np.arange(1, 27)
_CLASS[128:] = OTHER

_DECORATION = re.compile(r"^[^\w$@!|+(€£]+|[^\w$@!|+€£]+$|(?<=\w)([^\w\s])\1+$")
#: Marks after a word that are decoration whatever stands before them.
_TRAILING = b".,;:?"
_TRIPLE = re.compile(r"(.)\1\1")
#: Characters of the tokens that may be letters or chunks of a word set apart.
CHUNK = 5
_CHUNKS = re.compile(r"(?<![^%s])[^%s]{1,%d}(?:[%s]+[^%s]{1,%d})+(?![^%s])" % (WHITE, WHITE, CHUNK, WHITE, WHITE, CHUNK, WHITE))
#: In restored chunks: where a space was a separator.
_JOINED = "\t"


def _class_of(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else OTHER


class CharacterModel:
    """Trigram model over letter classes: edge of a word, a to z, any other letter."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        pairs = table.sum(axis=0)
        back_off = (pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 0.5 * CLASSES)
        seen = table.sum(axis=2, keepdims=True)
        # Ten pseudo-counts spread as the bigram model says.
        self.cost = -np.log((table + 10 * back_off[None]) / (seen + 10))
        self.rows = self.cost.tolist()


def trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """How often each class trigram occurs, every text between edges."""
    total = np.zeros(CLASSES**3, np.int64)
    for text in texts:
        c = _CLASS[np.frombuffer(f"  {text} ".encode("utf-8", "surrogatepass"), np.uint8)]
        total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
    return total


def disguised(word: str) -> bool:
    """Whether the word's lattice has more than one path: it holds a letter, and a character
    that may stand for another, a separator inside, or a letter three times in a row."""
    if word.isalpha():
        return _TRIPLE.search(word) is not None
    return any(c.isalpha() for c in word)


def restore(word: str, model: CharacterModel) -> str:
    """The likeliest letters behind a disguised word (lower case).

    A space is the edge of a word or, as a tab in the result, a separator.
    """
    cost = model.rows
    # State: the two last classes. Value: cost so far, letters so far.
    paths: dict[tuple[int, int], tuple[float, str]] = {(EDGE, EDGE): (0.0, "")}
    previous, run = "", 0
    for i, c in enumerate(word):
        run = run + 1 if c == previous else 1
        previous = c
        options: list[tuple[str, float]] = []
        if c == " ":
            single = word[max(0, i - 2) : i - 1].strip() == "" == word[i + 2 : i + 3].strip()
            options.extend(((" ", 0.0), (_JOINED, SEPARATOR if single else SPACED)))
        elif c.isalpha():
            options.append((c, 0.0))
            if run > 1:
                options.append(("", 0.2 if run > 2 else 1.5))
        else:
            options.extend((letter, LOOK_ALIKE) for letter in STANDS_FOR.get(c, ""))
            options.append(("", SEPARATOR if c in BETWEEN else 0.2 if run > 1 else DROPPED))
        reached: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (so_far, letters) in paths.items():
            for letter, price in options:
                if letter == _JOINED:
                    state, value = (a, b), (so_far + price, letters + letter)
                elif letter:
                    k = EDGE if letter == " " else _class_of(letter)
                    state, value = (b, k), (so_far + price + cost[a][b][k], letters + letter)
                else:
                    state, value = (a, b), (so_far + price, letters)
                if state not in reached or value < reached[state]:
                    reached[state] = value
        paths = reached
    return min((so_far + cost[a][b][EDGE], letters) for (a, b), (so_far, letters) in paths.items())[1]


_REPEATED = re.compile(r"(.)\1+")


class Beginnings:
    """A trie of what features begin with, run along the characters of set-apart words.

    ``may_begin`` says whether some path of the lattice from here may spell a feature:
    letters stay in order, repeated ones count once, other characters are dropped or stand
    for the letters they look like. Where it says no, decoding could find nothing.
    """

    def __init__(self, features: Iterable[str], most: int = 400_000):
        self.root: dict = {}
        for feature in features:
            node = self.root
            for letter in _REPEATED.sub(r"\1", feature[1:]):
                node = node.setdefault(letter, {})
            node[""] = {}
        self.most = most
        self.tokens: dict[str, bool] = {}

    def _step(self, nodes: list, c: str) -> list | None:
        """The nodes after a character, None where a feature ends."""
        if c == " ":
            return nodes
        letters, now = (c, []) if c.isalpha() else (STANDS_FOR.get(c, ""), list(nodes))
        for letter in letters:
            for node, last in nodes:
                if letter == last:
                    now.append((node, last))
                child = node.get(letter)
                if child is not None:
                    if "" in child:
                        return None
                    now.append((child, letter))
        return now

    def _alive(self, text: str) -> bool:
        nodes: list | None = [(self.root, "")]
        for c in text:
            nodes = self._step(nodes, c)
            if not nodes:
                return nodes is None
        return True

    def may_begin(self, tokens: list[str], at: int) -> bool:
        """Whether a feature may be spelt from the beginning of token ``at``."""
        token = tokens[at]
        alive = self.tokens.get(token)
        if alive is None:
            if len(self.tokens) >= self.most:
                self.tokens.clear()
            alive = self.tokens[token] = self._alive(token)
        if not alive:
            return False
        nodes: list | None = [(self.root, "")]
        for c in " ".join(tokens[at:]):
            nodes = self._step(nodes, c)
            if not nodes:
                return nodes is None
        return False


class Words(dict):
    """What a word of the text stands for, kept for the words seen lately.

    With ``features``, the only ones of interest, set-apart words that can spell none of
    them are not decoded.
    """

    def __init__(self, model: CharacterModel, use, most: int = 400_000, features: Iterable[str] | None = None):
        super().__init__()
        self.model, self.use, self.most = model, use, most
        self.beginnings = None if features is None else Beginnings(features, most)
        #: First three letters of the features of interest.
        self.starts = None if features is None else {f[1:4].encode("utf-8", "surrogatepass") for f in features}
        self.chunks: dict[str, tuple] = {}
        self.junctions: dict[str, bool] = {}

    def __missing__(self, word: bytes):
        if len(self) >= self.most:
            self.clear()
        if self.starts is not None:
            # A plain word keeps its first letters, whatever repeats after them.
            letters = word.rstrip(_TRAILING)
            if len(letters) > 2 and letters.isalpha() and letters[0] != letters[1] != letters[2] and letters[:3] not in self.starts:
                self[word] = ()
                return ()
        plain = _DECORATION.sub("", word.decode("utf-8", "surrogatepass").lower())
        value = self[word] = self.use(restore(plain, self.model) if disguised(plain) else plain)
        return value


    def may_join(self, a: str, b: str) -> bool:
        """Whether a path through the space between two tokens may be cheaper than a word edge.

        Between tokens of two letters and more the trigrams across the space decide alone.
        The model does not tell letters beyond a to z apart: of these, only single ones join.
        """
        if a[-1].isalpha() and b[0].isalpha() and _class_of(a[-1]) == OTHER == _class_of(b[0]):
            return len(a) == len(b) == 1
        if len(a) < 2 or len(b) < 2 or not (a.isalpha() and b.isalpha()):
            return True
        key = a[-2:] + b[:2]
        found = self.junctions.get(key)
        if found is None:
            if len(self.junctions) >= self.most:
                self.junctions.clear()
            cost, (w, x, y, z) = self.model.rows, map(_class_of, key)
            edge = cost[w][x][EDGE] + cost[x][EDGE][y] + cost[EDGE][y][z]
            found = self.junctions[key] = cost[w][x][y] + cost[x][y][z] + SPACED < edge
        return found

    def joined(self, text: str | None) -> Iterator[tuple]:
        """What words stand for that were set apart by spaces, letter by letter or in chunks."""
        for run in _CHUNKS.findall((text or "").lower()):
            tokens = run.split()
            begins = range(len(tokens)) if self.beginnings is None else [k for k in range(len(tokens) - 1) if self.beginnings.may_begin(tokens, k)]
            if not begins:
                continue
            first = 0
            for i in range(1, len(tokens) + 1):
                if i < len(tokens) and self.may_join(tokens[i - 1], tokens[i]):
                    continue
                # A word of several tokens begins with one of them but the last.
                if i - first > 1 and any(first <= k < i - 1 for k in begins):
                    yield self.restored(" ".join(tokens[first:i]))
                first = i

    def restored(self, chunks: str) -> tuple:
        found = self.chunks.get(chunks)
        if found is None:
            if len(self.chunks) >= self.most:
                self.chunks.clear()
            words = restore(chunks, self.model).split(" ") if any(map(str.isalpha, chunks)) else ()
            found = self.chunks[chunks] = tuple(f for w in words if _JOINED in w for f in self.use(w.replace(_JOINED, "")))
        return found


def words_of(text: str | None) -> list[bytes]:
    """Words between white space; three or more single characters in a row also as one word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < 3:
        return words
    short = np.fromiter(map(len, words), np.int64, len(words)) == 1
    edges = np.flatnonzero(np.diff(np.concatenate([[False], short, [False]]).astype(np.int8)))
    joined = [b"".join(words[a:b]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= 3]
    return words + joined


def features_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings."""
    if not word:
        return ()
    return (f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n))


class Model:
    """Lexicon, weights and bias of the logistic score."""

    def __init__(self, lexicon: list[str], weights: np.ndarray, bias: float):
        self.index = {f: i for i, f in enumerate(lexicon)}
        self.weights, self.bias = weights, bias

    def known(self, word: str) -> tuple[int, ...]:
        return tuple(i for i in map(self.index.get, features_of(word)) if i is not None)


def held_by(text: str | None, known: Words) -> set:
    """What the words of a document stand for, each once: those between white space and those set apart."""
    found: set = set()
    for held in set(filter(None, map(known.__getitem__, words_of(text)))):
        found.update(held)
    for held in known.joined(text):
        found.update(held)
    return found


def present(text: str | None, known: Words) -> list[int]:
    """The features that occur in a document, each once."""
    return sorted(held_by(text, known))


def fit(rows: list[list[int]], labels: np.ndarray, n_features: int, steps: int = 200, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression over sets of features, by gradient steps with momentum (Adam)."""
    n = len(rows)
    weights, positive = np.zeros(n_features + 1), float(labels.sum())
    weights[-1] = math.log((positive + 0.5) / (n - positive + 1.5))
    if not n or not n_features:
        return weights[:-1], weights[-1]
    lengths = np.array([len(r) for r in rows])
    columns = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
    row = np.repeat(np.arange(n), lengths)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = np.bincount(row, weights[columns], n) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        gradient = np.append(np.bincount(columns, error[row], n_features), error.sum()) / n
        gradient[:-1] += ridge * weights[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        weights -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], weights[-1]


def held_out() -> Column:
    """Rows labels are not learned from; those without id among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def character_model(docs: DataFrame) -> CharacterModel:
    """Counted over every text; a table of 28^3 counts whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in few_rows(batches):
            total += trigram_counts(t for t in batch.column(0).to_pylist() if t)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["code", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES**3, np.int64)
    for code, n in counted.collect():
        counts[code] = n
    return CharacterModel(counts)


def sample(docs: DataFrame, labels: DataFrame, label: str, usable, rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents, by the smallest hashes of their ids."""
    chosen = (
        labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # At most ``rows`` ids and labels are broadcast, and only their texts move; of rows that
    # share an id the smallest text counts.
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, language: CharacterModel, rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and weights from the labelled sample."""
    labelled = stored(sample(docs, labels, "toxic", ~held_out(), rows), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Words(language, features_of)
        seen = (Counter(), Counter())
        for batch in few_rows(batches):
            for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                seen[label != 0].update(held_by(text, features))
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.record_batch([
            pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([seen[0][f] for f in names], pa.int64()),
        ], names=["feature", "pos", "neg"])

    totals = labelled.agg(F.sum((F.col("label") != 0).cast("int")).alias("pos"), F.count(F.lit(1)).alias("n")).first()
    positive, n = totals["pos"] or 0, totals["n"]
    if not positive or positive == n:
        return Model([], np.zeros(0), math.log((positive + 0.5) / (n - positive + 1.5)))
    # Log-likelihood ratio of a feature's two counts against the share of positive rows.
    share = positive / n
    here = F.col("pos") + F.col("neg")
    gain = (
        F.when(F.col("pos") > 0, F.col("pos") * F.log(F.col("pos") / (here * share))).otherwise(0.0)
        + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (here * (1 - share)))).otherwise(0.0)
    )
    counted = labelled.mapInArrow(count, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    best = counted.filter(gain >= LEAST_GAIN).orderBy(gain.desc(), "feature").limit(LEXICON)
    lexicon = [r["feature"] for r in best.select("feature").collect()]
    draft = Model(lexicon, np.zeros(len(lexicon)), 0.0)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(language, draft.known, features=draft.index)
        for batch in few_rows(batches):
            found = [present(t, known) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "label", "found"])

    # Bounded: ``rows`` rows of at most LEXICON small numbers.
    table = labelled.mapInArrow(look_up, "doc_id long, label int, found array<int>").orderBy("doc_id").toArrow()
    discard(labelled)
    answers = (np.array(table.column("label").to_pylist()) != 0).astype(float)
    return Model(lexicon, *fit(table.column("found").to_pylist(), answers, len(lexicon)))


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic) and predicted of every document.

    The character model covers every text of ``docs``; labels come from at most ``rows``
    rows of ``labels``, never from held-out ones, a document with several labels counting
    as toxic if one says so. Only the text enters the score. Null and empty texts score by
    the share of toxic labels alone; so does everything where no label, or only one kind of
    label, can be used. Rows that repeat are scored each; a row without id counts as held
    out. An empty table gives an empty result; other columns are not read. The same rows give
    the same scores however they are partitioned.
    """
    language = character_model(docs)
    model = train(docs, labels, language, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(language, model.known, features=model.index)
        for batch in few_rows(batches):
            z = np.array([model.weights[present(t, known)].sum() + model.bias for t in batch.column(2).to_pylist()], float)
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64()),
            ], names=["doc_id", "held_out", "score"])

    scored = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return scored.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.

    Null and empty texts score by the share of toxic labels alone, and stay where that is
    under a half; rows that repeat, with or without id, stay or go together. Every text is
    read whole. An empty table stays empty; no column is added, so no name clashes.
    """
    language = character_model(docs)
    model = train(docs, labels, language, rows)

    @F.pandas_udf("boolean")
    def toxic(texts):
        import pandas as pd

        known = Words(language, model.known, features=model.index)
        return pd.Series([bool(model.weights[present(t, known)].sum() + model.bias >= 0) for t in texts], dtype=bool)

    return docs.filter(~toxic(F.col("text").cast("string")))

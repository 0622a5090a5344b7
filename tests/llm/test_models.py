"""The learned operators' parts against brute force: Viterbi paths, pruned decoding, vectors, pooling."""

import itertools
import random

import numpy as np
import pytest

from delayscope.llm import quality, toxicity
from tests.llm.fixtures import words

TEXTS = [" ".join(words(random.Random(k), 60)) + " stupid idiot trash people are kind" for k in range(40)]


@pytest.fixture(scope="module")
def language():
    return toxicity.CharacterModel(toxicity.trigram_counts(TEXTS))


def cheapest(word, model):
    """Least cost over all paths of the lattice, tried one by one."""
    choices, previous, run = [], "", 0
    for i, c in enumerate(word):
        run = run + 1 if c == previous else 1
        previous = c
        if c == " ":
            single = word[max(0, i - 2) : i - 1].strip() == "" == word[i + 2 : i + 3].strip()
            choices.append([(" ", 0.0), ("", toxicity.SEPARATOR if single else toxicity.SPACED)])
        elif c.isalpha():
            choices.append([(c, 0.0)] + ([("", 0.2 if run > 2 else 1.5)] if run > 1 else []))
        else:
            drop = toxicity.SEPARATOR if c in toxicity.BETWEEN else 0.2 if run > 1 else toxicity.DROPPED
            choices.append([(x, toxicity.LOOK_ALIKE) for x in toxicity.STANDS_FOR.get(c, "")] + [("", drop)])
    best = (float("inf"), "")
    for path in itertools.product(*choices):
        letters = "".join(x for x, _ in path)
        a = b = toxicity.EDGE
        cost = sum(price for _, price in path)
        for x in letters + " ":
            k = toxicity.EDGE if x == " " else toxicity._class_of(x)
            cost += model.rows[a][b][k]
            a, b = b, k
        best = min(best, (cost, letters))
    return best


def spelt(word, letters, model):
    """Whether the restored letters are those of a cheapest path, ties aside."""
    return cheapest(word, model)[1] == letters.replace("\t", "")


@pytest.mark.parametrize("word", ["stupid", "5tup1d", "s.t.u.p.i.d", "s t u p i d", "stuuupid", "tr@$h", "st upid", "id10t !", "a s t u p", "p30pl3"])
def test_restored_letters_are_those_of_the_cheapest_path(word, language):
    assert spelt(word, toxicity.restore(word, language), language)


def test_pruned_decoding_finds_the_same_features(language):
    rng = random.Random(7)
    model = toxicity.Model(["=stupid", "^stu", "^idi", "=trash", "^tras", "=as", "^kind"], np.zeros(7), 0.0)
    marks = ["", "", "", " ", " ", ".", "-", "!", "3", "1", "5", "@", "  "]
    texts = []
    for _ in range(400):
        text = " ".join(rng.choice(["stupid", "idiot", "trash", "kind", "a", "of", "as", "in", "assist"]) for _ in range(rng.randint(1, 12)))
        texts.append("".join(c + rng.choice(marks) if rng.random() < 0.5 else c for c in text))
    plain = toxicity.Words(language, model.known)
    pruned = toxicity.Words(language, model.known, features=model.index)
    found = [toxicity.present(t, plain) for t in texts]
    assert [toxicity.present(t, pruned) for t in texts] == found and sum(map(bool, found)) > 100


def test_context_sums_and_pooling_by_hand():
    buckets = quality.Buckets()
    docs = [quality.tokens(t, buckets) for t in (TEXTS[0], "one, two three.", "", "same same same")]
    total = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for ids in docs:
        for i, here in enumerate(ids):
            for j in range(max(0, i - quality.AROUND), min(len(ids), i + quality.AROUND + 1)):
                if i != j:
                    for k in range(quality.ENTRIES):
                        total[here, quality._PLACE[ids[j], k]] += quality._SIGN[ids[j], k]
    assert np.array_equal(quality.context_sums(docs), total)
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    for ids, row in zip(docs, quality.pooled(docs, vectors)):
        want = np.concatenate([vectors[ids].mean(axis=0), vectors[ids].std(axis=0)]) if len(ids) else np.zeros(2 * quality.DIMENSIONS)
        assert np.allclose(row, want, atol=1e-4)


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_scores_do_not_depend_on_partitions(spark, operator):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, 40)) + (" stupid trash idiot" if i % 3 == 0 else " kind people")) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(0, 160, 2)], "doc_id long, quality int, toxic int")
    scores = [
        {r["doc_id"]: r["score"] for r in operator.score(d, lab).collect()}
        for d, lab in ((docs.repartition(3), labels), (docs.orderBy("text").coalesce(2), labels.repartition(5, "toxic")))
    ]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9) and len(set(scores[0].values())) > 1

"""Near duplicates by the exact index: no pair below it goes, and hardly one at or above it stays."""

import itertools
import random

import numpy as np
import pytest

from factline.llm import similarity, simhash


def index(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def groups(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[find(a)] = find(b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("chunk", [2048, 4])
def test_borderline_pairs(spark, chunk):
    """Texts around the least index, in chains and in groups of some copies with some that only nearly are."""
    r = random.Random(7)
    texts = []
    for _ in range(40):
        base = [f"w{r.randrange(5000)}" for _ in range(200)]
        for _ in range(r.choice([2, 4, 6])):
            words = list(base)
            for at in r.sample(range(200), r.choice([0, 1, 2, 2, 3, 4, 5, 6])):
                words[at] = f"n{r.randrange(10**6)}"
            texts.append(" ".join(words))
    sets = list(map(shingles, texts))
    found = {(a, b): index(sets[a], sets[b]) for a, b in itertools.combinations(range(len(texts)), 2)}
    near = [p for p, j in found.items() if j >= 0.8]
    assert len(near) > 40 and sum(0.7 <= j < 0.8 for j in found.values()) > 20
    label = groups(len(texts), near)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    stays = {x.doc_id for x in simhash.drop_near_duplicates(df, chunk=chunk).collect()}
    want = {min(i for i, x in enumerate(label) if x == g) for g in set(label)}
    assert want <= stays  # nothing goes without a link
    assert len(stays - want) <= 0.02 * len(near)


def test_links_that_other_edges_stand_for(spark):
    """A true link between two texts that candidates connect only through a third, which is like neither."""
    sets = {1: range(0, 100), 2: range(1, 101), 3: range(30, 130), 4: range(1000, 1010)}
    nodes = spark.createDataFrame([(k, 0) for k in sets], "node long, f0 long")
    given = spark.createDataFrame([(k, np.array(v, np.uint32).tobytes()) for k, v in sets.items()], "node long, set binary")
    edges = spark.createDataFrame([(1, 3), (3, 2), (4, 3)], "a long, b long")
    roots = similarity.verified_components(edges, nodes, lambda some: given.join(some, "node", "left_semi"), ["f0"], 64, chunk=2)
    assert {(x.node, x.root) for x in roots.collect()} == {(1, 1), (2, 1)}


def test_similar():
    a = np.arange(8, dtype=np.uint32)
    assert similarity.similar(a, a[:0].copy()) is False and similarity.similar(a[:0], a[:0])
    assert similarity.similar(np.arange(9), np.arange(1, 10)) and not similarity.similar(np.arange(8), np.arange(1, 9))

"""Counted pairs, their information, and eigenvectors against numpy."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import cooccurrence as co


@pytest.fixture(scope="module")
def sequences():
    draw = random.Random(4)
    return [[f"t{min(draw.randrange(14), draw.randrange(14))}" for _ in range(draw.choice([0, 1, 2, 9, 40]))] for _ in range(60)]


def brute(sequences, window):
    out = Counter()
    for own in sequences:
        for i, a in enumerate(own):
            for b in own[i + 1 : i + 1 + window]:
                out[a, b] += 1
                out[b, a] += 1
    return out


def information(counts):
    margin = Counter()
    for (a, _), n in counts.items():
        margin[a] += n
    total = sum(margin.values())
    weights = {p: float(np.log(n * total / (margin[p[0]] * margin[p[1]]))) for p, n in counts.items()}
    return {p: w for p, w in weights.items() if w > 0}


@pytest.mark.parametrize("window", [1, 3])
def test_pairs(spark, sequences, window):
    wanted = brute(sequences, window)
    lists = spark.createDataFrame([(i, own) for i, own in enumerate(sequences)], "id long, words array<string>")
    places = lists.select("id", F.posexplode("words").alias("pos", "word")).repartition(5)
    for found in (co.list_pairs(lists, "words", window), co.position_pairs(places, ["id"], "pos", "word", window)):
        assert {(r.a, r.b): r.n for r in found.collect()} == wanted


def test_information_with_hot_tokens(spark, sequences):
    counts = brute(sequences, 2)
    table = spark.createDataFrame([(*p, n) for p, n in counts.items()], "a string, b string, n long")
    wanted = information(counts)
    for rows in (3, 10**6):
        found = {(r.a, r.b): r.weight for r in co.positive_information(table, rows).collect()}
        assert found.keys() == wanted.keys() and all(abs(found[p] - wanted[p]) < 1e-12 for p in wanted)


@pytest.mark.parametrize("limit", [co.LOOKUP_BYTES, 0])
def test_vectors_are_leading_eigenvectors(spark, sequences, limit):
    weights = information(brute(sequences, 2))
    names = sorted({a for a, _ in weights})
    dense = np.array([[weights.get((a, b), 0.0) for b in names] for a in names])
    table = spark.createDataFrame([(*p, 1, w) for p, w in weights.items()], "a string, b string, n long, weight double").repartition(4)
    size = len(names)
    rounds = 1 if limit == 0 else 4
    found = {r.token: np.array(r.vector) for r in co.train_vectors(table, size, rounds, limit).collect()}
    got = np.array([found[n] for n in names])
    values, vectors = np.linalg.eigh(dense)
    # with all directions kept, products of vectors are those of |W|
    assert np.allclose(got @ got.T, vectors @ np.diag(np.abs(values)) @ vectors.T, atol=1e-6)
    if limit:
        few = {r.token: np.array(r.vector) for r in co.train_vectors(table, 3, 6, limit).collect()}
        top = np.argsort(-np.abs(values))[:3]
        some = np.array([few[n] for n in names])
        assert some.shape[1] == 3
        assert np.allclose(some @ some.T, vectors[:, top] @ np.diag(np.abs(values[top])) @ vectors[:, top].T, atol=1e-2)


def test_nothing(spark):
    empty = spark.createDataFrame([], "a string, b string, n long")
    assert co.train_vectors(co.positive_information(empty)).count() == 0

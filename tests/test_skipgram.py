"""Word vectors trained in parts: the code tree, one part's steps, and the mean of the parts."""

import heapq
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recspark.operators import embeddings, skipgram


def _plain_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_codes_from_ranks_are_a_huffman_code():
    rng = random.Random(1)
    for _ in range(100):
        counts = sorted((rng.choice([1, 1, 2, 3, rng.randrange(1, 200)]) for _ in range(rng.randrange(2, 60))), reverse=True)
        lengths = skipgram.code_lengths(Counter(counts).items())
        codes, size = skipgram.codes_of(np.arange(len(counts)), lengths)
        assert sum(n * s for n, s in zip(counts, size)) == _plain_cost(counts)
        words = [format(c, "b").zfill(s) for c, s in zip(codes.tolist(), size.tolist())]
        assert not any(a != b and b.startswith(a) for a in words for b in words)
        names, way, bits = skipgram.paths_of(codes, size)
        for i, word in enumerate(words):
            assert [int(b) for b in bits[i, : len(word)]] == [int(c) for c in word]
            assert names[way[i, : len(word)]].tolist() == [int("1" + word[:d], 2) for d in range(len(word))]
    assert skipgram.code_lengths([(7, 1)]) == {0: 1}


def test_one_step_is_the_gradient_of_each_pair(monkeypatch):
    monkeypatch.setattr(skipgram, "STEP", 1)
    counts = [5, 3, 2, 2, 1]
    codes, size = skipgram.codes_of(np.arange(5), skipgram.code_lengths(Counter(counts).items()))
    names, way, bits = skipgram.paths_of(codes, size)
    rng = np.random.default_rng(0)
    first, inner = rng.normal(size=(5, 4)).astype(np.float32), rng.normal(size=(len(names), 4)).astype(np.float32)
    words, sentence = np.array([0, 3, 4, 1, 2, 0]), np.array([1, 1, 1, 1, 2, 2])
    inputs, outputs = first.copy(), inner.copy()
    touched = skipgram.train(words, sentence, inputs, outputs, (way, bits, size), 1, rng, (0, 1, 1))
    x, y = first.astype(float), inner.astype(float)
    for at in range(len(words)):
        contexts = [c for c in (at - 1, at + 1) if 0 <= c < len(words) and sentence[c] == sentence[at]]
        # the contexts of one place see the same vectors
        x_new, y_new = x.copy(), y.copy()
        for c in contexts:
            for node, bit in zip(way[words[at], : size[words[at]]], bits[words[at]]):
                product = x[words[c]] @ y[node]
                g = skipgram.RATE * (1 - bit - 1 / (1 + np.exp(-product)))
                x_new[words[c]] += g * y[node]
                y_new[node] += g * x[words[c]]
        x, y = x_new, y_new
    assert np.allclose(inputs, x, atol=1e-5) and np.allclose(outputs, y, atol=1e-5)
    assert touched.all()


def test_the_mean_leaves_out_parts_that_changed_nothing():
    rows = pa.table({"id": [3, 1, 3, 2, 3], "token": ["c", "a", "c", "b", "c"], "touched": [True, False, True, True, False], "vector": skipgram.vectors_column(np.array([[1, 2], [7, 8], [3, 6], [5, 5], [9, 9]], np.float32))})
    assert skipgram.mean_rows(rows, 2).to_pylist() == [{"id": 1, "token": "a", "vector": [7, 8]}, {"id": 2, "token": "b", "vector": [5, 5]}, {"id": 3, "token": "c", "vector": [2, 4]}]


@pytest.mark.parametrize(("parts", "iterations"), [(1, 2), (5, 1), (3, 3)])
def test_training_keeps_all_words_and_brings_none_to_the_driver(spark, parts, iterations):
    rng = random.Random(3)
    rows = [([f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 9))],) for _ in range(80)]
    rows += [(["alone"],), ([],), (None,), ([None, "w1", None],), ([f"w{i % 40}" for i in range(2500)],)]
    counts = Counter(w for (row,) in rows for w in row or [])
    sentences = spark.createDataFrame(rows, "w array<string>")
    vectors = embeddings.train_vectors(sentences, "w", size=6, window=2, min_count=2, partitions=parts, iterations=iterations)
    plan = vectors._jdf.queryExecution().toString()
    assert "LocalTableScan" not in plan and "ExistingRDD" not in plan and "LocalRelation" not in plan
    found = vectors.collect()
    assert Counter(r["token"] for r in found) == Counter(w for w, n in counts.items() if n >= 2)
    assert all(len(r["vector"]) == 6 and np.isfinite(r["vector"]).all() for r in found)
    assert dict(vectors.dtypes)["vector"] == "array<double>"
    assert vectors.where(F.size("vector") != 6).count() == 0


def test_training_without_a_word_is_an_error(spark):
    with pytest.raises(ValueError, match="no word"):
        embeddings.train_vectors(spark.createDataFrame([(["a"],)], "w array<string>"), "w", min_count=2)


def test_a_word_never_beside_another_keeps_its_first_numbers(spark):
    sentences = spark.createDataFrame([(["a"],), (["a"],), (["b"],)], "w array<string>")
    found = {r["token"]: r["vector"] for r in embeddings.train_vectors(sentences, "w", size=3, partitions=2).collect()}
    expected = skipgram.first_vectors(np.array([0, 1]), 3, 42)
    assert np.allclose(found["a"], expected[0]) and np.allclose(found["b"], expected[1])


def test_each_part_gets_its_own_task(spark):
    parts = spark.createDataFrame([(i,) for i in embeddings._labels(spark, 13)], "part long")
    tasks = parts.repartition(13, "part").select(F.spark_partition_id().alias("task"))
    assert tasks.distinct().count() == 13

"""Search by codes: the first pass in single floats loses no item, and costs little."""

import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from recspark.operators import search


def _cell(rng, items, queries, parts, codes, width, hot=0.0):
    books = rng.normal(size=(parts, codes, width)) * 0.1
    chosen = rng.integers(0, codes, (items, parts))
    chosen[rng.random(items) < hot] = chosen[0]
    words = np.concatenate([books[p][chosen[:, p]] for p in range(parts)], axis=1)
    own = (words * words).sum(1)
    v = pd.DataFrame({"item_id": rng.permutation(items), "item_vec": list(chosen), "own": own})
    q = rng.normal(size=(queries, parts * width))
    q /= np.sqrt((q * q).sum(1))[:, None]
    return SimpleNamespace(value=books), pd.DataFrame({"query_id": np.arange(queries), "query_vec": list(q), "distance": (q * q).sum(1)}), v, q, words


@pytest.mark.parametrize(
    ("items", "codes", "k", "hot"),
    [(1, 3, 5, 0), (40, 4, 5, 0), (2100, 2, 100, 0), (5000, 10, 5, 0), (5000, 10, 5, 0.5)],
)
@pytest.mark.parametrize("residual", [True, False])
def test_coded_cells_give_the_plain_ranking(items, codes, k, hot, residual):
    shared, queries, v, q, words = _cell(np.random.default_rng(items), items, 150, 4, codes, 4, hot)
    found = search._coded_cell(k, shared, residual)(queries, v)
    distances = np.round(np.maximum(((q[:, None] - words[None]) ** 2).sum(2), 0), 9)
    ids = v["item_id"].to_numpy()
    for i in range(len(q)):
        order = np.lexsort((ids, distances[i]))[:k]
        rows = found[found["query_id"] == i]
        assert rows["item_id"].tolist() == ids[order].tolist()
        assert np.allclose(rows["score"], distances[i][order], atol=1e-8)


def test_a_coded_pair_costs_less_than_its_gathers():
    rng = np.random.default_rng(0)
    shared, queries, v, q, _ = _cell(rng, 20_000, 640, 8, 10, 8)
    codes = np.stack(v["item_vec"].to_numpy())
    began = time.process_time()
    for start in range(0, len(q), search.STRIP):
        products = np.einsum("qpw,pcw->pqc", q[start : start + search.STRIP].reshape(-1, 8, 8), shared.value)
        scores = np.zeros((len(products[0]), len(codes)))
        for part, table in enumerate(products):
            scores += 2 * table[:, codes[:, part]]
    gathers = time.process_time() - began
    began = time.process_time()
    search._coded_cell(5, shared, False)(queries, v)
    assert time.process_time() - began < gathers / 2


def test_few_pairs_are_dealt_to_more_cells_than_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "SMALL_BLOCK", 10)
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(400)]
    v = spark.createDataFrame(rows, "vec_id long, e array<double>")
    centroids = spark.createDataFrame([(0, [1.0, 1.0]), (1, [5.0, 1.0])], "cluster int, centroid array<double>")
    lists = search.build_lists(v, "vec_id", "e", centroids)
    books = spark.createDataFrame([(0, 0, [1.0]), (0, 1, [5.0]), (1, 0, [0.0]), (1, 1, [2.0])], "part int, code int, word array<double>")
    seen = []
    plain = search._with_block_counts
    monkeypatch.setattr(search, "_with_block_counts", lambda *a: seen.append(plain(*a)) or seen[-1])
    found = search.quantised_topk(v, search.quantise(lists, books), books, centroids, 3, 2, False, "vec_id", "e")
    assert found.count() == 1200
    assert min(r.query_blocks for r in seen[0][0].select("query_blocks").distinct().collect()) > 1

"""Pooled and attended vectors of id lists, by lookup and by join, against numpy."""

import numpy as np
import pyarrow as pa
import pytest

from recspark.operators import pooling

LISTS = [
    (0, [1, 2, 0, 3], [0.5, 1.0, 9.0, -2.0], 1),
    (1, [0, 0], [1.0, 2.0], 2),
    (2, [], [], 3),
    (3, None, None, 3),
    (4, [99, 4], [3.0, 1.0], 4),
    (5, [2, 2, 2], [0.0, 0.0, 0.0], 77),
    (6, [3, None, 5], [1.0, 1.0, None], 0),
    (7, [99], [1.0], None),
    (8, [1 + i % 7 for i in range(300)], [i / 50 for i in range(300)], 5),
]
VECTORS = {i: np.array([i, (-1) ** i * 0.5, i * i / 10.0]) * (i > -1) + (0.25 if i == 0 else 0) for i in range(9)}


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.createDataFrame([(*r, "kept", 1.0) for r in LISTS], "key long, ids array<long>, w array<double>, target long, other string, mean double")
    given = [(i, [float(x) for x in v]) for i, v in VECTORS.items()] + [(None, [1.0, 1.0, 1.0]), (50, None)]
    return rows.repartition(3), spark.createDataFrame(given, "id long, vector array<float>").repartition(2)


def softmax(x):
    power = np.exp(np.array(x) - max(x))
    return power / power.sum()


def wanted(ids, weights, normalize):
    cells = [(i or 0, w or 0.0) for i, w in zip(ids or [], weights or [])]
    cells = [(i, w) for i, w in cells if i in VECTORS]
    real = [(i, w) for i, w in cells if i]
    vector = lambda i: np.float32(VECTORS[i]).astype(float)
    mean = np.mean([vector(i) for i, _ in cells], axis=0) if cells else None
    masked = np.mean([vector(i) for i, _ in real], axis=0) if real else None
    weighted = None
    if real:
        share = softmax([w for _, w in real]) if normalize else [w for _, w in real]
        weighted = sum(s * vector(i) for s, (i, _) in zip(share, real)) / len(real)
    return mean, masked, weighted


def close(got, want):
    assert (got is None) == (want is None)
    assert want is None or np.allclose(got, want)


@pytest.mark.parametrize("limit", [pooling.LOOKUP_BYTES, 0])
@pytest.mark.parametrize("normalize", [True, False])
def test_pooled(tables, limit, normalize):
    rows, vectors = tables
    found = pooling.pooled_lists(rows, ["key"], "ids", vectors, "w", normalize, limit)
    assert set(found.columns) == {*rows.columns, "masked_mean", "weighted_mean"}
    got = {r.key: r for r in found.collect()}
    assert set(got) == {r[0] for r in LISTS}
    for key, ids, weights, _ in LISTS:
        assert got[key].other == "kept"
        for name, want in zip(("mean", "masked_mean", "weighted_mean"), wanted(ids, weights, normalize)):
            close(got[key][name], want)


@pytest.mark.parametrize("limit", [pooling.LOOKUP_BYTES, 0])
def test_attended(tables, limit):
    rows, vectors = tables
    found = pooling.attended_lists(rows, ["key"], "ids", "target", vectors, limit)
    got = {r.key: r for r in found.collect()}
    assert set(got) == {r[0] for r in LISTS}
    for key, ids, _, target in LISTS:
        cells = [i or 0 for i in ids or [] if (i or 0) in VECTORS]
        if target not in VECTORS or not cells:
            assert got[key].weights is None and got[key].vector is None
            continue
        query = VECTORS[target]
        share = softmax([float(query @ VECTORS[i]) if i else -4294967295.0 for i in cells])
        assert np.allclose(got[key].weights, share, atol=1e-5)
        assert np.allclose(got[key].vector, sum(s * VECTORS[i] for s, i in zip(share, cells)), atol=1e-4)


def test_slices_hold_whole_lists(monkeypatch):
    monkeypatch.setattr(pooling, "POSITIONS", 2)
    lists = pa.array([r[1] for r in LISTS], pa.list_(pa.int64()))
    seen = []
    for first, count, row, ids in pooling.batches(lists):
        for k in range(count):
            seen.append(ids[row == k].tolist())
        assert first + count == len(seen)
    assert seen == [[i or 0 for i in r[1] or []] for r in LISTS]


def test_no_vector_crosses_a_shuffle(tables):
    rows, vectors = tables
    for found in (pooling.pooled_lists(rows, ["key"], "ids", vectors), pooling.attended_lists(rows, ["key"], "ids", "target", vectors)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "hashpartitioning" not in plan and "Generate" not in plan


def test_empty(spark, tables):
    rows, vectors = tables
    for limit in (pooling.LOOKUP_BYTES, 0):
        assert pooling.pooled_lists(rows.limit(0), ["key"], "ids", vectors, limit=limit).count() == 0
        none = pooling.pooled_lists(rows, ["key"], "ids", vectors.limit(0), limit=limit).collect()
        assert len(none) == len(LISTS) and {r.masked_mean for r in none} == {None}

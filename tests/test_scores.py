"""Several areas under the curve from one pass, and users folded into factors."""

import random

import numpy as np
import pytest

from recspark.operators import metrics, pooling, ranking


def brute_auc(rows):
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)


def test_areas_of_several_labels_and_scores(spark):
    draw = random.Random(8)
    rows = [(draw.randrange(2), draw.choice([0, 1, None]), 1, draw.randrange(9) / 8, draw.random(), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, one int, s double, t double, id int").repartition(4)
    pairs = [("a", "s"), ("b", "t"), ("one", "s"), ("b", "s"), ("a", "t"), ("a", "id")]
    found = {r.pair: r.auc for r in metrics.roc_aucs(df, pairs).collect()}
    place = {c: i for i, c in enumerate(df.columns)}
    for n, (label, score) in enumerate(pairs):
        wanted = brute_auc([(r[place[label]], r[place[score]]) for r in rows])
        assert (found[n] is None) == (wanted is None) and (wanted is None or abs(found[n] - wanted) < 1e-12)
    score = metrics.weighted_auc(df, ("a", "s"), ("b", "t")).first()["score"]
    assert abs(score - 0.7 * found[0] - 0.3 * found[1]) < 1e-12
    assert metrics.weighted_auc(df, ("a", "s"), ("one", "t")).first()["score"] is None


def test_areas_need_one_order_of_the_scores(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (0, 1, 0.25)], "a int, b int, s double")
    found = metrics.roc_aucs(df, [("a", "s"), ("b", "s")])
    assert sorted((r.pair, r.auc) for r in found.collect()) == [(0, 1.0), (1, 0.0)]


@pytest.mark.parametrize("limit", [pooling.LOOKUP_BYTES, 0])
def test_folded_users_get_their_factors(spark, limit):
    draw = random.Random(2)
    rows = [(u, draw.randrange(15), draw.choice([1.0, 2.0, 3.0])) for u in range(12) for _ in range(9)]
    events = spark.createDataFrame(rows, "u long, m long, w double")
    users, items = ranking.factor_vectors(events, "u", "m", "w", rank=4, rounds=2)
    trained = {r["u"]: np.array(r["vector"]) for r in users.collect()}
    factors = {r["m"]: np.array(r["vector"], float) for r in items.collect()}
    new = [(100, 3, 1.0), (100, 4, 2.0), (100, 999, 5.0), (100, None, 1.0), (101, 999, 1.0), (102, 3, -1.0), (102, 5, 1.0)]
    more = events.unionByName(spark.createDataFrame(new, "u long, m long, w double"))
    folded = {r["u"]: np.array(r["vector"]) for r in ranking.fold_in(more, "u", "m", "w", items, limit=limit).collect()}
    assert folded.keys() == {*trained, 100, 102}
    assert all(np.allclose(folded[u], v, atol=1e-4) for u, v in trained.items())
    y = np.array(list(factors.values()))
    for user, ratings in ((100, {3: 1.0, 4: 2.0}), (102, {3: -1.0, 5: 1.0})):
        own = np.array([factors[m] for m in ratings])
        r = np.array(list(ratings.values()))
        left = y.T @ y + (own.T * np.abs(r)) @ own + 0.1 * (r > 0).sum() * np.eye(4)
        right = own.T @ np.where(r > 0, 1 + np.abs(r), 0)
        assert np.allclose(left @ folded[user], right, atol=1e-8)

"""Fitted models and trained lists: facts that hold whatever the training found."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from recspark.operators import embeddings, ranking, search
from recspark.queries.base import clicks
from recspark.queries.ranking import _coded
from recspark.queries.search import _vectors

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coded(spark):
    return _coded(spark, FOLDER).cache()


def _arrays(df, *columns):
    rows = df.select("event_id", *columns).orderBy("event_id").collect()
    return [np.array([r[i + 1] for r in rows], float) for i in range(len(columns))]


def test_converged_linear_model_has_the_mean_of_the_label(coded):
    model = ranking.linear_model([], ["duration"], "finish", maxIter=200, tol=1e-10).fit(coded)
    score, label = _arrays(ranking.probability(model.transform(coded)), "score", "finish")
    assert abs(score.mean() - label.mean()) < 1e-6
    weights, intercept = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    (duration,) = _arrays(coded, "duration")
    assert np.allclose(score, 1 / (1 + np.exp(-(duration * weights[0] + intercept))))


def test_hashed_models_need_no_dictionary(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("u"), "id").alias("u"), (F.col("id") % 50_000).alias("m"), (F.col("id") % 3 == 0).cast("int").alias("y"), F.rand(1).alias("x"))
    rows = rows.withColumn("u", F.when(F.col("m") % 9 > 0, F.col("u")))
    model = ranking.linear_model(["u", "m"], ["x"], "y", width=1 << 10, maxIter=3).fit(rows)
    assert model.stages[-1].numFeatures == (1 << 10) + 1 and len(model.stages) == 3
    scored = model.transform(rows.limit(20).withColumn("u", F.lit("never seen")))
    assert ranking.probability(scored).where("score BETWEEN 0 AND 1").count() == 20
    machine = ranking.fm_classifier(["u", "m"], ["x"], "y", width=1 << 6, factorSize=2, maxIter=2).fit(rows.limit(500))
    assert machine.stages[-1].factors.numRows == (1 << 6) + 1


def _factorised(model, x):
    factors, linear = model.factors.toArray(), model.linear.toArray()
    pairs = ((x @ factors) ** 2 - (x**2) @ (factors**2)).sum(1) / 2
    return model.intercept + x @ linear + pairs


@pytest.mark.parametrize("make, output", [(ranking.fm_classifier, "finish"), (ranking.fm_regressor, "duration")])
def test_factorisation_machine_scores_follow_from_its_weights(coded, make, output):
    dense = ["duration"] if output == "finish" else []
    model = make(["uid", "item_id"], dense, output, factorSize=3, maxIter=3, stepSize=0.01, seed=1).fit(coded)
    scored = model.transform(coded)
    x = np.array([r[0] for r in scored.orderBy("event_id").select(vector_to_array("features")).collect()])
    raw = _factorised(model.stages[-1], x)
    if output == "finish":
        (score,) = _arrays(ranking.probability(scored), "score")
        raw = 1 / (1 + np.exp(-raw))
    else:
        (score,) = _arrays(scored, "prediction")
    assert np.allclose(score, raw, atol=1e-8)


def test_perceptron_scores_follow_from_its_weights(spark):
    rows = clicks(spark, FOLDER).select("event_id", "finish", "duration", (F.col("us") % 24).cast("double").alias("hour"))
    model = ranking.perceptron([], ["duration", "hour"], "finish", hidden=[3], inputs=2, maxIter=4, seed=2).fit(rows)
    score, duration, hour = _arrays(ranking.probability(model.transform(rows)), "score", "duration", "hour")
    w = model.stages[-1].weights.toArray()
    # per layer the weights by input, then the biases
    first, one, second, two = w[:6].reshape(2, 3), w[6:9], w[9:15].reshape(3, 2), w[15:]
    hidden = 1 / (1 + np.exp(-(np.stack([duration, hour], 1) @ first + one)))
    out = hidden @ second + two
    assert np.allclose(score, 1 / (1 + np.exp(out[:, 0] - out[:, 1])), atol=1e-8)


@pytest.fixture(scope="module")
def vectors(spark):
    return _vectors(spark, FOLDER).cache()


def _matrix(vectors):
    rows = vectors.orderBy("vec_id").collect()
    return {r["vec_id"]: np.array(r["embedding"], float) for r in rows}


def test_trained_lists_give_true_distances_never_nearer_than_exact_search(vectors):
    exact = {(r["query_id"], r["place"]): r["score"] for r in search.exact_topk(vectors, vectors, 5, "l2", "vec_id", "embedding", "vec_id", "embedding").collect()}
    centroids = search.centroids_of(vectors, "embedding", 8)
    lists = search.build_lists(vectors, "vec_id", "embedding", centroids)
    assert sorted(r["item_id"] for r in lists.select("item_id").collect()) == sorted(_matrix(vectors))
    found = search.list_topk(vectors, lists, centroids, 5, 3, "vec_id", "embedding").collect()
    by_id = _matrix(vectors)
    for r in found:
        distance = ((by_id[r["query_id"]] - by_id[r["item_id"]]) ** 2).sum()
        assert abs(distance - r["score"]) < 1e-6
        assert r["score"] >= exact[r["query_id"], r["place"]] - 1e-9
    assert {r["query_id"] for r in found} == set(by_id)


def test_trained_codes_are_the_nearest_words(vectors):
    centroids = search.centroids_of(vectors, "embedding", 4)
    lists = search.build_lists(vectors, "vec_id", "embedding", centroids)
    books = search.train_codebooks(lists, 4, 64, 6, centroids).collect()
    assert {(r["part"]) for r in books} == {0, 1, 2, 3}
    assert all(len(r["word"]) == 16 for r in books)


@pytest.mark.parametrize("residual", [True, False])
def test_code_scores_are_distances_to_decoded_vectors(vectors, residual):
    centroids = search.centroids_of(vectors, "embedding", 4)
    lists = search.build_lists(vectors, "vec_id", "embedding", centroids)
    given = centroids if residual else None
    books = search.train_codebooks(lists, 4, 64, 6, given)
    coded = search.quantise(lists, books, given)
    words = {(r["part"], r["code"]): np.array(r["word"]) for r in books.collect()}
    centres = {r["cluster"]: np.array(r["centroid"]) for r in centroids.collect()}
    decoded = {}
    for r in coded.collect():
        decoded[r["item_id"]] = np.concatenate([words[p, c] for p, c in enumerate(r["codes"])]) + (centres[r["cluster"]] if residual else 0)
    found = search.quantised_topk(vectors, coded, books, centroids, 5, 2, residual, "vec_id", "embedding", block=30).collect()
    by_id = _matrix(vectors)
    assert {r["query_id"] for r in found} == set(by_id)
    for r in found:
        assert abs(((by_id[r["query_id"]] - decoded[r["item_id"]]) ** 2).sum() - r["score"]) < 1e-6
    probed = {}
    for r in search.probe(vectors, "vec_id", "embedding", centroids, 2).collect():
        distance = ((by_id[r["query_id"]] - centres[r["cluster"]]) ** 2).sum()
        assert abs(distance - r["distance"]) < 1e-6
        probed.setdefault(r["query_id"], []).append(distance)
    every = {q: sorted(((v - c) ** 2).sum() for c in centres.values())[:2] for q, v in by_id.items()}
    assert all(np.allclose(sorted(probed[q]), every[q]) for q in by_id)


def test_probing_writes_no_vector(vectors):
    centroids = search.centroids_of(vectors, "embedding", 4)
    assert search.probe(vectors, "vec_id", "embedding", centroids, 2).columns == ["query_id", "cluster", "distance"]


def test_item_vectors_are_close_for_words_that_share_contexts(spark):
    rows = [(["red", a, "shoe"],) for a in ("big", "small") for _ in range(60)] + [(["sun", a, "sky"],) for a in ("hot", "cold") for _ in range(60)]
    sentences = spark.createDataFrame(rows, "w array<string>")
    vectors = embeddings.train_vectors(sentences, "w", size=8, window=2, partitions=1, iterations=20)
    near = embeddings.analogy(vectors, ["big"], k=7).collect()
    place = {r["token"]: i for i, r in enumerate(near)}
    assert place["small"] < place["cold"] and place["small"] < place["hot"]
    with pytest.raises(ValueError, match="none of these words"):
        embeddings.analogy(vectors, ["nobody"])

"""Ranking models, scores, ensembles and metrics."""

import numpy as np
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import encoding, metrics, pooling, profiling, ranking, search
from ..plans import competition, recall
from ..session import table
from ..storage import materialize
from .base import CLICKS, WIDE, clicks, query, r6, wide
from .search import COSINE, VECTORS
from .sequences import EARLIER, _recent


def _coded(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "finish", "liked", "duration")
    fitted = encoding.fit_dictionary(log, ["uid", "item_id"])
    return encoding.encode(log, fitted, ["uid", "item_id"])


def _scored(model, rows):
    scored = ranking.probability(model.fit(rows).transform(rows))
    return scored.select("event_id", "finish", r6("score").alias("score"))


@query("n1_linear_model")
def n1(spark, d):
    model = ranking.linear_model(["uid", "item_id"], ["duration"], "finish", maxIter=5)
    return _scored(model, materialize(_coded(spark, d), "coded"))


# at the optimum the scores have the mean of the labels, whatever shares a place
@query("n1_hashed_mean_score", f"WITH {CLICKS} SELECT count(*) AS rows, round(avg(finish), 4) AS mean_score FROM clicks")
def n1_hashed(spark, d):
    rows = materialize(clicks(spark, d).select("uid", "item_id", "channel", "duration", "finish", "event_id"), "rows")
    model = ranking.linear_model(["uid", "item_id"], ["duration"], "finish", width=1 << 12, maxIter=100, tol=1e-9)
    scored = ranking.probability(model.fit(rows).transform(rows))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("score"), 4).alias("mean_score"))


@query("n2_factorisation_machine")
def n2(spark, d):
    model = ranking.fm_classifier(
        ["uid", "item_id"], ["duration"], "finish", factorSize=4, maxIter=5, stepSize=0.01
    )
    return _scored(model, materialize(_coded(spark, d), "coded"))


@query("n2_factorisation_regressor")
def n2_regressor(spark, d):
    model = ranking.fm_regressor(
        ["uid", "item_id"], [], "duration", factorSize=4, maxIter=5, stepSize=0.01
    )
    rows = materialize(_coded(spark, d), "coded")
    return model.fit(rows).transform(rows).select("event_id", "duration", r6("prediction").alias("prediction"))


def _field_table(spark, d):
    """Given vectors: users by id, items by 100 + id; `n` is the rows of the id."""
    vectors = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    log = clicks(spark, d)
    users = log.groupBy(F.col("uid").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    items = log.groupBy(F.col("item_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    by_user = users.join(vectors, F.col("id") == F.col("vec_id"))
    by_item = items.join(vectors, F.col("id") + 100 == F.col("vec_id"))
    shape = ["id", "vector", "n"]
    both = by_user.select(F.lit("uid").alias("feature"), *shape).unionAll(
        by_item.select(F.lit("item_id").alias("feature"), *shape)
    )
    return materialize(both, "fields", partition_by=["feature"])


@query(
    "n3_fm_score",
    f"""WITH {VECTORS}, {CLICKS}, s AS (SELECT event_id, duration, list_dot_product(u.e, i.e) AS pair
      FROM clicks JOIN v u ON u.vec_id = uid JOIN v i ON i.vec_id = 100 + item_id)
    SELECT event_id, round(1 / (1 + exp(-(0.01 * duration - 0.5 + pair))), 6) AS score
    FROM clicks LEFT JOIN s USING (event_id, duration)""",
)
def n3(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "duration")
    linear = 0.01 * F.col("duration") - 0.5
    scored = ranking.fm_score(log, ["uid", "item_id"], _field_table(spark, d), linear)
    return scored.select("event_id", r6("score").alias("score"))


# the last five items before each event, filled with the padding id 0
PADDED = f"""{EARLIER}, padded AS (SELECT event_id, item_id AS target, list_resize(earlier[-5:], 5, 0) AS ids
    FROM histories),
  cells AS (SELECT event_id, target, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM padded)"""


def _padded(spark, d):
    """The padded histories, and the vector table."""
    rows = _recent(spark, d, 5).select("event_id", F.col("item_id").alias("target"), arrays.pad(F.col("items"), 5).alias("ids"))
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return rows, vectors


@query(
    "n4_pooled_history",
    f"""WITH {VECTORS}, {PADDED}
    SELECT event_id, round(avg(e[1]), 6) AS plain_first, round(avg(e[64]), 6) AS plain_last,
      round(avg(e[1]) FILTER (id <> 0), 6) AS masked_first, round(avg(e[64]) FILTER (id <> 0), 6) AS masked_last
    FROM cells JOIN v ON v.vec_id = id GROUP BY 1""",
)
def n4(spark, d):
    rows, vectors = _padded(spark, d)
    both = pooling.pooled_lists(rows, ["event_id"], "ids", vectors)
    return both.select(
        "event_id",
        r6(F.get("mean", 0)).alias("plain_first"),
        r6(F.get("mean", 63)).alias("plain_last"),
        r6(F.get("masked_mean", 0)).alias("masked_first"),
        r6(F.get("masked_mean", 63)).alias("masked_last"),
    )


@query(
    "n3_fm_pooled_history",
    f"""WITH {VECTORS}, {PADDED}, m AS (SELECT event_id, list(x ORDER BY i) AS e FROM (SELECT event_id, i, avg(e[i]) AS x FROM
      (SELECT event_id, id, e, unnest(range(1, 65)) AS i FROM cells JOIN v ON v.vec_id = id WHERE id <> 0) GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT c.event_id, list_dot_product(u.e, t.e) + list_dot_product(u.e, m.e) + list_dot_product(t.e, m.e) AS pair
      FROM clicks c JOIN v u ON u.vec_id = uid JOIN v t ON t.vec_id = 100 + item_id JOIN m ON m.event_id = c.event_id)
    SELECT event_id, round(1 / (1 + exp(-(0.01 * duration - 0.5 + pair))), 6) AS score FROM clicks LEFT JOIN s USING (event_id)""",
)
def n3_pooled(spark, d):
    """The history's masked mean vector is one field more; without one there is no score."""
    rows, vectors = _padded(spark, d)
    pooled = pooling.pooled_lists(rows, ["event_id"], "ids", vectors).select("event_id", "masked_mean")
    log = clicks(spark, d).select("event_id", "uid", "item_id", "duration").join(pooled, "event_id")
    linear = 0.01 * F.col("duration") - 0.5
    scored = ranking.fm_score(log, ["uid", "item_id"], _field_table(spark, d), linear, pooled=["masked_mean"])
    return scored.select("event_id", r6("score").alias("score"))


@query(
    "n4_weighted_history",
    f"""WITH {VECTORS}, {PADDED}, real AS (SELECT event_id, e, exp(0.25 * pos) AS power
      FROM cells JOIN v ON v.vec_id = id WHERE id <> 0),
    t AS (SELECT event_id, sum(power) AS total, count(*) AS n FROM real GROUP BY 1),
    s AS (SELECT event_id, sum(e[1] * power / total) / any_value(n) AS first, sum(e[64] * power / total) / any_value(n) AS last
      FROM real JOIN t USING (event_id) GROUP BY 1)
    SELECT event_id, round(first, 6) AS first, round(last, 6) AS last
    FROM padded LEFT JOIN s USING (event_id)""",
)
def n4_weighted(spark, d):
    """Later positions weigh more: the softmax of a weight that grows with the position."""
    rows, vectors = _padded(spark, d)
    rows = rows.withColumn("w", F.transform("ids", lambda x, i: 0.25 * (i + 1)))
    both = pooling.pooled_lists(rows, ["event_id"], "ids", vectors, weight="w")
    weighted = F.col("weighted_mean")
    return both.select("event_id", r6(F.get(weighted, 0)).alias("first"), r6(F.get(weighted, 63)).alias("last"))


@query(
    "n5_attention_pooled",
    f"""WITH {VECTORS}, {PADDED}, s AS (SELECT event_id, id, pos, k.e,
      CASE WHEN id <> 0 THEN list_dot_product(q.e, k.e) ELSE -4294967295.0 END AS score
      FROM cells JOIN v k ON k.vec_id = id JOIN v q ON q.vec_id = target),
    m AS (SELECT event_id, max(score) AS top FROM s GROUP BY 1),
    w AS (SELECT event_id, pos, e, exp(score - top) AS power FROM s JOIN m USING (event_id)),
    t AS (SELECT event_id, sum(power) AS total FROM w GROUP BY 1)
    SELECT event_id, round(sum(e[1] * power / total), 6) AS first, round(sum(e[64] * power / total), 6) AS last,
      round(max(power / total), 6) AS top_weight FROM w JOIN t USING (event_id) GROUP BY 1""",
)
def n5(spark, d):
    rows, vectors = _padded(spark, d)
    pooled = pooling.attended_lists(rows, ["event_id"], "ids", "target", vectors)
    return pooled.select(
        "event_id",
        r6(F.get("vector", 0)).alias("first"),
        r6(F.get("vector", 63)).alias("last"),
        r6(F.array_max("weights")).alias("top_weight"),
    )


@query(
    "n6_factor_vectors",
    f"""WITH {CLICKS} SELECT DISTINCT 'user' AS side, CAST(uid AS INTEGER) AS id, 16 AS size FROM clicks
    UNION ALL SELECT DISTINCT 'item', CAST(item_id AS INTEGER), 16 FROM clicks""",
)
def n6(spark, d):
    log = clicks(spark, d).select(
        F.col("uid").cast("int").alias("uid"), F.col("item_id").cast("int").alias("item_id"), F.lit(1).alias("w")
    )
    users, items = ranking.factor_vectors(log, "uid", "item_id", "w", rank=16, rounds=3)
    users = users.select(F.lit("user").alias("side"), F.col("uid").alias("id"), F.size("vector").alias("size"))
    return users.unionAll(items.select(F.lit("item"), "item_id", F.size("vector")))


@query("n6_recall_of_recommendations")
def n6_recall(spark, d):
    log = clicks(spark, d).select(
        "event_id",
        "us",
        F.col("uid").cast("int").alias("uid"),
        F.col("item_id").cast("int").alias("item_id"),
        F.lit(1).alias("w"),
    )
    _, scores = recall.recommend_and_score(log, "uid", "item_id", "w", ["us", "event_id"], k=50, rank=16)
    return scores


# the vectors come from training; a user folded in again must get its own vector
@query("n6_fold_in", f"""WITH {CLICKS} SELECT DISTINCT uid, 0.0::DOUBLE AS difference, 16 AS size FROM clicks""")
def n6_fold_in(spark, d):
    log = clicks(spark, d).select("uid", "item_id", F.lit(1).alias("w"))
    users, items = ranking.factor_vectors(log, "uid", "item_id", "w", rank=16, rounds=2)
    folded = ranking.fold_in(log, "uid", "item_id", "w", materialize(items, "items"))
    both = folded.join(users.withColumnRenamed("vector", "trained"), "uid")
    apart = F.array_max(F.zip_with("vector", "trained", lambda x, y: F.abs(x - y)))
    return both.select("uid", F.round(apart, 3).alias("difference"), F.size("vector").alias("size"))


@query("n7_perceptron")
def n7(spark, d):
    rows = clicks(spark, d).select(
        "event_id", "finish", "duration", F.hour(F.timestamp_micros("us")).cast("double").alias("hour")
    )
    model = ranking.perceptron([], ["duration", "hour"], "finish", hidden=[8, 4], inputs=2, maxIter=5, seed=42)
    return _scored(model, materialize(rows, "rows"))


def _load_model():
    """Stands for an external model: loaded once per worker, called per batch."""
    weights = np.array([0.3, 0.01])

    def predict(finish: np.ndarray, duration: np.ndarray) -> np.ndarray:
        x = np.stack([finish, duration], axis=1).astype(np.float64)
        return 1 / (1 + np.exp(-(x @ weights - 0.5)))

    return predict


MODEL = "1 / (1 + exp(-(0.3 * finish + 0.01 * duration - 0.5)))"


def _predicted(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "finish", "liked", "duration")
    return ranking.batch_score(log, [F.col("finish").cast("double"), F.col("duration")], lambda: _load_model())


@query(
    "n8_batch_scores",
    f"WITH {CLICKS} SELECT event_id, round({MODEL}, 6) AS pred_scores FROM clicks",
)
def n8(spark, d):
    return _predicted(spark, d).select("event_id", r6("pred_scores").alias("pred_scores"))


@query(
    "f1_ranked_list",
    f"""WITH {CLICKS} SELECT uid, event_id, round({MODEL}, 6) AS pred_scores FROM clicks
    ORDER BY uid, pred_scores DESC, event_id""",
)
def f1(spark, d):
    scored = _predicted(spark, d).withColumn("pred_scores", r6("pred_scores"))
    return ranking.ranked_list(scored, "uid", "pred_scores", "event_id").select("uid", "event_id", "pred_scores")


@query(
    "d14_mean_prediction",
    f"""WITH {CLICKS} SELECT uid, item_id,
    round(avg(1 / (1 + exp(-(0.01 * duration - 0.1 * r)))), 6) AS finish_probability
    FROM clicks CROSS JOIN range(10) t(r) GROUP BY 1, 2""",
)
def d14(spark, d):
    log = clicks(spark, d)
    runs = [
        log.select(
            "uid",
            "item_id",
            arrays.sigmoid(0.01 * F.col("duration") - 0.1 * run).alias("finish_probability"),
        )
        for run in range(10)
    ]
    mean = ranking.mean_prediction(runs, ["uid", "item_id"], "finish_probability")
    return mean.withColumn("finish_probability", r6("finish_probability"))


@query(
    "c1_side_vector_join",
    f"""WITH {VECTORS}, {CLICKS} SELECT event_id, item_id, """
    + ", ".join(f"coalesce(e[{i + 1}], 0) AS vd{i}" for i in range(64))
    + " FROM clicks LEFT JOIN v ON vec_id - 420 = item_id",
)
def c1(spark, d):
    side = table(spark, d, "embeddings").select((F.col("vec_id") - 420).alias("item_id"), "embedding")
    side = profiling.first_per_key(side, ["item_id"], ["item_id"])
    log = clicks(spark, d).select("event_id", "item_id")
    return competition.with_vector(log, side, "embedding", "vd", 64)


@query(
    "c1_side_title_join",
    """WITH t AS (SELECT p_partkey, len(p_name) - 1 AS title_len, replace(p_name, ' ', ',') AS words
      FROM part WHERE p_size > 10)
    SELECT l_orderkey, l_partkey AS item_id, round(coalesce(title_len, (SELECT avg(title_len) FROM t)), 6)
      AS title_len, coalesce(words, '') AS title_words FROM lineitem LEFT JOIN t ON p_partkey = l_partkey""",
)
def c1_titles(spark, d):
    name = F.split("p_name", " ")
    titles = table(spark, d, "part").where("p_size > 10").select(
        F.col("p_partkey").alias("item_id"),
        F.map_from_arrays(name, F.transform(name, lambda w: F.length(w))).alias("title_features"),
    )
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item_id"))
    rows = competition.with_titles(lines, titles)
    return rows.select(
        "l_orderkey", "item_id", r6("title_len").alias("title_len"), F.array_join("title_words", ",").alias("title_words")
    )


def auc_sql(label, score, source="wide"):
    return f"""(SELECT sum(CASE WHEN {label} = 1 THEN r END) FROM
      (SELECT {label}, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r
       FROM {source}))"""


def auc_of(label, score):
    pos = f"CAST((SELECT sum({label}) FROM wide) AS DOUBLE)"
    neg = f"CAST((SELECT sum(1 - {label}) FROM wide) AS DOUBLE)"
    return f"({auc_sql(label, score)} - {pos} * ({pos} + 1) / 2) / ({pos} * {neg})"


PRICE = "duration_time / 50.0 * 0.9 + 0.05"


def _probabilities(spark, d):
    score = F.col("duration_time") / 50.0 * 0.9 + 0.05
    return wide(spark, d).select("finish", "liked", F.lit(1).alias("always"), score.alias("score"))


@query(
    "m1_roc_auc",
    f"""WITH {WIDE} SELECT 'finish' AS label, round({auc_of('finish', 'duration_time')}, 6) AS auc
    UNION ALL SELECT 'liked', round({auc_of('liked', 'duration_time')}, 6)
    UNION ALL SELECT 'one class', NULL""",
)
def m1(spark, d):
    names = ("finish", "liked", "one class")
    found = metrics.roc_aucs(_probabilities(spark, d), [("finish", "score"), ("liked", "score"), ("always", "score")])
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pair") + 1)
    return found.select(label.alias("label"), r6("auc").alias("auc"))


@query(
    "m2_log_loss",
    f"""WITH {WIDE}, p AS (SELECT finish AS y, {PRICE} AS p FROM wide)
    SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss FROM p""",
)
def m2(spark, d):
    return metrics.log_loss(_probabilities(spark, d), "finish", "score").select(r6("log_loss").alias("log_loss"))


@query(
    "m3_accuracy",
    f"""WITH {WIDE} SELECT round(avg(CASE WHEN CAST({PRICE} > 0.5 AS INTEGER) = finish THEN 1.0 ELSE 0 END), 6)
    AS accuracy FROM wide""",
)
def m3(spark, d):
    return metrics.accuracy(_probabilities(spark, d), "finish", "score").select(r6("accuracy").alias("accuracy"))


@query(
    "m4_recall_at",
    f"""WITH {VECTORS}, {CLICKS}, truth AS (SELECT DISTINCT uid, item_id FROM clicks WHERE finish = 1),
    u AS (SELECT DISTINCT uid FROM truth), i AS (SELECT DISTINCT item_id FROM clicks),
    scored AS (SELECT uid, item_id, {COSINE} AS score FROM u JOIN v a ON a.vec_id = uid
      CROSS JOIN i JOIN v b ON b.vec_id = 100 + item_id),
    top AS (SELECT uid, item_id, row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, item_id)
      AS place FROM scored),
    hits AS (SELECT uid, count(*) AS n, count(*) FILTER (place <= 10) AS h10, count(*) FILTER (place <= 50) AS h50
      FROM truth LEFT JOIN top USING (uid, item_id) GROUP BY 1)
    SELECT round(avg(h10 / n), 6) AS recall_at_10, round(avg(h50 / n), 6) AS recall_at_50 FROM hits""",
)
def m4(spark, d):
    log = clicks(spark, d)
    truth = log.where("finish = 1").select("uid", "item_id")
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    users = v.join(truth.select(F.col("uid").alias("vec_id")).distinct(), "vec_id", "left_semi")
    items = log.select("item_id", (F.col("item_id") + 100).alias("vec_id")).distinct()
    found = search.exact_topk(
        users, items.join(v, "vec_id"), 50, "cosine", "vec_id", "embedding", "item_id", "embedding"
    )
    ranked = found.select(F.col("query_id").alias("uid"), "item_id", "place")
    scores = metrics.recall_at(ranked, truth, "uid", "item_id", "place", (10, 50))
    return scores.select(*[r6(c).alias(c) for c in scores.columns])


@query(
    "m5_mse",
    f"WITH {WIDE} SELECT round(avg(pow(finish - ({PRICE}), 2)), 6) AS mse FROM wide",
)
def m5(spark, d):
    return metrics.mse(_probabilities(spark, d), "finish", "score").select(r6("mse").alias("mse"))


@query(
    "m6_weighted_auc",
    f"""WITH {WIDE} SELECT round(0.7 * {auc_of('finish', 'duration_time')}
    + 0.3 * {auc_of('liked', 'duration_time')}, 6) AS score""",
)
def m6(spark, d):
    rows = _probabilities(spark, d)
    return metrics.weighted_auc(rows, ("finish", "score"), ("liked", "score")).select(r6("score").alias("score"))

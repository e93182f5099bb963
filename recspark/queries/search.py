"""Vector functions, exact and cluster-pruned search, recommendations."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..functions import vectors as vf
from ..operators import samples, search
from ..operators.ranking import ranking_rows
from ..session import table
from ..storage import materialize
from .base import clicks, joined, query, r6
from .samples import HISTORY

VECTORS = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
    FROM embeddings)"""
# the mean vector of each label, as (cluster, centroid)
CENTROIDS = """cells AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM v),
  means AS (SELECT label, pos, avg(x) AS x FROM cells GROUP BY 1, 2),
  c AS (SELECT label AS cluster, list(x ORDER BY pos) AS centroid FROM means GROUP BY 1)"""


def l2_sql(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _vectors(spark, d):
    return table(spark, d, "embeddings")


def label_means(spark, d):
    """One given centroid per label, instead of trained ones."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    mean = vector_to_array(Summarizer.mean(vector)).alias("centroid")
    return _vectors(spark, d).groupBy(F.col("label").alias("cluster")).agg(mean)


@query(
    "j5_l2_normalize",
    f"""WITH {VECTORS}, h AS (SELECT vec_id, list_transform(e, lambda x: x * (vec_id + 1)) AS e FROM v)
    SELECT vec_id, round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first,
    round(e[64] / sqrt(list_dot_product(e, e)), 6) AS last FROM h""",
)
def j5(spark, d):
    long = vf.scale(F.col("embedding"), F.col("vec_id") + 1)
    unit = _vectors(spark, d).select("vec_id", vf.l2_normalize(long).alias("u"))
    return unit.select("vec_id", r6(F.get("u", 0)).alias("first"), r6(F.get("u", 63)).alias("last"))


@query(
    "j6_vector_products",
    f"""WITH {VECTORS}, {CENTROIDS} SELECT vec_id, round(list_dot_product(e, centroid), 6) AS dot,
    round(list_dot_product(e, centroid) / sqrt(list_dot_product(e, e) * list_dot_product(centroid, centroid)), 6)
      AS cosine, round({l2_sql('e', 'centroid')}, 6) AS squared_l2
    FROM v JOIN c ON v.label = c.cluster""",
)
def j6(spark, d):
    e, c = F.col("embedding"), F.col("centroid")
    means = label_means(spark, d).withColumnRenamed("cluster", "label")
    pairs = _vectors(spark, d).join(means, "label")
    return pairs.select(
        "vec_id",
        r6(vf.dot(e, c)).alias("dot"),
        r6(vf.cosine(e, c)).alias("cosine"),
        r6(vf.squared_l2(e, c)).alias("squared_l2"),
    )


@query(
    "j7_round_score",
    f"""WITH {VECTORS} SELECT vec_id, round(e[1] + e[2], 4) AS score FROM v""",
)
def j7(spark, d):
    e = F.col("embedding").cast("array<double>")
    return _vectors(spark, d).select("vec_id", F.round(F.get(e, 0) + F.get(e, 1), 4).alias("score"))


def topk_rows(score, order, k, decimals=6):
    return f"""WITH {VECTORS}, scored AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, {score} AS score
      FROM v a CROSS JOIN v b),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) {order}, item_id)
      AS place FROM scored)
    SELECT query_id, item_id, round(score, {decimals}) AS score, CAST(place AS INTEGER) AS place
    FROM ranked WHERE place <= {k}"""


COSINE = "list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e))"


def _found(spark, d, metric, k):
    v = _vectors(spark, d)
    found = search.exact_topk(v, v, k, metric, "vec_id", "embedding", "vec_id", "embedding")
    return found.select("query_id", "item_id", r6("score").alias("score"), "place")


@query("k2_inner_product_topk", topk_rows(COSINE, "DESC", 5))
def k2(spark, d):
    return _found(spark, d, "cosine", 5)


@query("k3_l2_topk", topk_rows(l2_sql("a.e", "b.e"), "", 5))
def k3(spark, d):
    return _found(spark, d, "l2", 5)


@query("c8_scored_pairs", topk_rows("list_dot_product(a.e, b.e)", "DESC", 10))
def c8(spark, d):
    return _found(spark, d, "inner", 10)


@query("e6_topk_per_query", topk_rows(COSINE, "DESC", 3))
def e6(spark, d):
    return _found(spark, d, "cosine", 3)


@query(
    "k1_pair_scores",
    f"""WITH {VECTORS}, top AS (SELECT user_id, event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
      FROM events)
    SELECT event_id, round(list_dot_product(u.e, i.e)
      / sqrt(list_dot_product(u.e, u.e) * list_dot_product(i.e, i.e)), 6) AS score
    FROM top LEFT JOIN v u ON u.vec_id = user_id LEFT JOIN v i ON i.vec_id = 100 + k""",
)
def k1(spark, d):
    from ..operators.skew import attach_side

    v = _vectors(spark, d)
    users = v.select(F.col("vec_id").alias("uid"), F.col("embedding").alias("u"))
    items = v.select((F.col("vec_id") - 100).alias("item_id"), F.col("embedding").alias("i"))
    log = clicks(spark, d).select("event_id", "uid", "item_id")
    pairs = attach_side(attach_side(log, users, ["uid"]), items, ["item_id"])
    return pairs.select("event_id", r6(vf.cosine(F.col("u"), F.col("i"))).alias("score"))


@query(
    "k4_single_query_topk",
    f"""WITH {VECTORS}, q AS (SELECT list(m ORDER BY pos) AS e FROM (SELECT pos, avg(x) AS m FROM
      (SELECT unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM v) GROUP BY pos))
    SELECT vec_id AS item_id, round(list_dot_product(v.e, q.e) / sqrt(list_dot_product(v.e, v.e)), 6) AS score
    FROM v CROSS JOIN q
    ORDER BY round(list_dot_product(v.e, q.e) / sqrt(list_dot_product(v.e, v.e)), 9) DESC, vec_id LIMIT 5""",
)
def k4(spark, d):
    v = _vectors(spark, d)
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    mean = v.agg(vector_to_array(Summarizer.mean(vector)).alias("m")).first()["m"]
    wanted = F.array(*[F.lit(x) for x in mean])
    score = vf.dot(vf.l2_normalize(F.col("embedding")), wanted)
    top = search.single_query_topk(v, score, 5, "vec_id")
    return top.select("item_id", r6("score").alias("score"))


PROBES = 3
NEAREST = f"""near AS (SELECT vec_id, cluster, row_number() OVER (PARTITION BY vec_id
    ORDER BY round({l2_sql('e', 'centroid')}, 9), cluster) AS near FROM v CROSS JOIN c),
  lists AS (SELECT vec_id AS item_id, cluster, e FROM near JOIN v USING (vec_id) WHERE near = 1),
  probed AS (SELECT vec_id AS query_id, cluster, e FROM near JOIN v USING (vec_id) WHERE near <= {PROBES})"""


@query(
    "k5_inverted_lists",
    f"""WITH {VECTORS}, {CENTROIDS}, {NEAREST}, scored AS (SELECT query_id, item_id,
      {l2_sql('p.e', 'l.e')} AS score FROM probed p JOIN lists l USING (cluster)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), item_id) AS place
      FROM scored)
    SELECT query_id, item_id, round(score, 6) AS score, CAST(place AS INTEGER) AS place
    FROM ranked WHERE place <= 5""",
)
def k5(spark, d):
    v, centroids = _vectors(spark, d), materialize(label_means(spark, d), "centroids")
    lists = search.build_lists(v, "vec_id", "embedding", centroids)
    found = search.list_topk(v, lists, centroids, 5, PROBES, "vec_id", "embedding")
    return found.select("query_id", "item_id", r6("score").alias("score"), "place")


# probing every list is exact search, whatever the training found
@query("k5_all_lists_probed", topk_rows(l2_sql("a.e", "b.e"), "", 5))
def k5_all(spark, d):
    v = _vectors(spark, d)
    centroids = search.centroids_of(v, "embedding", 20)
    lists = search.build_lists(v, "vec_id", "embedding", centroids)
    found = search.list_topk(v, lists, centroids, 5, 20, "vec_id", "embedding")
    return found.select("query_id", "item_id", r6("score").alias("score"), "place")


@query("k5_trained_lists")
def k5_trained(spark, d):
    v = _vectors(spark, d)
    centroids = search.centroids_of(v, "embedding", 20)
    lists = search.build_lists(v, "vec_id", "embedding", centroids)
    return search.list_topk(v, lists, centroids, 5, 10, "vec_id", "embedding")


# whatever the training found: equal vectors share their list, so the nearest item is the exact one
@query(
    "k5_trained_nearest",
    f"""SELECT query_id, item_id, score FROM ({topk_rows(l2_sql("a.e", "b.e"), "", 1)})""",
)
def k5_trained_nearest(spark, d):
    found = k5_trained(spark, d).where("place = 1")
    return found.select("query_id", "item_id", r6("score").alias("score"))


PARTS = 8


def _given_books(spark, d):
    """Code words: the slices of the label means, instead of trained ones."""
    pieces = search.split_vector(F.col("centroid"), PARTS, 64)
    entries = [F.struct(F.lit(i).alias("part"), p.alias("word")) for i, p in enumerate(pieces)]
    means = label_means(spark, d)
    return means.select(F.col("cluster").alias("code"), F.inline(F.array(*entries)))


@query(
    "k6_product_quantised",
    f"""WITH {VECTORS}, {CENTROIDS}, {NEAREST},
    parts AS (SELECT CAST(unnest(range({PARTS})) AS INTEGER) AS part),
    choice AS (SELECT item_id, part, arg_min(centroid[part * 8 + 1:part * 8 + 8],
        (round({l2_sql('e[part * 8 + 1:part * 8 + 8]', 'centroid[part * 8 + 1:part * 8 + 8]')}, 9), c.cluster)) AS word
      FROM lists CROSS JOIN parts CROSS JOIN c GROUP BY 1, 2),
    decoded AS (SELECT item_id, flatten(list(word ORDER BY part)) AS e FROM choice GROUP BY 1),
    scored AS (SELECT query_id, item_id, {l2_sql('p.e', 'x.e')} AS score
      FROM probed p JOIN lists l USING (cluster) JOIN decoded x USING (item_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), item_id) AS place
      FROM scored)
    SELECT query_id, item_id, round(score, 6) AS score, CAST(place AS INTEGER) AS place
    FROM ranked WHERE place <= 5""",
)
def k6(spark, d):
    v, centroids = _vectors(spark, d), materialize(label_means(spark, d), "centroids")
    books = materialize(_given_books(spark, d), "books")
    lists = search.build_lists(v, "vec_id", "embedding", centroids)
    coded = materialize(search.quantise(lists, books), "codes", partition_by=["cluster"])
    found = search.quantised_topk(v, coded, books, centroids, 5, PROBES, False, "vec_id", "embedding")
    return found.select("query_id", "item_id", r6("score").alias("score"), "place")


@query("k6_trained_codebooks")
def k6_trained(spark, d):
    v = _vectors(spark, d)
    centroids = search.centroids_of(v, "embedding", 10)
    lists = search.build_lists(v, "vec_id", "embedding", centroids)
    books = materialize(search.train_codebooks(lists, PARTS, 64, 32, centroids), "books")
    coded = materialize(search.quantise(lists, books, centroids), "codes", partition_by=["cluster"])
    return search.quantised_topk(v, coded, books, centroids, 5, 5, True, "vec_id", "embedding")


@query(
    "k7_fewer_items_than_k",
    f"""WITH {VECTORS}, {CENTROIDS}, ranked AS (SELECT vec_id AS query_id, cluster AS item_id,
      row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(e, centroid), 9) DESC, cluster)
      AS place FROM v CROSS JOIN c)
    SELECT query_id, item_id, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 50""",
)
def k7(spark, d):
    v = _vectors(spark, d)
    found = search.exact_topk(
        v, label_means(spark, d), 50, "inner", "vec_id", "embedding", "cluster", "centroid"
    )
    return found.select("query_id", "item_id", "place")


@query(
    "k8_packed_lists",
    f"""WITH top AS ({topk_rows(COSINE, 'DESC', 5, 4)})
    SELECT query_id, string_agg(item_id, ',' ORDER BY place) AS items, list(score ORDER BY place)[1] AS best,
    list(score ORDER BY place)[5] AS fifth FROM top GROUP BY 1""",
)
def k8(spark, d):
    v = _vectors(spark, d)
    found = search.exact_topk(v, v, 5, "cosine", "vec_id", "embedding", "vec_id", "embedding")
    lists = search.packed(found)
    return lists.select(
        "query_id",
        joined(F.col("items")["item_id"]).alias("items"),
        F.get(F.col("items")["score"], 0).alias("best"),
        F.get(F.col("items")["score"], 4).alias("fifth"),
    )


@query(
    "k9_truth_table",
    f"""WITH {HISTORY}, sized AS (SELECT *, count(*) OVER (PARTITION BY uid) AS events FROM histories)
    SELECT uid, CAST(item_id AS VARCHAR) AS items FROM sized WHERE place >= 1 AND place = events - 1""",
)
def k9(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "us")
    rows = samples.leave_last_out(samples.prefix_histories(log, "uid", "item_id", ["us", "event_id"]))
    truth = search.truth_table(rows.where("split = 'test'"), "uid", "item_id")
    return truth.select("uid", joined("items").alias("items"))


@query(
    "c7_candidates_to_rows",
    f"""WITH top AS ({topk_rows(COSINE, 'DESC', 5)}), mine AS (SELECT query_id AS uid, item_id, score FROM top
      JOIN (SELECT DISTINCT user_id FROM events) ON query_id = user_id)
    SELECT uid, item_id, round(score, 4) AS score, c_mktsegment AS segment, p_brand AS brand
    FROM mine LEFT JOIN customer ON c_custkey = uid LEFT JOIN part ON p_partkey = item_id""",
)
def c7(spark, d):
    v = _vectors(spark, d)
    users = clicks(spark, d).select(F.col("uid").alias("vec_id")).distinct()
    found = search.exact_topk(
        v.join(users, "vec_id", "left_semi"), v, 5, "cosine", "vec_id", "embedding", "vec_id", "embedding"
    )
    lists = search.packed(found, 6)
    rows = search.unpacked(lists.withColumnRenamed("query_id", "uid"), "uid", "items")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("segment"))
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("brand"))
    attached = ranking_rows(rows, "uid", customers, "item_id", parts)
    return attached.withColumn("score", F.round("score", 4))


@query(
    "f3_single_topk",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20""",
)
def f3(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(20)

"""Fills, casts, recodes, profiles, set operations and sorts."""

from pyspark.sql import functions as F

from ..functions.arrays import composite_key, hour_of_day, named_items
from ..operators import cleaning, profiling, skew
from ..session import table
from .base import CLICKS, WIDE, clicks, query, r6, wide


def _gaps(spark, d):
    """Order lines with gaps: discount 0, flag N and tax 0 count as missing."""
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).alias("line"),
    )


GAPS = """gaps AS (
  SELECT l_orderkey, nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax,
    nullif(l_returnflag, 'N') AS flag, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS line
  FROM lineitem)"""


@query(
    "b1_constant_fill",
    f"""WITH {GAPS} SELECT l_orderkey, coalesce(discount, 0) AS discount, coalesce(tax, -1) AS tax,
    coalesce(flag, 'unknow') AS flag, coalesce(CAST(line AS VARCHAR), '-1') AS line FROM gaps""",
)
def b1(spark, d):
    return cleaning.fill_groups(
        _gaps(spark, d), dense=["discount"], sparse=["line"], numbers=["tax"], strings=["flag"]
    )


@query(
    "b2_fill_with_minimum",
    f"""WITH {GAPS} SELECT l_orderkey, coalesce(discount, (SELECT min(discount) FROM gaps)) AS discount,
    coalesce(line, (SELECT min(line) FROM gaps)) AS line FROM gaps""",
)
def b2(spark, d):
    gaps = _gaps(spark, d).select("l_orderkey", "discount", "line")
    return cleaning.fill_from(gaps, cleaning.fit_minima(gaps, ["discount", "line"]))


@query(
    "b3_fill_with_prior_mean",
    """SELECT d.doc_id, round(coalesce(CAST(l.quality AS DOUBLE), m.prior), 6) AS quality
    FROM documents d LEFT JOIN labels l USING (doc_id)
    CROSS JOIN (SELECT avg(quality) AS prior FROM labels) m""",
)
def b3(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double"))
    means = cleaning.fit_means(labels, ["quality"])
    documents = table(spark, d, "documents").select("doc_id")
    filled = cleaning.fill_from(skew.attach_side(documents, labels, ["doc_id"]), means)
    return filled.select("doc_id", r6("quality").alias("quality"))


@query(
    "b4_casts",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_text,
    TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
    TRY_CAST(props AS INTEGER) AS bad, CAST(floor(value) AS INTEGER) AS whole FROM events""",
)
def b4(spark, d):
    events = table(spark, d, "events").select(
        "event_id",
        F.col("user_id").alias("user_text"),
        F.get_json_object("props", "$.k").alias("k"),
        F.col("props").alias("bad"),
        F.floor("value").alias("whole"),
    )
    typed = cleaning.cast_columns(events, {"user_text": "string", "whole": "int"})
    return cleaning.cast_columns(typed, {"k": "int", "bad": "int"}, dirty=True)


@query(
    "b5_composite_key",
    f"""WITH {CLICKS} SELECT concat(uid, '-', item_id) AS uid_item,
    concat(uid, '-', channel) AS uid_channel, count(*) AS n FROM clicks GROUP BY ALL""",
)
def b5(spark, d):
    keyed = clicks(spark, d).select(
        composite_key(F.col("uid"), F.col("item_id")).alias("uid_item"),
        composite_key(F.col("uid"), F.col("channel")).alias("uid_channel"),
    )
    return keyed.groupBy("uid_item", "uid_channel").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b6_label_pairs",
    f"""WITH {WIDE} SELECT
    CAST(sum(CASE WHEN finish = 0 AND liked = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fl_00,
    CAST(sum(CASE WHEN finish = 0 AND liked = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fl_01,
    CAST(sum(CASE WHEN finish = 1 AND liked = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fl_10,
    CAST(sum(CASE WHEN finish = 1 AND liked = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fl_11 FROM wide""",
)
def b6(spark, d):
    pairs = cleaning.label_pairs(wide(spark, d), "finish", "liked")
    return pairs.agg(*[F.sum(c).alias(c) for c in ("fl_00", "fl_01", "fl_10", "fl_11")])


@query(
    "b7_recode",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS status,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent FROM orders""",
)
def b7(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        cleaning.recode(F.col("o_orderstatus"), {"O": 0, "F": 1}).alias("status"),
        cleaning.equals(F.col("o_orderpriority"), "1-URGENT").alias("urgent"),
    )


@query(
    "b8_frequent_values",
    f"""WITH {CLICKS} SELECT item_id, count(*) AS num FROM clicks GROUP BY 1 HAVING count(*) > 100""",
)
def b8(spark, d):
    return profiling.frequent_values(clicks(spark, d), "item_id", 100)


@query(
    "b9_sentinel_share",
    f"""WITH {WIDE} SELECT round(avg(CASE WHEN music_id = -1 THEN 1.0 ELSE 0.0 END), 6) AS share FROM wide""",
)
def b9(spark, d):
    share = profiling.share_of(wide(spark, d), F.col("music_id") == -1)
    return share.select(r6("share").alias("share"))


@query(
    "b10_rename_reorder",
    f"""WITH {WIDE} SELECT uid, item_id, finish AS finish_probability, liked AS like_probability FROM wide""",
)
def b10(spark, d):
    renames = {"finish": "finish_probability", "liked": "like_probability"}
    order = ["uid", "item_id", "finish_probability", "like_probability"]
    return cleaning.rearrange(wide(spark, d), renames, order)


@query(
    "b11_column_groups",
    f"""WITH {WIDE} SELECT uid, user_city, device, time, duration_time FROM wide""",
)
def b11(spark, d):
    log = wide(spark, d)
    user_side = ["uid", "user_city", "device", "gender", "age"]
    dense = cleaning.dense_columns(
        log,
        sparse=["uid", "user_city", "item_id", "author_id", "item_city", "channel", "music_id", "device"],
        labels=["finish", "liked"],
    )
    return cleaning.column_group(log, [*user_side, *dense])


@query(
    "b12_vector_columns",
    "SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS vd{i}" for i in range(64))
    + ", CAST(embedding[1] AS DOUBLE) AS back_first, len(embedding) AS back_size FROM embeddings",
)
def b12(spark, d):
    names = [f"vd{i}" for i in range(64)]
    vector = F.col("embedding").cast("array<double>")
    named = table(spark, d, "embeddings").select("vec_id", *named_items(vector, names))
    back = F.array(*names)
    return named.select(
        "vec_id",
        *names,
        F.get(back, 0).alias("back_first"),
        F.size(back).cast("long").alias("back_size"),
    )


@query(
    "b13_hour_of_day",
    f"""WITH {CLICKS} SELECT event_id, round((us // 1000000) % 86400 / 3600.0, 6) AS hour FROM clicks""",
)
def b13(spark, d):
    seconds = F.floor(F.col("us") / 1_000_000)
    return clicks(spark, d).select("event_id", r6(hour_of_day(seconds)).alias("hour"))


@query(
    "b14_first_rows",
    f"""WITH {CLICKS} SELECT event_id, uid, item_id, us FROM clicks ORDER BY us, event_id LIMIT 2000""",
)
def b14(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "us")
    return cleaning.first_rows(log, ["us", "event_id"], 2000)


@query(
    "d2_value_counts",
    f"""WITH {WIDE} SELECT duration_time, count(*) AS num FROM wide
    WHERE duration_time IS NOT NULL GROUP BY 1""",
)
def d2(spark, d):
    counts = profiling.value_counts(wide(spark, d), "duration_time")
    return counts.orderBy(F.desc("num"), "duration_time")


@query(
    "d4_group_mean",
    f"""WITH {WIDE} SELECT liked, round(avg(finish), 6) AS finish_mean FROM wide GROUP BY 1""",
)
def d4(spark, d):
    means = profiling.group_mean(wide(spark, d), "liked", "finish", "finish_mean")
    return means.select("liked", r6("finish_mean").alias("finish_mean"))


@query(
    "d10_first_per_key",
    f"""WITH {CLICKS} SELECT uid, event_id, item_id, channel FROM clicks
    QUALIFY row_number() OVER (PARTITION BY uid ORDER BY us, event_id) = 1""",
)
def d10(spark, d):
    first = profiling.first_per_key(clicks(spark, d), ["uid"], ["us", "event_id"])
    return first.select("uid", "event_id", "item_id", "channel")


@query(
    "d11_null_profile",
    f"""WITH {GAPS}, filled AS (SELECT coalesce(discount, 0) AS discount, coalesce(tax, 0) AS tax,
      coalesce(flag, 'unknow') AS flag, coalesce(line, 0) AS line FROM gaps)
    SELECT 'before' AS stage, count(*) - count(discount) AS discount, count(*) - count(tax) AS tax,
      count(*) - count(flag) AS flag, count(*) - count(line) AS line FROM gaps
    UNION ALL SELECT 'after', count(*) - count(discount), count(*) - count(tax),
      count(*) - count(flag), count(*) - count(line) FROM filled""",
)
def d11(spark, d):
    gaps = _gaps(spark, d).drop("l_orderkey")
    filled = cleaning.fill_groups(gaps, dense=["discount", "tax", "line"], strings=["flag"])
    before = profiling.null_profile(gaps).select(F.lit("before").alias("stage"), "*")
    return before.unionByName(profiling.null_profile(filled).select(F.lit("after").alias("stage"), "*"))


@query(
    "d12_key_overlap",
    """SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS left_keys,
    (SELECT count(DISTINCT doc_id) FROM labels) AS right_keys,
    (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS common_keys,
    (SELECT min(doc_id) FROM documents) AS left_min, (SELECT max(doc_id) FROM documents) AS left_max,
    (SELECT min(doc_id) FROM labels) AS right_min, (SELECT max(doc_id) FROM labels) AS right_max""",
)
def d12(spark, d):
    return profiling.key_overlap(
        table(spark, d, "documents"), "doc_id", table(spark, d, "labels"), "doc_id"
    )


@query(
    "d13_cardinalities",
    f"""WITH {WIDE} """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feat, count(DISTINCT {c}) AS nunique, count(DISTINCT {c}) + 1 AS nunique_plus_1, "
        f"CAST(max({c}) + 1 AS BIGINT) AS max_plus_1 FROM wide"
        for c in ("uid", "user_city", "item_id", "author_id", "item_city", "channel", "music_id", "device")
    ),
)
def d13(spark, d):
    columns = ["uid", "user_city", "item_id", "author_id", "item_city", "channel", "music_id", "device"]
    return profiling.cardinalities(wide(spark, d), columns)


@query(
    "f2_sort_by_time",
    f"""WITH {CLICKS} SELECT us, event_id, uid, item_id FROM clicks ORDER BY us, event_id""",
)
def f2(spark, d):
    return clicks(spark, d).select("us", "event_id", "uid", "item_id").orderBy("us", "event_id")


@query(
    "g1_union_all",
    """SELECT p_partkey AS id, p_retailprice AS amount, 1 AS label FROM part
    UNION ALL SELECT s_suppkey, s_acctbal, 0 FROM supplier""",
)
def g1(spark, d):
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("amount"), F.lit(1).alias("label")
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"), F.lit(0).alias("label")
    )
    return parts.unionByName(suppliers)


@query(
    "g2_intersection_size",
    """SELECT count(*) AS common FROM
    (SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey FROM part WHERE p_size > 25)""",
)
def g2(spark, d):
    sold = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"))
    large = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("k"))
    return sold.distinct().intersect(large).agg(F.count(F.lit(1)).alias("common"))


@query(
    "g3_difference",
    """SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders""",
)
def g3(spark, d):
    buyers = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"))
    return customers.distinct().join(buyers.distinct(), "custkey", "left_anti")


@query("g4_distinct", """SELECT DISTINCT p_brand, p_type FROM part""")
def g4(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()

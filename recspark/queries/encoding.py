"""Scaling, bins, dictionaries, counts and target means."""

from pyspark.sql import functions as F

from ..operators import counting, encoding, merging, scaling, splits, target
from ..plans import competition
from ..session import table
from ..storage import materialize
from .base import CLICKS, ORACLES, PARTS, WIDE, bin_sql, clicks, qcut_sql, query, r6, wide


@query(
    "h1_standard_scale",
    f"""WITH {WIDE}, s AS (SELECT avg(time) AS m1, stddev_pop(time) AS s1, avg(duration_time) AS m2,
      stddev_pop(duration_time) AS s2 FROM wide)
    SELECT uid, item_id, round((time - m1) / s1, 6) AS time,
      round((duration_time - m2) / s2, 6) AS duration_time FROM wide CROSS JOIN s""",
)
def h1(spark, d):
    log = wide(spark, d).select("uid", "item_id", "time", "duration_time")
    scaled = scaling.standard_scale(log, scaling.fit_standard(log, ["time", "duration_time"]))
    return scaled.select("uid", "item_id", *[r6(c).alias(c) for c in ("time", "duration_time")])


@query(
    "h2_minmax_scale",
    """SELECT l_orderkey, round((l_extendedprice - min(l_extendedprice) OVER ())
      / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS price,
      round((l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()), 6) AS tax,
      0.0::DOUBLE AS constant FROM lineitem""",
)
def h2(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("tax"),
        F.lit(7).alias("constant"),
    )
    scaled = scaling.minmax_scale(lines, scaling.fit_minmax(lines, ["price", "tax", "constant"]))
    return scaled.select("l_orderkey", r6("price").alias("price"), r6("tax").alias("tax"), "constant")


@query(
    "h3_quantile_bins",
    f"""WITH {CLICKS}, {qcut_sql('clicks', 'duration', 10, 'q1')},
    hours AS (SELECT *, (us // 1000000) % 86400 / 3600.0 AS hour FROM clicks),
    {qcut_sql('hours', 'hour', 24, 'q2')}
    SELECT event_id, {bin_sql('duration', 'q1.edges')} AS duration_bin,
      {bin_sql('hour', 'q2.edges')} AS hour_bin FROM hours CROSS JOIN q1 CROSS JOIN q2""",
)
def h3(spark, d):
    log = clicks(spark, d).withColumn("creat_time", F.floor(F.col("us") / 1_000_000))
    binned = competition.time_bins(log, "creat_time", "duration")
    return binned.select(
        "event_id", F.col("duration").alias("duration_bin"), F.col("creat_time").alias("hour_bin")
    )


@query(
    "h4_label_encode",
    f"""WITH {WIDE}, texts AS (SELECT item_id, dense_rank() OVER (ORDER BY CAST(item_id AS VARCHAR)) - 1
      AS item_text FROM (SELECT DISTINCT item_id FROM wide))
    SELECT uid AS raw_uid, dense_rank() OVER (ORDER BY uid) - 1 AS uid,
      dense_rank() OVER (ORDER BY item_id) - 1 AS item_id, dense_rank() OVER (ORDER BY music_id) - 1 AS music_id,
      item_text FROM wide JOIN texts USING (item_id)""",
)
def h4(spark, d):
    log = wide(spark, d).select(
        F.col("uid").alias("raw_uid"), "uid", "item_id", "music_id", F.col("item_id").alias("item_text")
    )
    numbers = encoding.fit_dictionary(log, ["uid", "item_id", "music_id"])
    texts = encoding.fit_dictionary(log, ["item_text"], as_text=True)
    coded = encoding.encode(log, numbers, ["uid", "item_id", "music_id"])
    return encoding.encode(coded, texts, ["item_text"])


@query(
    "h4_fraction_codes",
    """SELECT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_extendedprice) - 1 AS price
    FROM lineitem""",
)
def h4_fractions(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return encoding.encode(lines, encoding.fit_dictionary(lines, ["price"]), ["price"])


@query(
    "h5_label_encode_from_one",
    """SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) AS segment,
    dense_rank() OVER (ORDER BY c_nationkey) AS nation,
    (SELECT count(DISTINCT c_mktsegment) + 1 FROM customer) AS segment_size FROM customer""",
)
def h5(spark, d):
    customers = table(spark, d, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    )
    fitted = encoding.fit_dictionary(customers, ["segment", "nation"], offset=1)
    size = encoding.feature_dictionary(fitted, "segment").agg(F.max("code") + 1).first()[0]
    return encoding.encode(customers, fitted, ["segment", "nation"]).withColumn(
        "segment_size", F.lit(size).cast("long")
    )


@query(
    "h6_one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS status_0,
    CAST(o_orderstatus = 'O' AS INTEGER) AS status_1, CAST(o_orderstatus = 'P' AS INTEGER) AS status_2
    FROM orders""",
)
def h6(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    fitted = encoding.fit_dictionary(orders, ["status"], as_text=True)
    return encoding.one_hot(encoding.encode(orders, fitted, ["status"]), ["status"], fitted)


@query(
    "h7_unknown_codes",
    """WITH known AS (SELECT source, dense_rank() OVER (ORDER BY source) - 1 AS code
      FROM (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1))
    SELECT doc_id, coalesce(code, -1) AS code, coalesce(known.source, 'unknow') AS source
    FROM documents LEFT JOIN known ON documents.source = known.source""",
)
def h7(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "source")
    toxic = table(spark, d, "labels").where("toxic = 1").select("doc_id")
    fitted = encoding.fit_dictionary(documents.join(toxic, "doc_id"), ["source"])
    coded = encoding.encode(documents, fitted, ["source"], unknown=-1)
    both = coded.withColumn("code", F.col("source"))
    return encoding.decode(both, fitted, ["source"]).select("doc_id", "code", "source")


@query(
    "c5_lookup_with_default",
    """SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
)
def c5(spark, d):
    labels = table(spark, d, "labels")
    documents = table(spark, d, "documents").select("doc_id")
    return encoding.lookup(documents, labels, "doc_id", "quality", -1)


COUNTS = ", ".join(
    f"{name} AS (SELECT {key} AS k, count(*) AS cnt FROM keyed GROUP BY 1)"
    for name, key in (("c1", "uid"), ("c2", "item_id"), ("c3", "uid_item"))
)
KEYED = "keyed AS (SELECT *, concat(uid, '-', item_id) AS uid_item FROM clicks)"
COUNTED = f"""{KEYED}, {COUNTS}, counted AS (
    SELECT event_id, c1.cnt AS uid_cnt, c2.cnt AS item_id_cnt, c3.cnt AS uid_item_cnt FROM keyed
    JOIN c1 ON keyed.uid = c1.k JOIN c2 ON keyed.item_id = c2.k JOIN c3 ON keyed.uid_item = c3.k)"""


@query(
    "d1_count_encoding",
    f"""WITH {CLICKS}, {COUNTED}, {qcut_sql('counted', 'uid_cnt', 10, 'q1')},
    {qcut_sql('counted', 'item_id_cnt', 10, 'q2')}, {qcut_sql('counted', 'uid_item_cnt', 10, 'q3')}
    SELECT event_id, {bin_sql('uid_cnt', 'q1.edges')} AS uid_cnt,
      {bin_sql('item_id_cnt', 'q2.edges')} AS item_id_cnt,
      {bin_sql('uid_item_cnt', 'q3.edges')} AS uid_item_cnt
    FROM counted CROSS JOIN q1 CROSS JOIN q2 CROSS JOIN q3""",
)
def d1(spark, d):
    log = clicks(spark, d).withColumn("uid_item", F.concat_ws("-", "uid", "item_id"))
    log = log.select("event_id", "uid", "item_id", "uid_item")
    keys = ["uid", "item_id", "uid_item"]
    coded = counting.count_encode(log, counting.fit_counts(log, keys), keys, bins=10)
    return coded.select("event_id", *[f"{k}_cnt" for k in keys])


def _halves(df, order):
    """Two days of a table: what is fitted on each is merged."""
    return df.where(F.col(order) % 3 != 0), df.where(F.col(order) % 3 == 0)


@query("d1_merged_counts", ORACLES["d1_count_encoding"])
def d1_merged(spark, d):
    log = clicks(spark, d).withColumn("uid_item", F.concat_ws("-", "uid", "item_id"))
    keys = ["uid", "item_id", "uid_item"]
    fitted = merging.merge_counts(*[counting.fit_counts(half, keys) for half in _halves(log, "event_id")])
    coded = counting.count_encode(log.select("event_id", *keys), fitted, keys, bins=10)
    return coded.select("event_id", *[f"{k}_cnt" for k in keys])


@query("h1_merged_scale", ORACLES["h1_standard_scale"])
def h1_merged(spark, d):
    log = wide(spark, d).select("uid", "item_id", "time", "duration_time")
    columns = ["time", "duration_time"]
    moments = merging.merge_moments(*[merging.fit_moments(half, columns) for half in _halves(log, "time")])
    scaled = scaling.standard_scale(log, merging.standard_of(moments))
    return scaled.select("uid", "item_id", *[r6(c).alias(c) for c in columns])


@query(
    "a11_extended_dictionary",
    f"""WITH {CLICKS}, days AS (SELECT event_id % 3 = 0 AS later, item_id AS v FROM clicks),
    old AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM days WHERE NOT later)),
    new AS (SELECT v, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT v FROM days WHERE later AND v NOT IN (SELECT v FROM old))),
    n AS (SELECT v, count(*) AS n FROM days GROUP BY 1)
    SELECT v AS item_id, code, n FROM (SELECT * FROM old UNION ALL SELECT * FROM new) JOIN n USING (v)""",
)
def a11_extended(spark, d):
    """The dictionary of two days: old codes stay, new items come behind."""
    early, late = _halves(clicks(spark, d), "event_id")
    merged = merging.merge_dictionary(*[encoding.fit_dictionary(half, ["item_id"]) for half in (early, late)])
    return merged.select(F.col("number").alias("item_id"), "code", "n")


FEW = {"uid": ["channel", "finish"], "item_id": ["channel"], "channel": ["finish", "liked"]}


# few values per key: there a sketch is exact
@query(
    "d3_sketched_counts",
    f"WITH {CLICKS} "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS feature, CAST({k} AS VARCHAR) AS key, count(*) AS n, '{v}' AS value, count(DISTINCT {v}) AS distinct_values FROM clicks GROUP BY {k}"
        for k, own in FEW.items()
        for v in own
    ),
)
def d3_sketched(spark, d):
    days = _halves(clicks(spark, d), "event_id")
    merged = merging.merge_sketches(*[counting.fit_distinct_sketches(day, FEW) for day in days])
    counts = counting.sketched_counts(merged, FEW)
    entries = [F.struct(F.lit(k).alias("of"), F.lit(v).alias("value"), F.col(f"{k}_{v}_nunique").alias("distinct_values")) for k, own in FEW.items() for v in own]
    return counts.select("feature", "key", "n", F.inline(F.array(*entries))).where("feature = of").drop("of")


PAIRS = [(k, v) for k, values in competition.DISTINCT.items() for v in values]


@query(
    "d3_distinct_count_encoding",
    f"WITH {WIDE}, "
    + ", ".join(
        f"n{i} AS (SELECT {k} AS k, count(DISTINCT {v}) AS c, count(*) AS n FROM wide GROUP BY 1)"
        for i, (k, v) in enumerate(PAIRS)
    )
    + ", "
    + ", ".join(
        qcut_sql(
            f"(SELECT c FROM n{i} JOIN wide ON n{i}.k = wide.{k})",
            "c",
            competition.DISTINCT_BINS[f"{k}_{v}_nunique"],
            f"q{i}",
        )
        for i, (k, v) in enumerate(PAIRS)
    )
    + ", "
    + ", ".join(
        f"b{i} AS (SELECT k, {bin_sql('c', f'q{i}.edges')} AS c FROM n{i} CROSS JOIN q{i})"
        for i in range(len(PAIRS))
    )
    + " SELECT uid, item_id, author_id, "
    + ", ".join(f"b{i}.c AS {k}_{v}_nunique" for i, (k, v) in enumerate(PAIRS))
    + " FROM wide "
    + " ".join(f"JOIN b{i} ON wide.{k} = b{i}.k" for i, (k, v) in enumerate(PAIRS)),
)
def d3(spark, d):
    # read by the fit and its joins, so the tables are joined once
    columns = list(dict.fromkeys(c for pair in PAIRS for c in pair))
    features = competition.distinct_features(materialize(wide(spark, d).select(*columns), "wide"))
    return features.select("uid", "item_id", "author_id", *[f"{k}_{v}_nunique" for k, v in PAIRS])


def parts(spark, d):
    """The first 80 % of the clicks in order, and the others."""
    return splits.ordered_split(clicks(spark, d), "us", "event_id", 0.2)


def _both(train, test, columns):
    train = train.select(F.lit("train").alias("part"), "event_id", *columns)
    return train.unionByName(test.select(F.lit("test").alias("part"), "event_id", *columns))


@query(
    "d5_positive_counts",
    f"""WITH {PARTS}, s AS (SELECT uid, CAST(sum(finish) AS DOUBLE) AS total FROM train GROUP BY 1),
    i AS (SELECT item_id, CAST(sum(finish) AS DOUBLE) AS total FROM train GROUP BY 1)
    SELECT 'train' AS part, event_id, round(s.total - finish, 6) AS uid_finish_cnt,
      round(i.total - finish, 6) AS item_id_finish_cnt FROM train JOIN s USING (uid) JOIN i USING (item_id)
    UNION ALL SELECT 'test', event_id, round(coalesce(s.total, (SELECT avg(total) FROM s)), 6),
      round(coalesce(i.total, (SELECT avg(total) FROM i)), 6)
    FROM test LEFT JOIN s USING (uid) LEFT JOIN i USING (item_id)""",
)
def d5(spark, d):
    keys = ["uid", "item_id"]
    train, test = parts(spark, d)
    fitted = target.fit_target(train, keys, "finish")
    columns = [r6(F.col(f"{k}_finish_cnt").cast("double")).alias(f"{k}_finish_cnt") for k in keys]
    return _both(
        target.positive_count_train(train, fitted, keys, "finish"),
        target.positive_count_test(test, fitted, keys, "finish"),
        columns,
    )


@query("d5_merged_counts", ORACLES["d5_positive_counts"])
def d5_merged(spark, d):
    keys = ["uid", "item_id"]
    train, test = parts(spark, d)
    fitted = merging.merge_target(*[target.fit_target(half, keys, "finish") for half in _halves(train, "event_id")])
    columns = [r6(F.col(f"{k}_finish_cnt").cast("double")).alias(f"{k}_finish_cnt") for k in keys]
    return _both(
        target.positive_count_train(train, fitted, keys, "finish"), target.positive_count_test(test, fitted, keys, "finish"), columns
    )


FOLD_DRAW = "((event_id * 7919 + 918) % 1000003)"


@query(
    "l5_stratified_folds",
    f"""WITH {CLICKS} SELECT event_id, finish, CAST((row_number() OVER (PARTITION BY finish
    ORDER BY {FOLD_DRAW}, event_id) - 1) % 5 AS INTEGER) AS fold FROM clicks""",
)
def l5(spark, d):
    number = (F.col("event_id") * 7919 + 918) % 1_000_003
    folds = splits.stratified_folds(clicks(spark, d), "finish", "event_id", number, 5, 1_000_003)
    return folds.select("event_id", "finish", "fold")


@query(
    "d6_fold_means",
    f"""WITH {PARTS}, folded AS (SELECT *, (row_number() OVER (PARTITION BY finish
      ORDER BY {FOLD_DRAW}, event_id) - 1) % 5 AS fold FROM train),
    p AS (SELECT avg(finish) AS prior FROM train),
    k AS (SELECT uid, item_id, fold, event_id, finish,
      sum(finish) OVER (PARTITION BY item_id) - sum(finish) OVER (PARTITION BY item_id, fold) AS s,
      count(*) OVER (PARTITION BY item_id) - count(*) OVER (PARTITION BY item_id, fold) AS n FROM folded),
    m AS (SELECT item_id, avg(finish) AS mean FROM train GROUP BY 1)
    SELECT 'train' AS part, event_id, round(coalesce(s / nullif(n, 0), prior), 6) AS item_id_finish_mean
    FROM k CROSS JOIN p
    UNION ALL SELECT 'test', event_id, round(coalesce(mean, prior), 6)
    FROM test LEFT JOIN m USING (item_id) CROSS JOIN p""",
)
def d6(spark, d):
    train, test = parts(spark, d)
    number = (F.col("event_id") * 7919 + 918) % 1_000_003
    train = splits.stratified_folds(train, "finish", "event_id", number, 5, 1_000_003)
    keys = ["item_id"]
    fitted = target.fit_target(train, keys, "finish")
    by_fold = target.fit_fold_target(train, keys, "finish", "fold")
    return _both(
        target.fold_mean_train(train, fitted, by_fold, keys, "finish", "fold"),
        target.mean_test(test, fitted, keys, "finish"),
        [r6("item_id_finish_mean").alias("item_id_finish_mean")],
    )


@query(
    "d7_smoothed_means",
    f"""WITH {PARTS}, p AS (SELECT avg(finish) AS prior FROM train),
    m AS (SELECT uid, (count(*) * avg(finish) + 300 * any_value(prior)) / (count(*) + 300) AS mean
      FROM train CROSS JOIN p GROUP BY 1)
    SELECT 'train' AS part, event_id, round(mean, 6) AS uid_finish_mean FROM train JOIN m USING (uid)
    UNION ALL SELECT 'test', event_id, round(coalesce(mean, prior), 6)
    FROM test LEFT JOIN m USING (uid) CROSS JOIN p""",
)
def d7(spark, d):
    train, test = parts(spark, d)
    fitted = target.fit_target(train, ["uid"], "finish")
    return _both(
        target.smooth_mean(train, fitted, ["uid"], "finish"),
        target.smooth_mean(test, fitted, ["uid"], "finish"),
        [r6("uid_finish_mean").alias("uid_finish_mean")],
    )


@query(
    "d8_leave_one_out_means",
    f"""WITH {PARTS}, keyed AS (SELECT *, concat(uid, '-', item_id) AS k FROM train),
    p AS (SELECT avg(finish) AS prior FROM train),
    m AS (SELECT k, sum(finish) AS s, count(*) AS c FROM keyed GROUP BY 1)
    SELECT 'train' AS part, event_id, round(coalesce((s - finish) / nullif(c - 1, 0), prior), 6)
      AS pair_finish_mean FROM keyed JOIN m USING (k) CROSS JOIN p
    UNION ALL SELECT 'test', event_id, round(coalesce(s / c, prior), 6)
    FROM (SELECT *, concat(uid, '-', item_id) AS k FROM test) LEFT JOIN m USING (k) CROSS JOIN p""",
)
def d8(spark, d):
    train, test = (
        part.withColumn("pair", F.concat_ws("-", "uid", "item_id")) for part in parts(spark, d)
    )
    fitted = target.fit_target(train, ["pair"], "finish")
    return _both(
        target.leave_one_out_train(train, fitted, ["pair"], "finish"),
        target.mean_test(test, fitted, ["pair"], "finish"),
        [r6("pair_finish_mean").alias("pair_finish_mean")],
    )


def _expanding(key):
    return f"""round(coalesce(avg(finish) OVER (PARTITION BY {key} ORDER BY us, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), prior), 6)"""


@query(
    "e1_expanding_means",
    f"""WITH {PARTS}, p AS (SELECT avg(finish) AS prior FROM train),
    u AS (SELECT uid, avg(finish) AS mean FROM train GROUP BY 1),
    i AS (SELECT item_id, avg(finish) AS mean FROM train GROUP BY 1),
    c AS (SELECT uid, channel, avg(finish) AS mean FROM train GROUP BY 1, 2)
    SELECT 'train' AS part, event_id, {_expanding('uid')} AS uid_finish_mean,
      {_expanding('item_id')} AS item_id_finish_mean,
      {_expanding('uid, channel')} AS uid_channel_finish_mean FROM train CROSS JOIN p
    UNION ALL SELECT 'test', event_id, round(coalesce(u.mean, prior), 6),
      round(coalesce(i.mean, prior), 6), round(coalesce(c.mean, prior), 6)
    FROM test LEFT JOIN u USING (uid) LEFT JOIN i USING (item_id) LEFT JOIN c USING (uid, channel)
    CROSS JOIN p""",
)
def e1(spark, d):
    keys = ["uid", "item_id", "uid_channel"]
    train, test = (
        part.withColumn("uid_channel", F.concat_ws("-", "uid", "channel")) for part in parts(spark, d)
    )
    fitted = target.fit_target(train, keys, "finish")
    return _both(
        target.expanding_mean_train(train, fitted, keys, "finish", ["us", "event_id"]),
        target.mean_test(test, fitted, keys, "finish"),
        [r6(f"{k}_finish_mean").alias(f"{k}_finish_mean") for k in keys],
    )


@query(
    "e7_dense_rank",
    """SELECT DISTINCT o_totalprice AS price, dense_rank() OVER (ORDER BY o_totalprice) - 1 AS place
    FROM orders""",
)
def e7(spark, d):
    from ..operators.ordering import global_rank

    prices = table(spark, d, "orders").select(F.col("o_totalprice").alias("price")).distinct()
    return global_rank(prices, ["price"], "place")


@query(
    "c3_aggregate_lookup",
    f"""WITH {PARTS}, m AS (SELECT item_id, avg(duration) AS mean, count(*) AS c FROM train GROUP BY 1)
    SELECT event_id, round(coalesce(mean, 0), 6) AS item_mean, coalesce(c, 0) AS item_rows
    FROM test LEFT JOIN m USING (item_id)""",
)
def c3(spark, d):
    from ..operators.skew import attach
    from ..storage import materialize

    train, test = parts(spark, d)
    means = train.groupBy("item_id").agg(
        F.avg("duration").alias("mean"), F.count(F.lit(1)).alias("item_rows"), F.count(F.lit(1)).alias("n")
    )
    joined = attach(test, materialize(means, "means"), ["item_id"])
    return joined.select(
        "event_id",
        r6(F.coalesce("mean", F.lit(0.0))).alias("item_mean"),
        F.coalesce("item_rows", F.lit(0)).alias("item_rows"),
    )

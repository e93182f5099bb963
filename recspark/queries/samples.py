"""Histories, splits, negatives, profiles."""

from pyspark.sql import functions as F

from ..operators import samples, splits
from ..operators.features import FeatureProcessor, FeatureSpec
from ..plans import ranking_dataset, recall
from ..session import table
from ..storage import materialize
from .base import CLICKS, clicks, joined, query, r6
from .encoding import parts
from .sequences import BUNDLE, EARLIER, HISTORY, SPEC, _histories, _parts, _recent

ORDER = ["us", "event_id"]


def _log(spark, d):
    return clicks(spark, d).select("event_id", "uid", "item_id", "us")


@query(
    "e2_first_events",
    f"""WITH {CLICKS} SELECT event_id, uid, item_id,
    row_number() OVER (PARTITION BY uid ORDER BY us, event_id) - 1 AS place FROM clicks QUALIFY place < 50""",
)
def e2(spark, d):
    first = samples.first_events(_log(spark, d), "uid", ORDER, 50)
    return first.select("event_id", "uid", "item_id", F.col("place").cast("long").alias("place"))


@query(
    "e3_prefix_history",
    f"""WITH {HISTORY} SELECT event_id, uid, item_id,
    array_to_string(list_reverse(earlier), ',') AS history FROM histories""",
)
def e3(spark, d):
    rows = _histories(spark, d)
    return rows.select("event_id", "uid", "item_id", joined("history").alias("history"))


@query(
    "e4_leave_last_out",
    f"""WITH {HISTORY}, sized AS (SELECT *, count(*) OVER (PARTITION BY uid) AS events FROM histories)
    SELECT event_id, uid, item_id, CASE WHEN place = events - 1 THEN 'test' ELSE 'train' END AS split
    FROM sized WHERE place >= 1""",
)
def e4(spark, d):
    rows = samples.leave_last_out(_histories(spark, d))
    return rows.select("event_id", "uid", "item_id", "split")


@query(
    "e5_history_length",
    f"WITH {HISTORY} SELECT event_id, CAST(len(earlier) AS INTEGER) AS hist_len FROM histories",
)
def e5(spark, d):
    return _histories(spark, d).select("event_id", "hist_len")


BUCKET = "(doc_id * 7919 + 42) % 10007 % 1000"


def _bucket():
    return (F.col("doc_id") * 7919 + 42) % 10007 % 1000


@query(
    "l1_random_split",
    f"""SELECT doc_id, CASE WHEN {BUCKET} < 640 THEN 'train' WHEN {BUCKET} < 800 THEN 'valid'
    ELSE 'test' END AS part FROM documents""",
)
def l1(spark, d):
    documents = table(spark, d, "documents").select("doc_id")
    train, valid, test = splits.fraction_split(documents, [0.64, 0.16, 0.2], _bucket(), 1000)
    named = train.select("doc_id", F.lit("train").alias("part"))
    named = named.unionAll(valid.select("doc_id", F.lit("valid")))
    return named.unionAll(test.select("doc_id", F.lit("test")))


@query(
    "l2_ordered_split",
    f"""WITH {CLICKS}, numbered AS (SELECT event_id, us, row_number() OVER (ORDER BY us, event_id) AS rn,
      count(*) OVER () AS n FROM clicks)
    SELECT event_id, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS part
    FROM numbered""",
)
def l2(spark, d):
    train, test = parts(spark, d)
    train = train.select("event_id", F.lit("train").alias("part"))
    return train.unionAll(test.select("event_id", F.lit("test")))


@query(
    "l3_tail_validation",
    f"""WITH {CLICKS}, a AS (SELECT event_id, us, row_number() OVER (ORDER BY us, event_id) AS rn,
      count(*) OVER () AS n FROM clicks),
    b AS (SELECT event_id, rn, CAST(floor(n * 0.8) AS BIGINT) AS m, n FROM a)
    SELECT event_id, CASE WHEN rn <= CAST(floor(m * 0.8) AS BIGINT) THEN 'train' WHEN rn <= m THEN 'valid'
      ELSE 'test' END AS part FROM b""",
)
def l3(spark, d):
    rest, test = splits.ordered_split(_log(spark, d), "us", "event_id", 0.2)
    train, valid = splits.ordered_split(rest, "us", "event_id", 0.2)
    named = train.select("event_id", F.lit("train").alias("part"))
    named = named.unionAll(valid.select("event_id", F.lit("valid")))
    return named.unionAll(test.select("event_id", F.lit("test")))


@query(
    "l4_fraction_split",
    """SELECT page_id, CAST((page_id * 7919 + 100) % 10007 < 6004 AS INTEGER) AS train FROM pages""",
)
def l4(spark, d):
    number = (F.col("page_id") * 7919 + 100) % 10007
    pages = table(spark, d, "pages").select("page_id")
    train, valid = splits.fraction_split(pages, [0.6, 0.4], number, 10007)
    return train.select("page_id", F.lit(1).alias("train")).unionAll(
        valid.select("page_id", F.lit(0))
    )


@query(
    "l7_shuffle",
    "SELECT doc_id, lang FROM documents ORDER BY (doc_id * 7919 + 100) % 10007, doc_id",
)
def l7(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang")
    return splits.shuffled(documents, (F.col("doc_id") * 7919 + 100) % 10007, "doc_id")


def sql_draw(place, repeat):
    """The draw that SQL can repeat: small whole numbers only."""
    return F.col("uid") * 7919 + place * 104729 + repeat * 1299709


NEGATIVES = 3
MIN_COUNT = "(SELECT count(*) // count(DISTINCT item_id) FROM clicks)"


def min_count(log):
    """An item is popular with more rows than items have on average."""
    rows, items = log.agg(F.count(F.lit(1)), F.count_distinct("item_id")).first()
    return rows // items


SAMPLES = f"""{HISTORY}, sized AS (SELECT *, count(*) OVER (PARTITION BY uid) AS events FROM histories),
  used AS (SELECT *, CASE WHEN place = events - 1 THEN 'test' ELSE 'train' END AS split
    FROM sized WHERE place >= 1),
  popular AS (SELECT item_id FROM clicks GROUP BY 1 HAVING count(*) > {MIN_COUNT}),
  candidates AS (SELECT u.uid, list(p.item_id ORDER BY p.item_id) AS items
    FROM (SELECT DISTINCT uid FROM histories) u CROSS JOIN popular p
    WHERE NOT EXISTS (SELECT 1 FROM histories h WHERE h.uid = u.uid AND h.item_id = p.item_id) GROUP BY 1),
  drawn AS (SELECT used.*, items[1 + (uid * 7919 + place * 104729 + j * 1299709) % len(items)] AS negative
    FROM used JOIN candidates USING (uid) CROSS JOIN range({NEGATIVES}) r(j) WHERE split = 'train'),
  samples AS (
    SELECT uid, list_reverse(earlier) AS history, item_id, 1 AS label, place AS hist_len, split FROM used
    UNION ALL
    SELECT uid, list_reverse(earlier), negative, 0, place, split FROM drawn)"""


_LABELLED = "r AS (SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id))"


def _labelled(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return table(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left")


@query(
    "l2_split_of_unplaced_rows",
    f"""WITH {_LABELLED}, s AS (SELECT *, count(*) OVER () AS n,
      row_number() OVER (ORDER BY quality NULLS FIRST, doc_id) AS rn FROM r)
    SELECT doc_id, CASE WHEN quality IS NULL OR rn <= CAST(floor(n * (1 - 0.05::DOUBLE)) AS BIGINT)
      THEN 'early' ELSE 'late' END AS part FROM s""",
)
def l2_unplaced(spark, d):
    early, late = splits.ordered_split(_labelled(spark, d), "quality", "doc_id", 0.05)
    return early.select("doc_id", F.lit("early").alias("part")).unionAll(late.select("doc_id", F.lit("late")))


@query(
    "l5_folds_of_unlabelled_rows",
    f"""WITH {_LABELLED} SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality
      ORDER BY doc_id % 1000, doc_id) - 1) % 5 AS INTEGER) AS fold FROM r""",
)
def l5_unlabelled(spark, d):
    rows = splits.stratified_folds(_labelled(spark, d), "quality", "doc_id", F.col("doc_id") % 1000, 5, 1000)
    return rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "fold")


@query(
    "l6_negative_samples",
    f"""WITH {SAMPLES} SELECT uid, array_to_string(history, ',') AS history, item_id, label,
    CAST(hist_len AS INTEGER) AS hist_len, split FROM samples""",
)
def l6(spark, d):
    log = _log(spark, d)
    rows = samples.training_samples(
        log, "uid", "item_id", ORDER, min_count(log), NEGATIVES, sql_draw
    )
    return rows.withColumn("history", joined("history"))


@query(
    "l8_model_rows",
    f"""WITH {SAMPLES}, u AS (SELECT uid, channel AS user_channel FROM clicks
      QUALIFY row_number() OVER (PARTITION BY uid ORDER BY us, event_id) = 1),
    i AS (SELECT item_id, channel AS item_channel, round(duration, 6) AS item_duration FROM clicks
      QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY us, event_id) = 1)
    SELECT uid, item_id, array_to_string(list_resize(history[:15], 15, 0), ',') AS history, label,
      CAST(hist_len AS INTEGER) AS hist_len, split, user_channel, item_channel, item_duration
    FROM samples LEFT JOIN u USING (uid) LEFT JOIN i USING (item_id)""",
)
def l8(spark, d):
    log = clicks(spark, d).select(
        "event_id",
        "uid",
        "item_id",
        "us",
        F.col("channel").alias("user_channel"),
        F.col("channel").alias("item_channel"),
        F.round("duration", 6).alias("item_duration"),
    )
    rows = recall.sample_rows(
        log,
        "uid",
        "item_id",
        ORDER,
        ["user_channel"],
        ["item_channel", "item_duration"],
        min_count(log),
        NEGATIVES,
        draw=sql_draw,
    )
    return rows.withColumn("history", joined("history"))


@query(
    "c4_attach_profiles",
    f"""WITH {CLICKS}, u AS (SELECT uid, channel AS user_channel FROM clicks
      QUALIFY row_number() OVER (PARTITION BY uid ORDER BY us, event_id) = 1),
    i AS (SELECT item_id, finish AS item_finish FROM clicks
      QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY us, event_id) = 1)
    SELECT event_id, user_channel, item_finish
    FROM clicks LEFT JOIN u USING (uid) LEFT JOIN i USING (item_id)""",
)
def c4(spark, d):
    log = clicks(spark, d)
    users = samples.fit_profile(log.withColumnRenamed("channel", "user_channel"), "uid", ["user_channel"], ORDER)
    items = samples.fit_profile(log.withColumnRenamed("finish", "item_finish"), "item_id", ["item_finish"], ORDER)
    rows = samples.attach_profiles(log.select("event_id", "uid", "item_id"), users, "uid", items, "item_id")
    return rows.select("event_id", "user_channel", "item_finish")


@query(
    "c6_popular_unseen",
    f"""WITH {HISTORY}, popular AS (SELECT item_id, count(*) AS n FROM clicks GROUP BY 1 HAVING count(*) > {MIN_COUNT}),
    ranked AS (SELECT u.uid, p.item_id, row_number() OVER (PARTITION BY u.uid ORDER BY p.n DESC, p.item_id) - 1 AS place
      FROM (SELECT DISTINCT uid FROM histories) u CROSS JOIN popular p
      WHERE NOT EXISTS (SELECT 1 FROM histories h WHERE h.uid = u.uid AND h.item_id = p.item_id))
    SELECT uid, CAST(place AS INTEGER) AS place, item_id FROM ranked WHERE place < 10""",
)
def c6(spark, d):
    log = _log(spark, d)
    return samples.top_unseen(log, "uid", "item_id", ORDER, min_count(log), 10)


@query(
    "c6_anti_join",
    f"""WITH {CLICKS} SELECT DISTINCT uid, item_id FROM clicks a WHERE channel = 'view' AND NOT EXISTS
    (SELECT 1 FROM clicks b WHERE b.uid = a.uid AND b.item_id = a.item_id AND b.finish = 1)""",
)
def c6_anti(spark, d):
    log = clicks(spark, d)
    viewed = log.where("channel = 'view'").select("uid", "item_id").distinct()
    return samples.unseen_pairs(viewed, log.where("finish = 1"), "uid", "item_id")


@query(
    "ranking_dataset_parts",
    f"""WITH {BUNDLE} SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand,
    array_to_string(list_resize(ids, (SELECT max(len(ids)) FROM rows), 0), ',') AS p_name
    FROM part JOIN rows USING (p_partkey)""",
)
def dataset(spark, d):
    _, _, rows = ranking_dataset.build(_parts(spark, d), SPEC)
    whole = rows[0].unionAll(rows[1]).unionAll(rows[2])
    return whole.select("p_partkey", "p_brand", joined("p_name").alias("p_name"))


HISTORY_SPEC = FeatureSpec(
    key="event_id",
    dense=["us", "duration"],
    sparse=["uid", "item_id", "item_city"],
    histories={"history_item_ids": "item_id", "history_citys": "item_city"},
)


def _with_histories(spark, d):
    last = _recent(spark, d, 5)
    cities = F.transform("items", lambda x: x % 11)
    lists = last.select("event_id", joined("items").alias("history_item_ids"), joined(cities).alias("history_citys"))
    log = clicks(spark, d).select("event_id", "uid", "item_id", (F.col("item_id") % 11).alias("item_city"), "us", "duration")
    return materialize(log.join(lists, "event_id"), "histories")


def _coded_history(main: str, value: str) -> str:
    return f"""(SELECT event_id, list(code ORDER BY pos) AS ids FROM
      (SELECT event_id, {value} AS v, pos FROM cells) JOIN d_{main} USING (v) GROUP BY 1)"""


@query(
    "ranking_dataset_histories",
    f"""WITH {EARLIER}, rows AS (SELECT c.event_id, c.uid, c.item_id, c.item_id % 11 AS item_city, us, duration FROM clicks c),
    d_uid AS (SELECT uid AS v, row_number() OVER (ORDER BY uid) - 1 AS code FROM (SELECT DISTINCT uid FROM rows)),
    d_item_id AS (SELECT item_id AS v, row_number() OVER (ORDER BY item_id) - 1 AS code FROM (SELECT DISTINCT item_id FROM rows)),
    d_item_city AS (SELECT item_city AS v, row_number() OVER (ORDER BY item_city) - 1 AS code FROM (SELECT DISTINCT item_city FROM rows)),
    last AS (SELECT event_id, earlier[-5:] AS kept FROM histories),
    cells AS (SELECT event_id, unnest(kept) AS item, generate_subscripts(kept, 1) AS pos FROM last),
    s AS (SELECT avg(us) AS m1, stddev_pop(us) AS s1, avg(duration) AS m2, stddev_pop(duration) AS s2 FROM rows)
    SELECT CASE WHEN rows.event_id % 1000 < 640 THEN 'train' WHEN rows.event_id % 1000 < 800 THEN 'valid' ELSE 'test' END AS part,
      rows.event_id, a.code AS uid, b.code AS item_id, c.code AS item_city, round((us - m1) / s1, 6) AS us,
      round((duration - m2) / s2, 6) AS duration,
      array_to_string(list_resize(coalesce(h.ids, []), 5, 0), ',') AS history_item_ids,
      array_to_string(list_resize(coalesce(k.ids, []), 5, 0), ',') AS history_citys
    FROM rows CROSS JOIN s JOIN d_uid a ON a.v = uid JOIN d_item_id b ON b.v = item_id JOIN d_item_city c ON c.v = item_city
    LEFT JOIN {_coded_history('item_id', 'item')} h ON h.event_id = rows.event_id
    LEFT JOIN {_coded_history('item_city', 'item % 11')} k ON k.event_id = rows.event_id""",
)
def dataset_histories(spark, d):
    rows = _with_histories(spark, d)
    _, _, parts_ = ranking_dataset.build(rows, HISTORY_SPEC, number=F.col("event_id") % 1000, size=1000)
    named = ranking_dataset.named(parts_)
    return named.select(
        "part", "event_id", "uid", "item_id", "item_city", r6("us").alias("us"), r6("duration").alias("duration"),
        joined("history_item_ids").alias("history_item_ids"), joined("history_citys").alias("history_citys"),
    )


@query(
    "h16_history_spec",
    f"""WITH {CLICKS} SELECT 'dense' AS kind, unnest(['us', 'duration']) AS feat, NULL::BIGINT AS feat_num, NULL AS shared_with,
      NULL::INTEGER AS shared_index
    UNION ALL SELECT 'sparse', 'uid', (SELECT count(DISTINCT uid) FROM clicks), NULL, NULL
    UNION ALL SELECT 'sparse', 'item_id', (SELECT count(DISTINCT item_id) FROM clicks), NULL, NULL
    UNION ALL SELECT 'sparse', 'item_city', (SELECT count(DISTINCT item_id % 11) FROM clicks), NULL, NULL
    UNION ALL SELECT 'history', 'history_item_ids', NULL, 'item_id', 1
    UNION ALL SELECT 'history', 'history_citys', NULL, 'item_city', 2""",
)
def h16_histories(spark, d):
    return FeatureProcessor(HISTORY_SPEC).fit(_with_histories(spark, d)).feature_spec()

"""The competition's feature table as one run, on the click log with derived side columns."""

from pyspark.sql import functions as F

from ..operators import splits
from ..plans import competition
from ..session import table
from .base import CLICKS, bin_sql, clicks, qcut_sql, query, r6
from .encoding import PAIRS

SIZE = 64
CODED = competition.category_columns()
DENSE = competition.dense_columns("finish")


def _sql() -> str:
    """Each step of the feature table as a common table expression."""
    keys = {k: f'"{k}"' for k in [*competition.COUNT_KEYS, *competition.MEAN_KEYS]}
    bases = {f"{k}_cnt": ("n", k, "count(*)", 10) for k in competition.COUNT_KEYS}
    for k, v in PAIRS:
        bases[f"{k}_{v}_nunique"] = ("n", k, f"count(DISTINCT {v})", competition.DISTINCT_BINS[f"{k}_{v}_nunique"])
    steps = [CLICKS]
    composites = ", ".join(f"concat({a}, '-', {b}) AS \"{n}\"" for n, (a, b) in competition.COMPOSITES.items())
    steps.append("""log0 AS (SELECT event_id AS row, uid, uid % 25 AS user_city, item_id, item_id % 37 AS author_id,
      item_id % 11 AS item_city, length(channel) AS channel, CASE WHEN event_id % 10 > 0 THEN item_id * 7 % 13 END AS music_id,
      uid * 3 + event_id % 3 AS did, us // 1000000 AS time, duration AS duration_time, finish FROM clicks)""")
    steps.append("named AS (SELECT *, (time % 86400) / 3600.0 AS hour FROM log0)")
    steps.append(f"keyed AS (SELECT *, {composites} FROM named)")
    steps.append("placed AS (SELECT *, row_number() OVER (ORDER BY time, row) AS rn, count(*) OVER () AS rows FROM keyed)")
    steps.append("log AS (SELECT *, rn > CAST(floor(rows * 0.8) AS BIGINT) AS is_test FROM placed)")
    steps += [qcut_sql("log", "duration_time", 10, "qd"), qcut_sql("log", "hour", 24, "qh")]
    for i, (_, key, what, bins) in enumerate(bases.values()):
        name = keys.get(key, key)
        steps.append(f"c{i} AS (SELECT {name} AS k, {what} AS c FROM log GROUP BY 1)")
        steps.append(qcut_sql(f"(SELECT c FROM c{i} JOIN log ON c{i}.k = log.{name})", "c", bins, f"q{i}"))
        steps.append(f"b{i} AS (SELECT k, {bin_sql('c', f'q{i}.edges')} AS c FROM c{i} CROSS JOIN q{i})")
    steps.append("p AS (SELECT avg(finish) AS prior FROM log WHERE NOT is_test)")
    for i, key in enumerate(competition.MEAN_KEYS):
        steps.append(f"m{i} AS (SELECT {keys[key]} AS k, avg(finish) AS c FROM log WHERE NOT is_test GROUP BY 1)")
        earlier = f"avg(finish) OVER (PARTITION BY {keys[key]} ORDER BY time, row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        steps.append(f"e{i} AS (SELECT row, {earlier} AS c FROM log WHERE NOT is_test)")
    steps.append("t AS (SELECT p_partkey AS item, len(p_name) - 1 AS title_len, string_split(p_name, ' ') AS w FROM part WHERE p_size > 10)")
    steps.append("v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)")
    sums = [" + ".join(f"{i + 1} * coalesce({v}.e[{i + 1}], 0)" for i in range(SIZE)) for v in ("video", "audio")]
    plain = [c for c in competition.CATEGORIES if c not in ("video_duration", "creat_time")]
    columns = [f"log.{c}" for c in plain]
    columns += [f"{bin_sql('duration_time', 'qd.edges')} AS video_duration", f"{bin_sql('hour', 'qh.edges')} AS creat_time"]
    columns += [f'b{i}.c AS "{name}"' for i, name in enumerate(bases)]
    columns += [f'coalesce(CASE WHEN is_test THEN m{i}.c ELSE e{i}.c END, prior) AS "{k}_finish_mean"' for i, k in enumerate(competition.MEAN_KEYS)]
    columns.append("coalesce(title_len, (SELECT avg(title_len) FROM t)) AS title_len")
    columns.append("coalesce(array_to_string(w, ','), '') AS title_words")
    joins = [f"JOIN b{i} ON b{i}.k = log.{keys.get(base[1], base[1])}" for i, base in enumerate(bases.values())]
    joins += [f"LEFT JOIN m{i} ON m{i}.k = log.{keys[k]} LEFT JOIN e{i} ON e{i}.row = log.row" for i, k in enumerate(competition.MEAN_KEYS)]
    joins.append("LEFT JOIN t ON item = log.item_id LEFT JOIN v video ON video.vec_id = log.item_id LEFT JOIN v audio ON audio.vec_id = log.item_id + 100")
    table_ = f"whole AS (SELECT log.row, is_test, finish, {', '.join(columns)}, {sums[0]} AS video, {sums[1]} AS audio FROM log CROSS JOIN qd CROSS JOIN qh CROSS JOIN p {' '.join(joins)})"
    codes = [f'dense_rank() OVER (ORDER BY coalesce("{c}", -1)) - 1 AS "{c}"' for c in CODED]
    scaled = [f'round(("{c}" - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()), 6) AS "{c}"' for c in DENSE]
    shown = ["row", "is_test", "finish", *codes, *scaled, "title_words", "round(video, 4) AS video", "round(audio, 4) AS audio"]
    return f"WITH {', '.join([*steps, table_])} SELECT {', '.join(shown)} FROM whole"


@query("competition_features", _sql())
def features(spark, d):
    log = clicks(spark, d).select(
        F.col("event_id").alias("row"),
        "uid",
        (F.col("uid") % 25).alias("user_city"),
        "item_id",
        (F.col("item_id") % 37).alias("author_id"),
        (F.col("item_id") % 11).alias("item_city"),
        F.length("channel").alias("channel"),
        F.when(F.col("event_id") % 10 > 0, F.col("item_id") * 7 % 13).alias("music_id"),
        (F.col("uid") * 3 + F.col("event_id") % 3).alias("did"),
        F.floor(F.col("us") / 1_000_000).alias("time"),
        F.col("duration").alias("video_duration"),
        "finish",
    )
    log = log.withColumn("creat_time", F.col("time"))
    train, test = splits.ordered_split(log, "time", "row", 0.2)
    name = F.split("p_name", " ")
    titles = table(spark, d, "part").where("p_size > 10").select(
        F.col("p_partkey").alias("item_id"),
        F.map_from_arrays(name, F.transform(name, lambda w: F.length(w))).alias("title_features"),
    )
    vectors = table(spark, d, "embeddings")
    video = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    audio = vectors.select((F.col("vec_id") - 100).alias("item_id"), F.col("embedding").alias("vector"))
    rows = competition.features(train, test, "finish", ["time", "row"], titles, video, audio, SIZE)
    # one number stands for the columns of a vector
    sums = [F.round(sum((i + 1) * F.col(f"{p}{i}") for i in range(SIZE)), 4).alias(n) for p, n in (("vd", "video"), ("ad", "audio"))]
    return rows.select(
        "row",
        "is_test",
        "finish",
        *[F.col(f"`{c}`") for c in CODED],
        *[r6(F.col(f"`{c}`")).alias(c) for c in DENSE],
        F.array_join("title_words", ",").alias("title_words"),
        *sums,
    )

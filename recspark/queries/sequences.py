"""Vocabularies, id sequences, histories, feature bundle, list and number functions."""

from pyspark.sql import functions as F

from ..functions import arrays
from ..functions.text import TOKEN_FILTER, words
from ..operators import encoding, sequences
from ..operators.features import FeatureProcessor, FeatureSpec
from ..operators.skew import attach
from ..session import table
from ..storage import materialize, new_path
from .base import CLICKS, clicks, joined, query, r6

_FILTERED = TOKEN_FILTER.replace("\t", "").replace("\n", "").replace("'", "''")
_WORDS = (
    "list_filter(string_split(translate(lower(text), "
    f"'{_FILTERED}' || chr(9) || chr(10), '{' ' * len(TOKEN_FILTER)}'), ' '), lambda w: w <> '')"
)
TOKENS = f"""listed AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  tokens AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM listed)"""
VOCABULARY = """vocabulary AS (SELECT token, n,
    row_number() OVER (ORDER BY n DESC, first) + 1 AS id FROM
    (SELECT token, count(*) AS n, min((doc_id, pos)) AS first FROM tokens GROUP BY token))"""


@query(
    "h8_vocabulary",
    f"""WITH {TOKENS}, {VOCABULARY} SELECT token, id, n FROM vocabulary
    UNION ALL SELECT 'OOV', 1, 0""",
)
def h8(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return sequences.fit_vocabulary(documents, words(F.col("text")), ["doc_id"])


NAMES = """tokens AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token,
    generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part)"""


@query(
    "h9_padded_ids",
    f"""WITH {NAMES}, vocabulary AS (SELECT token,
      row_number() OVER (ORDER BY count(*) DESC, min((p_partkey, pos))) + 1 AS id FROM tokens GROUP BY token),
    rows AS (SELECT p_partkey, list(id ORDER BY pos) AS ids FROM tokens JOIN vocabulary USING (token)
      GROUP BY 1)
    SELECT p_partkey, array_to_string(list_resize(ids, (SELECT max(len(ids)) FROM rows), 0), ',') AS ids
    FROM rows""",
)
def h9(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    tokens = words(F.col("p_name"))
    vocabulary = sequences.fit_vocabulary(parts, tokens, ["p_partkey"])
    ids = sequences.sequence_ids(parts, ["p_partkey"], tokens, vocabulary, unknown=1)
    return sequences.pad_to_longest(ids, "ids").select("p_partkey", joined("ids").alias("ids"))


@query(
    "h10_first_seen_vocabulary",
    """WITH raw AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
    tokens AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM raw)
    SELECT token, row_number() OVER (ORDER BY min((doc_id, pos))) AS id, count(*) AS n
    FROM tokens GROUP BY token""",
)
def h10(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    tokens = arrays.split_list(F.col("text"), " ")
    return sequences.fit_first_seen_vocabulary(documents, tokens, ["doc_id"])


# per event the comma list of the user's items before it, at most the first 100
HISTORY = f"""{CLICKS}, placed AS (SELECT *, row_number() OVER w - 1 AS place FROM clicks
    WINDOW w AS (PARTITION BY uid ORDER BY us, event_id)),
  histories AS (SELECT event_id, uid, item_id, us, place,
    coalesce(list(item_id) OVER (PARTITION BY uid ORDER BY us, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS earlier FROM placed WHERE place < 100)"""


def _histories(spark, d):
    from ..operators.samples import prefix_histories

    log = clicks(spark, d).select("event_id", "uid", "item_id", "us")
    return prefix_histories(log, "uid", "item_id", ["us", "event_id"])


# the same of all events
EARLIER = HISTORY.replace(" FROM placed WHERE place < 100)", " FROM placed)")


def _recent(spark, d, length, keep="last"):
    from ..operators.samples import recent_items

    log = clicks(spark, d).select("event_id", "uid", "item_id", "us")
    return recent_items(log, "uid", "item_id", ["us", "event_id"], length, keep)


@query(
    "h11_history_codes",
    f"""WITH {EARLIER}, codes AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS code
      FROM (SELECT DISTINCT item_id FROM clicks)),
    last AS (SELECT event_id, earlier[-5:] AS kept FROM histories),
    cells AS (SELECT event_id, unnest(kept) AS item_id, generate_subscripts(kept, 1) AS pos FROM last),
    coded AS (SELECT event_id, list(code ORDER BY pos) AS ids FROM cells JOIN codes USING (item_id) GROUP BY 1)
    SELECT event_id, array_to_string(list_resize(coalesce(ids, []), 5, 0), ',') AS history
    FROM histories LEFT JOIN coded USING (event_id)""",
)
def h11(spark, d):
    log = clicks(spark, d)
    text = F.array_join(F.col("items").cast("array<string>"), ",").alias("history")
    rows = _recent(spark, d, 5).select("event_id", text)
    fitted = encoding.fit_dictionary(log, ["item_id"])
    values = encoding.feature_dictionary(fitted, "item_id")
    coded = sequences.history_codes(rows, ["event_id"], "history", values)
    return coded.select("event_id", joined("history").alias("history"))


@query(
    "h12_pad_and_truncate",
    f"""WITH {EARLIER} SELECT event_id,
    array_to_string(list_resize(earlier[-8:], 8, 0), ',') AS keep_last,
    array_to_string(list_resize(earlier[:8], 8, 0), ',') AS keep_first FROM histories""",
)
def h12(spark, d):
    # one item more than is kept, so that both cuts have something to cut
    last = _recent(spark, d, 9).select("event_id", joined(arrays.pad(F.col("items"), 8)).alias("keep_last"))
    first = _recent(spark, d, 9, keep="first")
    first = first.select("event_id", joined(arrays.pad(F.col("items"), 8, keep="first")).alias("keep_first"))
    return last.join(first, "event_id")


@query(
    "h13_valid_length",
    f"""WITH {EARLIER} SELECT event_id,
    CAST(len(list_filter(list_resize(earlier[-8:], 8, 0), lambda x: x <> 0)) AS INTEGER) AS valid
    FROM histories""",
)
def h13(spark, d):
    padded = arrays.pad(F.col("items"), 8)
    return _recent(spark, d, 8).select("event_id", arrays.valid_length(padded).alias("valid"))


@query(
    "h14_raw_id_history",
    f"""WITH {CLICKS}, lists AS (SELECT uid, list(item_id ORDER BY us, event_id) AS items
      FROM clicks GROUP BY 1)
    SELECT uid, array_to_string(list_resize(items[-5:], 5, 0), ',') AS history FROM lists""",
)
def h14(spark, d):
    last = sequences.last_items(clicks(spark, d), "uid", "item_id", ["us", "event_id"], 5)
    return last.select("uid", joined(arrays.pad(F.col("items"), 5)).alias("history"))


@query(
    "d9_user_item_list",
    f"""WITH {CLICKS}, placed AS (SELECT *, (row_number() OVER (PARTITION BY uid ORDER BY us, event_id) - 1)
      // 10000 AS chunk FROM clicks)
    SELECT uid, CAST(chunk AS INTEGER) AS chunk, string_agg(item_id, ',' ORDER BY us, event_id) AS items
    FROM placed GROUP BY 1, 2""",
)
def d9(spark, d):
    lists = sequences.user_items(clicks(spark, d), "uid", "item_id", ["us", "event_id"])
    return lists.select("uid", "chunk", joined("items").alias("items"))


@query(
    "c2_join_user_aggregate",
    f"""WITH {CLICKS}, lists AS (SELECT uid, list(item_id ORDER BY us, event_id)[-5:] AS items,
      count(*) AS rows FROM clicks GROUP BY 1)
    SELECT event_id, uid, rows, array_to_string(items, ',') AS last_items FROM clicks JOIN lists USING (uid)""",
)
def c2(spark, d):
    log = clicks(spark, d).select("event_id", "uid", "item_id", "us")
    rows = log.groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    last = sequences.last_items(log, "uid", "item_id", ["us", "event_id"], 5)
    fitted = materialize(last.join(rows, "uid").withColumn("rows", F.col("n")), "users")
    back = attach(log, fitted, ["uid"], how="inner")
    return back.select("event_id", "uid", "rows", joined("items").alias("last_items"))


SPEC = FeatureSpec(
    key="p_partkey", dense=["p_retailprice"], sparse=["p_brand", "p_size"], sequences=["p_name"], separator=" "
)
BUNDLE = f"""{NAMES}, vocabulary AS (SELECT token,
      row_number() OVER (ORDER BY count(*) DESC, min((p_partkey, pos))) + 1 AS id FROM tokens GROUP BY token),
    rows AS (SELECT p_partkey, list(id ORDER BY pos) AS ids FROM tokens JOIN vocabulary USING (token)
      GROUP BY 1)"""


def _parts(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_retailprice", "p_brand", "p_size", "p_name")


@query(
    "h15_feature_processor",
    f"""WITH {BUNDLE} SELECT p_partkey,
    round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice,
    dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand, dense_rank() OVER (ORDER BY p_size) - 1 AS p_size,
    array_to_string(list_resize(ids, (SELECT max(len(ids)) FROM rows), 0), ',') AS p_name
    FROM part JOIN rows USING (p_partkey)""",
)
def h15(spark, d):
    parts = _parts(spark, d)
    path = new_path(spark, "processor")
    FeatureProcessor(SPEC).fit(parts).save(path)
    coded = FeatureProcessor.load(spark, path, SPEC).transform(parts)
    return coded.select(
        "p_partkey", r6("p_retailprice").alias("p_retailprice"), "p_brand", "p_size", joined("p_name").alias("p_name")
    )


@query(
    "h16_feature_spec",
    f"""WITH {BUNDLE} SELECT 'dense' AS kind, 'p_retailprice' AS feat, NULL AS feat_num, NULL AS shared_with
    UNION ALL SELECT 'sparse', 'p_brand', (SELECT count(DISTINCT p_brand) FROM part), NULL
    UNION ALL SELECT 'sparse', 'p_size', (SELECT count(DISTINCT p_size) FROM part), NULL
    UNION ALL SELECT 'sequence', 'p_name', (SELECT count(*) + 2 FROM vocabulary), NULL""",
)
def h16(spark, d):
    return FeatureProcessor(SPEC).fit(_parts(spark, d)).feature_spec().drop("shared_index")


@query(
    "j1_split_list",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part",
)
def j1(spark, d):
    text = F.replace("p_name", F.lit(" "), F.lit("|"))
    return table(spark, d, "part").select("p_partkey", F.explode(arrays.split_list(text)).alias("token"))


@query(
    "j2_join_list",
    """SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ',') AS names FROM part""",
)
def j2(spark, d):
    names = F.reverse(F.split("p_name", " "))
    return table(spark, d, "part").select("p_partkey", arrays.join_list(names).alias("names"))


# word counts of a conversation turn: the title map of the click log
TURN = """words AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations),
  counts AS (SELECT conv_id, turn, word, count(*) AS n FROM words GROUP BY ALL)"""


def _turn_maps(spark, d):
    talks = table(spark, d, "conversations")
    counts = talks.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word"))
    counts = counts.groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).cast("int").alias("n"))
    entries = F.map_from_entries(F.collect_list(F.struct("word", "n")))
    return counts.groupBy("conv_id", "turn").agg(entries.alias("title_features"))


@query(
    "j3_map_sum",
    f"WITH {TURN} SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS title_len FROM counts GROUP BY 1, 2",
)
def j3(spark, d):
    total = arrays.map_sum(F.col("title_features")).alias("title_len")
    return _turn_maps(spark, d).select("conv_id", "turn", total)


@query(
    "j4_map_keys",
    f"""WITH {TURN}, keys AS (SELECT conv_id, turn, string_agg(word, ' ' ORDER BY word) AS words
      FROM counts GROUP BY 1, 2)
    SELECT conv_id, turn, CASE WHEN role = 'user' THEN words ELSE '' END AS words
    FROM keys JOIN conversations USING (conv_id, turn)""",
)
def j4(spark, d):
    some = F.when(F.col("role") == "user", F.col("title_features"))
    keys = F.array_sort(arrays.map_keys_or_empty(some))
    roles = table(spark, d, "conversations").select("conv_id", "turn", "role")
    turns = _turn_maps(spark, d).join(roles, ["conv_id", "turn"])
    return turns.select("conv_id", "turn", arrays.join_list(keys, " ").alias("words"))


@query(
    "j13_sigmoid_softmax",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    p AS (SELECT vec_id, e, list_transform(e, lambda x: exp(x - list_max(e))) AS powers FROM v)
    SELECT vec_id, round(1 / (1 + exp(-e[1])), 6) AS sigmoid,
    round(list_max(powers) / list_sum(powers), 6) AS top_weight,
    round(powers[1] / list_sum(powers), 6) AS first_weight FROM p""",
)
def j13(spark, d):
    vector = F.col("embedding").cast("array<double>")
    weights = arrays.softmax(F.col("e"))
    vectors = table(spark, d, "embeddings").select("vec_id", vector.alias("e"))
    return vectors.withColumn("w", weights).select(
        "vec_id",
        r6(arrays.sigmoid(F.get("e", 0))).alias("sigmoid"),
        r6(F.array_max("w")).alias("top_weight"),
        r6(F.get("w", 0)).alias("first_weight"),
    )

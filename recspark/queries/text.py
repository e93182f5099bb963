"""Text cleaning, words to indexes and vectors, word and item embeddings."""

from pyspark.sql import functions as F

from ..functions import arrays, text
from ..operators import cooccurrence, embeddings, sequences, skew
from ..session import table
from ..storage import materialize
from .base import CLICKS, clicks, query, r6
from .search import VECTORS

LETTERS = "A-Za-z"


def _documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query(
    "j8_keep_characters",
    f"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^{LETTERS}]', ' ', 'g'), ' {{2,}}', ' ', 'g'))
    AS text FROM documents""",
)
def j8(spark, d):
    return _documents(spark, d).withColumn("text", text.keep_characters(F.col("text"), LETTERS))


@query(
    "j9_characters",
    f"""SELECT doc_id, CAST(greatest(len(regexp_replace(text, '[^{LETTERS}]', '', 'g')), 1) AS INTEGER) AS size,
    md5(array_to_string(string_split(regexp_replace(text, '[^{LETTERS}]', '', 'g'), ''), ' ')) AS digest
    FROM documents""",
)
def j9(spark, d):
    parts = _documents(spark, d).select("doc_id", text.characters(F.col("text"), LETTERS).alias("c"))
    return parts.select("doc_id", F.size("c").alias("size"), F.md5(F.array_join("c", " ")).alias("digest"))


@query(
    "j10_strip_lines",
    r"""SELECT doc_id, array_to_string(list_filter(list_transform(
      string_split_regex(text, '\r\n|\r|\n'), lambda l: regexp_replace(l, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')),
      lambda l: l <> ''), chr(10)) AS text FROM documents""",
)
def j10(spark, d):
    return _documents(spark, d).withColumn("text", text.strip_lines(F.col("text")))


STOP = "stop AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark)"


@query(
    "j11_stop_words",
    f"""WITH {STOP}, cells AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
      generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM cells
      WHERE word NOT IN (SELECT word FROM stop) GROUP BY 1)
    SELECT doc_id, coalesce(kept.text, '') AS text FROM documents LEFT JOIN kept USING (doc_id)""",
)
def j11(spark, d):
    stop = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))
    kept = sequences.without_listed(_documents(spark, d), ["doc_id"], F.split("text", " "), stop)
    return kept.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query(
    "j12_pad_tokens",
    """SELECT p_partkey, array_to_string(list_resize(string_split(p_name, ' '), 4, '<PAD>'), ',') AS padded,
    split_part(p_name, ' ', 1) AS cut FROM part""",
)
def j12(spark, d):
    tokens = F.split("p_name", " ")
    return table(spark, d, "part").select(
        "p_partkey",
        F.array_join(arrays.pad(tokens, 4, "<PAD>", keep="first"), ",").alias("padded"),
        F.array_join(arrays.pad(tokens, 1, "<PAD>", keep="first"), ",").alias("cut"),
    )


TALKS = """tokens AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS token,
    generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations),
  vocabulary AS (SELECT token, count(*) AS n, row_number() OVER (ORDER BY min((conv_id, turn, pos))) AS id
    FROM tokens GROUP BY token)"""
KEY = ["conv_id", "turn"]


def _talks(spark, d):
    talks = table(spark, d, "conversations").select(*KEY, F.split("text", " ").alias("words"))
    return talks, sequences.fit_first_seen_vocabulary(talks, F.col("words"), KEY)


@query(
    "i4_words_to_indexes",
    f"""WITH {TALKS}, rows AS (SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM tokens
      JOIN (SELECT * FROM vocabulary WHERE n >= 2) USING (token) GROUP BY 1, 2),
    full_rows AS (SELECT conv_id, turn, list(coalesce(id, 0) ORDER BY pos) AS ids FROM tokens
      LEFT JOIN (SELECT * FROM vocabulary WHERE n >= 2) v USING (token) GROUP BY 1, 2)
    SELECT conv_id, turn, array_to_string(list_resize(ids, (SELECT max(len(ids)) FROM full_rows), 0), ',') AS ids
    FROM full_rows""",
)
def i4(spark, d):
    talks, vocabulary = _talks(spark, d)
    known = vocabulary.where("n >= 2")
    length = sequences.longest(talks, "words")
    rows = embeddings.index_rows(talks, KEY, F.col("words"), known, length)
    return rows.select(*KEY, F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    "i5_indexes_to_words",
    f"""WITH {TALKS} SELECT conv_id, turn, string_agg(CASE WHEN n >= 2 THEN token ELSE '<PAD>' END, ' '
    ORDER BY pos) AS words FROM tokens JOIN vocabulary USING (token) GROUP BY 1, 2""",
)
def i5(spark, d):
    talks, vocabulary = _talks(spark, d)
    known = vocabulary.where("n >= 2")
    rows = sequences.sequence_ids(talks, KEY, F.col("words"), known, 0)
    back = embeddings.index_words(rows, KEY, "ids", known)
    return back.select(*KEY, F.array_join("tokens", " ").alias("words"))


def _word_vectors(spark, d, vocabulary):
    """Given vectors for the first words of the vocabulary; other words have none."""
    vectors = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return materialize(vocabulary.join(vectors, "id").select("token", "vector", "n"), "vectors")


@query(
    "i6_words_to_vectors",
    f"""WITH {VECTORS}, {TALKS} SELECT conv_id, turn, CAST(pos - 1 AS INTEGER) AS pos,
    round(coalesce(e[1], 0), 6) AS first, round(coalesce(e[64], 0), 6) AS last
    FROM tokens JOIN vocabulary USING (token) LEFT JOIN v ON v.vec_id = vocabulary.id""",
)
def i6(spark, d):
    talks, vocabulary = _talks(spark, d)
    vectors = _word_vectors(spark, d, vocabulary)
    rows = embeddings.vector_rows(talks, KEY, F.col("words"), vectors, 64)
    first, last = F.get("vector", 0), F.get("vector", 63)
    return rows.select(*KEY, "pos", r6(first).alias("first"), r6(last).alias("last"))


# the vectors come from training; which words get one, and of what size, SQL can say
@query(
    "i1_word2vec",
    "SELECT DISTINCT unnest(string_split(text, ' ')) AS token, 100 AS size FROM conversations",
)
def i1(spark, d):
    talks = table(spark, d, "conversations").select(F.split("text", " ").alias("words"))
    vectors = embeddings.train_vectors(talks, "words", size=100, window=3, min_count=1)
    return vectors.select("token", F.size("vector").alias("size"))


@query(
    "i2_pair_similarity",
    f"""WITH {VECTORS}, pairs AS (SELECT DISTINCT concat('w', user_id) AS a,
      concat('w', regexp_extract(props, '[0-9]+')) AS b FROM events)
    SELECT a, b, round(list_dot_product(x.e, y.e)
      / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)), 6) AS similarity
    FROM pairs LEFT JOIN v x ON a = concat('w', x.vec_id) LEFT JOIN v y ON b = concat('w', y.vec_id)""",
)
def i2(spark, d):
    vectors = table(spark, d, "embeddings").select(
        F.concat(F.lit("w"), "vec_id").alias("token"), F.col("embedding").alias("vector")
    )
    words = [F.concat(F.lit("w"), F.col(c).cast("string")).alias(n) for c, n in (("uid", "a"), ("item_id", "b"))]
    pairs = clicks(spark, d).select(*words).distinct()
    found = embeddings.pair_similarity(pairs, vectors, "a", "b")
    return found.select("a", "b", r6("similarity").alias("similarity"))


@query(
    "i3_analogy",
    f"""WITH {VECTORS}, u AS (SELECT concat('w', vec_id) AS token,
      list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v),
    q AS (SELECT list_transform(list_zip(a.e, b.e, c.e), lambda p: (p[1] + p[2] - p[3]) / 3) AS e
      FROM u a, u b, u c WHERE a.token = 'w1' AND b.token = 'w2' AND c.token = 'w3')
    SELECT token, round(list_dot_product(u.e, q.e) / sqrt(list_dot_product(q.e, q.e)), 6) AS similarity
    FROM u CROSS JOIN q WHERE token NOT IN ('w1', 'w2', 'w3') ORDER BY similarity DESC, token LIMIT 10""",
)
def i3(spark, d):
    vectors = table(spark, d, "embeddings").select(
        F.concat(F.lit("w"), "vec_id").alias("token"), F.col("embedding").cast("array<double>").alias("vector")
    )
    near = embeddings.analogy(vectors, ["w1", "w2"], ["w3"])
    return near.select("token", r6("similarity").alias("similarity"))


@query(
    "i7_item_vectors_from_histories",
    f"""WITH {CLICKS} SELECT item_id, 32 AS size FROM clicks GROUP BY 1 HAVING count(*) >= 5""",
)
def i7(spark, d):
    lists = sequences.user_items(clicks(spark, d), "uid", "item_id", ["us", "event_id"])
    sentences = lists.select(F.col("items").cast("array<string>").alias("items"))
    vectors = embeddings.train_vectors(sentences, "items", size=32, window=5, min_count=5)
    return vectors.select(F.col("token").cast("long").alias("item_id"), F.size("vector").alias("size"))


WINDOW = 3


@query(
    "i7_item_information",
    f"""WITH {CLICKS}, placed AS (SELECT uid, item_id, row_number() OVER (PARTITION BY uid ORDER BY us, event_id) AS pos
      FROM clicks WHERE item_id IS NOT NULL),
    near AS (SELECT x.item_id AS a, y.item_id AS b FROM placed x JOIN placed y
      ON x.uid = y.uid AND y.pos - x.pos BETWEEN 1 AND {WINDOW}),
    counted AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM near UNION ALL SELECT b, a FROM near) GROUP BY 1, 2),
    margin AS (SELECT a, sum(n) AS m FROM counted GROUP BY 1), t AS (SELECT sum(n) AS total FROM counted)
    SELECT c.a, c.b, CAST(n AS BIGINT) AS n, round(ln(n * CAST(total AS DOUBLE) / (CAST(x.m AS DOUBLE) * y.m)), 6) AS weight
    FROM counted c JOIN margin x ON x.a = c.a JOIN margin y ON y.a = c.b CROSS JOIN t
    WHERE ln(n * CAST(total AS DOUBLE) / (CAST(x.m AS DOUBLE) * y.m)) > 0""",
)
def i7_information(spark, d):
    """Items that meet within three places of a user's history, and how much more than by chance."""
    return _item_information(spark, d).select("a", "b", "n", r6("weight").alias("weight"))


def _item_information(spark, d):
    log = clicks(spark, d).where("item_id IS NOT NULL")
    profile = materialize(skew.key_profile(log, ["uid"]), "profile")
    placed = skew.running_sums(log, profile, ["uid"], ["us", "event_id"], {"pos": F.lit(1)})
    counts = cooccurrence.position_pairs(placed.where("uid IS NOT NULL"), ["uid"], "pos", "item_id", WINDOW)
    return cooccurrence.positive_information(materialize(counts, "pairs"))


# with 32 numbers a vector; what SQL can say is which items have one
@query("i7_information_vectors", f"""WITH {CLICKS} SELECT item_id, 32 AS size FROM clicks WHERE item_id IS NOT NULL GROUP BY 1""")
def i7_vectors(spark, d):
    vectors = cooccurrence.train_vectors(materialize(_item_information(spark, d), "weights"), 32, 4)
    return vectors.select(F.col("token").alias("item_id"), F.size("vector").alias("size"))


@query(
    "i1_word_information",
    f"""WITH words AS (SELECT string_split(text, ' ') AS w FROM conversations),
    near AS (SELECT w[i] AS a, w[i + d] AS b FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM words)
      CROSS JOIN (SELECT unnest(range(1, {WINDOW + 1})) AS d) WHERE i + d <= len(w)),
    counted AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM near UNION ALL SELECT b, a FROM near) GROUP BY 1, 2),
    margin AS (SELECT a, sum(n) AS m FROM counted GROUP BY 1), t AS (SELECT sum(n) AS total FROM counted)
    SELECT c.a, c.b, CAST(n AS BIGINT) AS n, round(ln(n * CAST(total AS DOUBLE) / (CAST(x.m AS DOUBLE) * y.m)), 6) AS weight
    FROM counted c JOIN margin x ON x.a = c.a JOIN margin y ON y.a = c.b CROSS JOIN t
    WHERE ln(n * CAST(total AS DOUBLE) / (CAST(x.m AS DOUBLE) * y.m)) > 0""",
)
def i1_information(spark, d):
    talks = table(spark, d, "conversations").select(F.split("text", " ").alias("words"))
    counts = materialize(cooccurrence.list_pairs(talks, "words", WINDOW), "pairs")
    found = cooccurrence.positive_information(counts)
    return found.select("a", "b", "n", r6("weight").alias("weight"))

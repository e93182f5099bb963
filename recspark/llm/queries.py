"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import conversation_repair, decontamination, html_text, jaccard, line_runs, packing, period_runs, permutation_index, quality, repeats, resharding, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.with_score(docs, model).select(
        "doc_id",
        F.coalesce(quality.held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op8_benchmark_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.with_matches(docs, table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_packing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_line_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_runs.without_repeats(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_LINE_WINDOWS = """split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {documents} WHERE length(text) > 0),
  counted AS (SELECT *, len(regexp_extract_all(line, '\\S+')) AS words FROM split),
  placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM counted WHERE words > 0),
  ahead AS (SELECT *, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3, lead(words, 1) OVER d AS w2
    FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY n)),
  copies AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, n) AS c1,
    row_number() OVER (PARTITION BY line, l2 ORDER BY doc_id, n) AS c2,
    row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, n) AS c3 FROM ahead),
  deep AS (SELECT *, CASE WHEN l3 IS NOT NULL AND c3 > 1 THEN 3
    WHEN l2 IS NOT NULL AND c2 > 1 AND words + w2 >= 8 THEN 2
    WHEN c1 > 1 AND words >= 8 THEN 1 ELSE 0 END AS depth FROM copies),
  judged AS (SELECT *, depth > 0 OR coalesce(lag(depth, 1) OVER e, 0) > 1
    OR coalesce(lag(depth, 2) OVER e, 0) > 2 AS gone
    FROM deep WINDOW e AS (PARTITION BY doc_id ORDER BY n)),
  lines AS (SELECT s.doc_id, s.n, s.line, coalesce(j.gone, false) AS gone
    FROM split s LEFT JOIN judged j ON s.doc_id = j.doc_id AND s.n = j.n),
  cleaned AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept FROM lines GROUP BY doc_id)"""

ORACLES["op5_line_runs"] = (
    "WITH " + _LINE_WINDOWS.format(documents="documents")
    + """ SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed,
  sha256(coalesce(c.kept, d.text)) AS kept_sha256 FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id"""
)


@query
def op10_jaccard_join(spark, folder):
    return jaccard.link_components(table(spark, folder, "documents"))


@query
def op4_token_files(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files = token_files.write(docs, public_tokenizers.path("word_bpe_49k.json"), vocabulary=49_408)
    read = files.checksums(files.lookup(files.keys))
    return read.select("doc_id", "start", F.col("length").alias("n_tokens"), "ids_crc32")


@query
def op2_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages, block=["net/", "example.com/de/"], allow=["example.net/en/", "org/fr/"])


@query
def op9_flow_resharding(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # the layout to leave: 32 shards by a hash of doc_id
    placed, _ = resharding.reshard(docs, F.pmod(F.xxhash64("doc_id"), F.lit(32)), 32, 40)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "moved",
    )


@query
def op1_permutation_index(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return permutation_index.search(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op7_suffix_repeats(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = repeats.without_repeats(docs)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _words(table_name: str, key: str, pattern: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, regexp_extract_all({lowered}, '{pattern}') AS w FROM {table_name}"


_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op8_benchmark_decontamination"] = f"""WITH d AS ({_words("documents", "doc_id", _LETTERS)}),
  i AS ({_words("benchmark", "item_id", _LETTERS)}),
  windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS size, unnest(list_transform(
    range(1, greatest(len(w) - 9, least(len(w), 1)) + 1), lambda p: array_to_string(w[p:p + 9], ' '))) AS g FROM i),
  sizes AS (SELECT DISTINCT size FROM windows),
  places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d CROSS JOIN sizes),
  hits AS (SELECT doc_id, p, windows.size, item FROM places JOIN windows
    ON windows.size = places.size AND windows.g = array_to_string(w[p:p + places.size - 1], ' ')),
  covered AS (SELECT doc_id, count(DISTINCT x) AS n FROM
    (SELECT doc_id, unnest(range(p, p + size)) AS x FROM hits) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
  SELECT d.doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
    sha256(coalesce(t.names, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id"""

_JACCARD_WORDS = _words("documents", "doc_id", r"[^\x20\x09-\x0D]+")
ORACLES["op10_jaccard_join"] = f"""WITH RECURSIVE words AS ({_JACCARD_WORDS}),
  shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingles x JOIN shingles y
    ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * i >= 75 * (x.n + y.n - i)),
  edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reached(doc_id, other) AS (SELECT doc_id, doc_id FROM words
    UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other),
  smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
  SELECT s.doc_id, coalesce(n, 0) AS n_shingles, component_id
  FROM smallest s LEFT JOIN sizes z ON z.doc_id = s.doc_id"""


@query
def op13_period_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # one document in ten: from word a on, its words repeat with period p
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    parts = parts.select("*", F.nullif(F.size("w"), F.lit(0)).cast("long").alias("n"))
    parts = parts.withColumn("a", F.pmod("g", "n").cast("int"))
    parts = parts.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    copies = F.flatten(F.array_repeat(period, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    repeated = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(copies, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    parts = parts.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
    found = period_runs.with_runs(parts)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = period_runs.strongest("runs")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_conversation_repair(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    ids = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("*", (F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20).alias("c"))
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("c") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("c") != 0).alias("present"),
        F.explode(F.array_repeat("c", F.when(F.col("c") == 3, 2).otherwise(1))),
    )
    return conversation_repair.conversations(conversation_repair.repair(damaged, F.col("present")))


def _repair_sql() -> str:
    """The program row by row: per state the least {cost, audit, repaired rows}."""
    kind = "STRUCT(c BIGINT, w VARCHAR, o VARCHAR[])"
    one = lambda x, cost, edit, row="NULL": (
        f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'w': {x}.w || '{edit}', "
        f"'o': CASE WHEN {row} IS NULL THEN {x}.o ELSE list_append({x}.o, {row}) END}} END"
    )
    least = lambda *ways: f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]::{kind}"
    pen = "CASE fault WHEN 3 THEN 5 ELSE 0 END"
    only = lambda test, way: f"CASE WHEN {test} THEN {way} END"
    stays = "fault NOT IN (1, 2)"
    to_user = [only(stays, one(x, f"1 + {pen}", "R", "'user:' || text")) for x in ("e", "s", "a")]
    to_user += [only(f"{stays} AND initial = 'u'", one(x, pen, "K", "role || ':' || text")) for x in ("e", "s", "a")]
    to_assistant = [only(stays, one("u", f"1 + {pen}", "R", "'assistant:' || text"))]
    to_assistant += [only(f"{stays} AND initial = 'a'", one("u", pen, "K", "role || ':' || text"))]
    to_system = only(f"{stays} AND initial = 's'", one("e", pen, "K", "role || ':' || text"))
    user = lambda x: one(x, 5, "I", "'user:'")
    crc = "xor(list_reduce(flatten([[4294967295], flatten(list_transform(range(1, length(k) + 1), lambda i: "
    crc += "[CAST(ascii(k[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))]), lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) "
    crc += "WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END), 4294967295) % 20"
    return f"""WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
  coded AS (SELECT *, {crc} AS c FROM keyed),
  damaged AS (SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
    CASE c WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE c WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded WHERE c <> 0),
  placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
  judged AS (SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
  facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
  dp AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'w': '', 'o': []}}::{kind} AS e,
      NULL::{kind} AS s, NULL::{kind} AS u, NULL::{kind} AS a FROM conversations
    UNION ALL SELECT conv_id, i, {least(one("e", 2, "D"))}, {least(one("s", 2, "D"), to_system)},
      {least(one("u", 2, "D"), *to_user)}, {least(one("a", 2, "D"), *to_assistant)}
    FROM (SELECT * REPLACE ({least("a", one("u", 5, "I", "'assistant:'"))} AS a) FROM
      (SELECT dp.conv_id, j.i, role, text, initial, fault, e, s, {least("u", user("e"), user("s"), user("a"))} AS u, a
       FROM dp JOIN judged j ON dp.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = dp.i + 1))),
  ended AS (SELECT conv_id, {least("e", "a", one("u", 5, "I", "'assistant:'"),
    "CASE WHEN s IS NOT NULL THEN {'c': s.c + 10, 'w': s.w || 'II', 'o': list_concat(s.o, ['user:', 'assistant:'])} END")} AS best
    FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
  SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.w AS audit,
    sha256(array_to_string(best.o, chr(10))) AS repaired_sha256
  FROM ended d LEFT JOIN facts f ON d.conv_id IS NOT DISTINCT FROM f.conv_id"""


ORACLES["op12_conversation_repair"] = _repair_sql()


@query
def op11_html_text(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select("page_id", "url", "text", "n_chars")


# holds for pages whose text is one article without boilerplate inside, as in the given tables
ORACLES["op11_html_text"] = r"""WITH found AS (SELECT page_id, url,
    regexp_extract(coalesce(html, ''), '<article[^>]*>(.*?)</article>', 1, 's') AS part FROM pages),
  spaced AS (SELECT page_id, url, regexp_replace(regexp_replace(part, '</?(h1|h2|h3|p|br|div|ul|ol|li|section)[^>]*>', ' ', 'g'),
    '<[^>]*>', '', 'g') AS t FROM found),
  decoded AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&#39;', ''''),
    '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM spaced)
  SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text,
    length(trim(regexp_replace(t, '\s+', ' ', 'g'))) AS n_chars FROM decoded"""

"""Scans and sinks, by writing a given table and reading it back whole."""

from pyspark.sql import functions as F

from ..functions.arrays import map_keys_or_empty, map_sum
from ..functions.text import words
from ..operators.encoding import encode, fit_dictionary
from ..operators.scaling import fit_standard, standard_scale
from ..operators.sequences import fit_first_seen_vocabulary
from ..operators.embeddings import index_rows
from ..operators.splits import draw
from ..sources import scans, schemas, sinks
from ..session import table
from ..storage import new_path
from .base import WIDE, joined, query, r6, wide


@query("a1_headerless_scan", f"""WITH {WIDE} SELECT * FROM wide""")
def a1(spark, d):
    path = new_path(spark, "clicks-tsv")
    sinks.write_delimited(wide(spark, d), path, sep="\t", header=False)
    return scans.delimited(spark, path, schemas.CLICKS).withColumnRenamed("like", "liked")


@query("a2_headered_scan", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def a2(spark, d):
    path = new_path(spark, "customers-csv")
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    sinks.write_delimited(customers, path)
    return scans.delimited(spark, path, customers.schema, sep=",", header=True)


@query(
    "a3_json_lines_scan",
    """SELECT p_partkey AS item_id,
    CAST(len(split_part(p_name, ' ', 1)) + len(split_part(p_name, ' ', 2)) AS BIGINT) AS title_len,
    replace(p_name, ' ', ',') AS title_words FROM part""",
)
def a3(spark, d):
    path = new_path(spark, "titles-json")
    name = F.split("p_name", " ")
    counts = F.map_from_arrays(name, F.transform(name, lambda w: F.length(w)))
    table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"), counts.alias("title_features")
    ).write.json(path)
    titles = scans.json_lines(spark, path, schemas.TITLE)
    return titles.select(
        "item_id",
        map_sum(F.col("title_features")).alias("title_len"),
        joined(map_keys_or_empty(F.col("title_features"))).alias("title_words"),
    )


@query(
    "a4_keyed_json_scan",
    """SELECT CAST(s_suppkey AS VARCHAR) AS item_id, CAST(s_nationkey AS DOUBLE) AS nation,
    s_acctbal AS balance FROM supplier""",
)
def a4(spark, d):
    path = new_path(spark, "keyed-json")
    entry = F.struct(
        F.col("s_suppkey").cast("string").alias("key"),
        F.array(F.col("s_nationkey").cast("double"), F.col("s_acctbal")).alias("value"),
    )
    objects = table(spark, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 50)).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    )
    objects.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return scans.keyed_json(spark, path, "item_id", ["nation", "balance"])


LINES = "SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents"


def _document_files(spark, d):
    path = new_path(spark, "text-files")
    table(spark, d, "documents").select("lang", F.col("text").alias("value")).write.partitionBy(
        "lang"
    ).text(path)
    return path


@query("a5_recursive_text_scan", f"SELECT line AS value, count(*) AS n FROM ({LINES}) GROUP BY 1")
def a5(spark, d):
    lines = scans.text_files(spark, _document_files(spark, d), "*.txt")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a6_folder_label",
    f"SELECT concat('lang=', lang) AS label, count(*) AS lines FROM ({LINES}) GROUP BY 1",
)
def a6(spark, d):
    lines = scans.text_files(spark, _document_files(spark, d))
    labelled = lines.select(scans.folder_label(F.col("path")).alias("label"))
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "a7_positive_negative_files",
    """SELECT array_to_string(string_split(replace(text, chr(10), ' '), ' '), '|') AS tokens,
    CASE WHEN role = 'user' THEN '0,1' ELSE '1,0' END AS label, count(*) AS n
    FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1, 2""",
)
def a7(spark, d):
    paths = {}
    for role in ("user", "assistant"):
        paths[role] = new_path(spark, role)
        talks = table(spark, d, "conversations").where(F.col("role") == role)
        talks.select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")).write.text(paths[role])
    rows = scans.positive_negative(spark, paths["user"], paths["assistant"])
    shown = rows.select(F.array_join("tokens", "|").alias("tokens"), joined("label").alias("label"))
    return shown.groupBy("tokens", "label").agg(F.count(F.lit(1)).alias("n"))


@query("a8_word_list_scan", "SELECT DISTINCT p_name AS word FROM part")
def a8(spark, d):
    path = new_path(spark, "words")
    names = table(spark, d, "part").select("p_name").distinct()
    names.select(F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("value")).write.text(path)
    return scans.word_list(spark, path)


@query(
    "a9_delimited_sink",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, printf('%.4f', o_totalprice / 7) AS price,
    o_orderstatus AS status FROM orders""",
)
def a9(spark, d):
    path = new_path(spark, "prices-csv")
    prices = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_totalprice") / 7).alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    sinks.write_delimited(prices, path)
    return spark.read.csv(path, schema="id string, price string, status string", header=True)


@query(
    "a10_dictionary_sink",
    """SELECT p_brand AS brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types
    FROM part GROUP BY 1""",
)
def a10(spark, d):
    path = new_path(spark, "dictionary-json")
    types = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(
        F.array_sort(F.collect_set("p_type")).alias("types")
    )
    sinks.write_dictionary(types, path, "brand", "types")
    back = scans.json_lines(spark, path, types.schema)
    return back.select("brand", joined("types").alias("types"))


@query(
    "a11_reload_fitted",
    """SELECT l_orderkey, dense_rank() OVER (ORDER BY l_suppkey) - 1 AS supplier,
    round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS quantity
    FROM lineitem""",
)
def a11(spark, d):
    path = new_path(spark, "fitted")
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("quantity")
    )
    fitted = {"scaler": fit_standard(lines, ["quantity"]), "codes": fit_dictionary(lines, ["supplier"])}
    sinks.write_fitted(fitted, path)
    loaded = sinks.read_fitted(spark, path, ["scaler", "codes"])
    scaled = standard_scale(encode(lines, loaded["codes"], ["supplier"]), loaded["scaler"])
    return scaled.select("l_orderkey", "supplier", r6("quantity").alias("quantity"))


@query(
    "a12_labelled_id_files",
    """WITH tokens AS (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS token,
      generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part),
    vocabulary AS (SELECT token, row_number() OVER (ORDER BY min(p_partkey * 1000 + pos)) AS id
      FROM tokens GROUP BY token),
    rows AS (SELECT p_partkey, any_value(p_size) AS label, list(id ORDER BY pos) AS ids
      FROM tokens JOIN vocabulary USING (token) GROUP BY p_partkey)
    SELECT label, array_to_string(list_resize(ids, 4, 0), ',') AS tokens, count(*) AS n
    FROM rows GROUP BY 1, 2""",
)
def a12(spark, d):
    path = new_path(spark, "labelled-ids")
    parts = table(spark, d, "part").select("p_partkey", "p_size", "p_name")
    tokens = words(F.col("p_name"))
    vocabulary = fit_first_seen_vocabulary(parts, tokens, ["p_partkey"])
    rows = index_rows(parts, ["p_partkey", "p_size"], tokens, vocabulary, 4)
    sinks.write_labelled_ids(rows, path, "p_size", "ids", 500, draw(["p_partkey"], 100))
    back = spark.read.schema("label int, tokens array<bigint>").parquet(path)
    shown = back.select("label", joined("tokens").alias("tokens"))
    return shown.groupBy("label", "tokens").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a13_combine_files",
    """SELECT trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS value, count(*) AS n
    FROM benchmark GROUP BY 1""",
)
def a13(spark, d):
    small, large = new_path(spark, "one-text-per-file"), new_path(spark, "combined")
    texts = table(spark, d, "benchmark").select(F.col("text").alias("value"))
    texts.write.option("maxRecordsPerFile", 1).text(small)
    files = scans.text_files(spark, small, "txt", whole=True)
    sinks.write_documents(files, large, documents_per_file=1000)
    return spark.read.text(large).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a14_rows_per_file",
    "SELECT count(*) AS in_files, count(*) AS total, TRUE AS many FROM events",
)
def a14(spark, d):
    path = new_path(spark, "events")
    table(spark, d, "events").write.option("maxRecordsPerFile", 300).parquet(path)
    counts = scans.rows_per_file(spark.read.parquet(path))
    named = F.col("file").isNotNull()
    return counts.agg(
        F.sum(F.when(named, F.col("rows"))).alias("in_files"),
        F.sum(F.when(~named, F.col("rows"))).alias("total"),
        (F.count_if(named) > 1).alias("many"),
    )

"""Registry of the named queries, and the given tables seen as a click log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import micros
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its SQL."""

    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def joined(items: Column | str) -> Column:
    column = F.col(items) if isinstance(items, str) else items
    return F.array_join(column.cast("array<string>"), ",")


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as a click log: one row per event, ordered by (us, event_id)."""
    kind = F.col("event_type")
    events = table(spark, folder, "events")
    return events.select(
        "event_id",
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        kind.alias("channel"),
        kind.isin("click", "purchase").cast("int").alias("finish"),
        (kind == "purchase").cast("int").alias("liked"),
        micros(events, "ts").alias("us"),
        F.col("value").alias("duration"),
    )


CLICKS = """clicks AS (
  SELECT event_id, user_id AS uid,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id, event_type AS channel,
    CAST(event_type IN ('click', 'purchase') AS INTEGER) AS finish,
    CAST(event_type = 'purchase' AS INTEGER) AS liked,
    epoch_us(ts) AS us, value AS duration
  FROM events)"""

# the first 80 % of the clicks in order, and the others
PARTS = (
    CLICKS
    + """, numbered AS (
  SELECT *, row_number() OVER (ORDER BY us, event_id) AS rn, count(*) OVER () AS n FROM clicks),
train AS (SELECT * FROM numbered WHERE rn <= CAST(floor(n * 0.8) AS BIGINT)),
test AS (SELECT * FROM numbered WHERE rn > CAST(floor(n * 0.8) AS BIGINT))"""
)


def wide(spark: SparkSession, folder: str) -> DataFrame:
    """`lineitem` with its order, customer and supplier as the 12-column click log."""
    lines = table(spark, folder, "lineitem")
    day = micros(lines, "l_shipdate") / 1_000_000
    return (
        lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_custkey").alias("uid"),
            F.col("c_nationkey").cast("long").alias("user_city"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("author_id"),
            F.col("s_nationkey").cast("long").alias("item_city"),
            F.col("l_linenumber").alias("channel"),
            (F.col("l_returnflag") == "R").cast("int").alias("finish"),
            (F.col("l_linestatus") == "F").cast("int").alias("liked"),
            F.when(F.col("l_discount") == 0, -1).otherwise(F.col("l_suppkey")).alias("music_id"),
            F.col("l_orderkey").alias("device"),
            (day.cast("long") + F.floor("l_extendedprice") % 86400).alias("time"),
            F.col("l_quantity").cast("int").alias("duration_time"),
        )
    )


WIDE = """wide AS (
  SELECT o_custkey AS uid, CAST(c_nationkey AS BIGINT) AS user_city, l_partkey AS item_id,
    l_suppkey AS author_id, CAST(s_nationkey AS BIGINT) AS item_city, l_linenumber AS channel,
    CAST(l_returnflag = 'R' AS INTEGER) AS finish, CAST(l_linestatus = 'F' AS INTEGER) AS liked,
    CASE WHEN l_discount = 0 THEN -1 ELSE l_suppkey END AS music_id, l_orderkey AS device,
    CAST(epoch(l_shipdate) AS BIGINT) + CAST(floor(l_extendedprice) AS BIGINT) % 86400 AS time,
    CAST(l_quantity AS INTEGER) AS duration_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def qcut_sql(source: str, column: str, bins: int, name: str) -> str:
    """A CTE `name` with the merged quantile edges of a column, as one list."""
    shares = [1.0 if j == bins else j * (1.0 / bins) for j in range(bins + 1)]
    points = ", ".join(f"'{s!r}'::DOUBLE" for s in shares)
    return (
        f"{name} AS (SELECT list_sort(list_distinct(quantile_cont(CAST({column} AS DOUBLE), "
        f"[{points}]))) AS edges FROM {source})"
    )


def bin_sql(column: str, edges: str) -> str:
    below = f"len(list_filter({edges}, lambda e: e < CAST({column} AS DOUBLE)))"
    return f"CAST(greatest({below} - 1, 0) AS INTEGER)"

"""Distinct counts of columns that count each other, against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recspark.operators import counting
from recspark.queries import encoding

PAIRS = {"u": ["c", "i", "m"], "i": ["u", "c"], "c": ["u", "c"]}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_distinct_counts_of_mutual_pairs(spark, kind):
    rng = random.Random(9)
    rows = [tuple(None if rng.random() < 0.1 else rng.randrange(n) for n in (9, 12, 4, 3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "u long, i long, c long, m long").select(*[F.col(x).cast(kind) for x in "uicm"])
    found = {(r["feature"], int(r["key"])): r for r in counting.fit_distinct_counts(df, PAIRS).collect()}
    counts, values = defaultdict(int), defaultdict(set)
    for row in rows:
        of = dict(zip("uicm", row))
        for key, own in PAIRS.items():
            if of[key] is not None:
                counts[key, of[key]] += 1
                for value in own:
                    values[key, of[key], value].update({of[value]} - {None})
    assert set(found) == set(counts)
    for (key, k), r in found.items():
        assert r["n"] == counts[key, k] and r["number"] == k
        for other, own in PAIRS.items():
            for value in own:
                assert r[f"{other}_{value}_nunique"] == (len(values[key, k, value]) if other == key else 0)


def test_mutual_pairs_are_shuffled_once(spark, monkeypatch):
    plans = []
    plain = counting.materialize
    monkeypatch.setattr(counting, "materialize", lambda df, *a, **k: plans.append(df) or plain(df, *a, **k))
    df = spark.range(40).selectExpr("id % 7 AS u", "id % 5 AS i")
    counting.fit_distinct_counts(df, {"u": ["i"], "i": ["u"]})
    plan = plans[0]._jdf.queryExecution().analyzed().toString()
    assert plan.count("struct(group") == 1


def test_the_log_of_distinct_counts_is_joined_once(spark, tmp_path):
    cells = {
        "lineitem": "id AS l_orderkey, id % 5 AS l_partkey, id % 3 AS l_suppkey, 1 AS l_linenumber, 'R' AS l_returnflag, 'F' AS l_linestatus, id % 2 / 10.0D AS l_discount, timestamp'2024-01-01' AS l_shipdate, 9.0D AS l_extendedprice, 2.0D AS l_quantity",
        "orders": "id AS o_orderkey, id % 4 AS o_custkey",
        "customer": "id AS c_custkey, 1 AS c_nationkey",
        "supplier": "id AS s_suppkey, CAST(id AS INT) AS s_nationkey",
    }
    for name, columns in cells.items():
        spark.range(30).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    found = encoding.d3(spark, str(tmp_path))
    assert "lineitem.parquet" not in found._jdf.queryExecution().toString()
    assert found.count() == 30

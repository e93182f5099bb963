"""Fits of two days, merged, are the fit of both; old codes stay."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.functions.text import words
from recspark.operators import counting, encoding, merging, scaling, sequences, target


@pytest.fixture(scope="module")
def days(spark):
    draw = random.Random(6)
    rows = [
        (i, draw.choice([None, *range(12)]) if i % 2 else draw.randrange(30), draw.choice(["a", "b", None, "Z", f"t{draw.randrange(9)}"]), draw.randrange(2), draw.choice([None, 0.5, 2.5, i / 7]), i // 250)
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "id long, k long, t string, y int, x double, day int").repartition(3)
    return df, df.where("day = 0"), df.where("day = 1")


def rows_of(df, digits=None):
    value = lambda v: round(v, digits) if digits is not None and isinstance(v, float) else v
    return sorted((tuple(value(v) for v in r) for r in df.collect()), key=repr)


KEYS = ["k", "t"]


@pytest.mark.parametrize(
    "fit, merge",
    [
        (lambda d: counting.fit_counts(d, KEYS), merging.merge_counts),
        (lambda d: target.fit_target(d, KEYS, "y"), merging.merge_target),
        (lambda d: scaling.fit_minmax(d, ["x", "k"]), merging.merge_minmax),
        (lambda d: merging.fit_moments(d, ["x", "k"]), merging.merge_moments),
    ],
)
def test_merged_fits(days, fit, merge):
    whole, a, b = days
    assert rows_of(merge(fit(a), fit(b)), 8) == rows_of(fit(whole), 8)
    nothing = whole.limit(0)
    if merge is not merging.merge_target:  # a table without rows has no row of all rows
        assert rows_of(merge(fit(whole), fit(nothing)), 8) == rows_of(fit(whole), 8)


def test_moments_give_the_standard_fit(days):
    whole, a, b = days
    merged = merging.standard_of(merging.merge_moments(merging.fit_moments(a, ["x", "k"]), merging.fit_moments(b, ["x", "k"])))
    assert rows_of(merged, 8) == rows_of(scaling.fit_standard(whole, ["x", "k"]), 8)


def test_dictionaries_grow_at_the_end(days):
    whole, a, b = days
    old, new = encoding.fit_dictionary(b, KEYS), encoding.fit_dictionary(a, KEYS)
    merged = encoding_rows(merging.merge_dictionary(old, new))
    before, after, both = encoding_rows(old), encoding_rows(new), encoding_rows(encoding.fit_dictionary(whole, KEYS))
    assert merged.keys() == both.keys()
    assert all(merged[v][0] == before[v][0] for v in before)
    assert all(merged[v][1:] == both[v][1:] for v in both)
    for feature in KEYS:
        codes = sorted(c for (f, _), (c, *_) in merged.items() if f == feature)
        assert codes == list(range(len(codes)))
        added = [v for v in after if v[0] == feature and v not in before]
        assert sorted(added, key=lambda v: after[v][0]) == sorted(added, key=lambda v: merged[v][0])
    empty = encoding.fit_dictionary(whole.limit(0), KEYS)
    assert encoding_rows(merging.merge_dictionary(empty, old)) == before == encoding_rows(merging.merge_dictionary(old, empty))
    coded = encoding.encode(whole, merging.merge_dictionary(old, new), ["k", "t"]).where("k IS NULL AND id % 2 = 0")
    assert coded.count() == 0


def encoding_rows(dictionary):
    return {(r["feature"], r["value"]): (r["code"], r["n"], r["number"]) for r in dictionary.collect()}


def test_vocabularies_grow_at_the_end(spark):
    days = [[(1, "a b a"), (2, "c a")], [(3, "d d d d"), (4, "a e c"), (5, None)]]
    tables = [spark.createDataFrame(d, "id long, text string") for d in days]
    old, new = (sequences.fit_vocabulary(t, words(F.col("text"), " "), ["id"]) for t in tables)
    merged = {r["token"]: (r["id"], r["n"]) for r in merging.merge_vocabulary(old, new).collect()}
    before = {r["token"]: r["id"] for r in old.collect()}
    assert all(merged[t][0] == i for t, i in before.items())
    assert merged["d"] == (len(before) + 1, 4) and merged["e"] == (len(before) + 2, 1) and merged["a"][1] == 4 and merged["c"][1] == 2


def test_sketches(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 20_000).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("w"))
    pairs = {"k": ["v", "w"]}
    days = rows.where("v < 12000"), rows.where("v >= 9000")  # one overlaps the other
    merged = merging.merge_sketches(*[counting.fit_distinct_sketches(day, pairs) for day in days])
    whole = counting.sketched_counts(counting.fit_distinct_sketches(rows, pairs), pairs)
    found = counting.sketched_counts(merged, pairs)
    shape = ["feature", "number", "key", "k_v_nunique", "k_w_nunique"]
    assert rows_of(found.select(shape)) == rows_of(whole.select(shape))
    exact = {r["k"]: (r["v"], r["w"]) for r in rows.groupBy("k").agg(F.countDistinct("v").alias("v"), F.countDistinct("w").alias("w")).collect()}
    for r in found.collect():
        v, w = exact[r["number"]]
        assert abs(r["k_v_nunique"] - v) <= 0.05 * v and r["k_w_nunique"] == w
    encoded = counting.distinct_encode(rows.limit(10), found, pairs)
    assert {"k_v_nunique", "k_w_nunique"} <= set(encoded.columns)

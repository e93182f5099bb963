"""The feature table joins vectors to items, not to rows, and gives the same numbers."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.plans import competition


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        item = None if i % 11 == 0 else rng.randrange(6)
        rows.append((i, rng.randrange(5), i % 3, item, i % 4, i % 2, i % 3, rng.randrange(4), rng.randrange(7), 1000 * i, float(rng.randrange(50)), rng.randrange(2)))
    names = "row long, uid long, user_city long, item_id long, author_id long, item_city long, channel int, music_id long, did long, time long, video_duration double, finish int"
    return spark.createDataFrame(rows, names).withColumn("creat_time", F.col("time")).cache()


def test_vectors_reach_the_rows_last_and_by_item(spark, log, monkeypatch):
    video = spark.createDataFrame([(i, [i + 0.5, -1.0 * i]) for i in range(5)], "item_id long, vector array<double>")
    audio = spark.createDataFrame([(i, [10.0 * i, 1.0]) for i in (1, 3, 3)], "item_id long, vector array<double>")
    titles = spark.createDataFrame([(1, {"a": 2, "b": 3}), (2, {"c": 7})], "item_id long, title_features map<string,int>")
    encoded, joined = [], []
    plain, side = competition.encode, competition.with_vector
    monkeypatch.setattr(competition, "encode", lambda df, *a, **k: encoded.append(df.columns) or plain(df, *a, **k))
    monkeypatch.setattr(competition, "with_vector", lambda df, *a, **k: joined.append(df.count()) or side(df, *a, **k))
    found = competition.features(log.where("row < 90"), log.where("row >= 90"), "finish", ["time", "row"], titles, video, audio, 2).collect()
    assert not any({"vd0", "ad0", "title_words", "uid-author_id"} & set(c) for c in encoded)
    assert joined[0] == 7  # the items and the missing one, not the 120 rows
    by_row = {r["row"]: r["item_id"] for r in log.collect()}
    assert sorted(r["row"] for r in found) == sorted(i for i, item in by_row.items() for _ in range(2 if item == 3 else 1))
    for r in found:
        item = by_row[r["row"]]
        assert [r["vd0"], r["vd1"]] == ([item + 0.5, -1.0 * item] if item is not None and item < 5 else [0, 0])
        assert [r["ad0"], r["ad1"]] == ([10.0 * item, 1] if item in (1, 3) else [0, 0])
        assert r["title_words"] == {1: ["a", "b"], 2: ["c"]}.get(item, [])
        assert r["title_len"] == pytest.approx(({1: 5, 2: 7}.get(item, 6) - 5) / 2)
        assert r["item_id"] == (0 if item is None else item + 1)
        assert r["is_test"] == (r["row"] >= 90)
    assert not {"_item", "_none", "n"} & set(found[0].asDict())


def test_means_are_the_same_with_and_without_the_composite_columns(log):
    def means(df):
        known, new = competition.mean_features(df.where("row < 90"), df.where("row >= 90"), "finish", ["time", "row"])
        names = ["row", *[f"`{k}_finish_mean`" for k in competition.MEAN_KEYS]]
        return sorted(tuple(r) for r in known.select(names).unionAll(new.select(names)).collect())

    assert means(log) == means(competition.with_composites(log))
    known, _ = competition.mean_features(log, log, "finish", ["time", "row"])
    assert not set(competition.COMPOSITES) & set(known.columns)

"""The split paths for hot keys give what the plain plans and brute force give."""

import random

import pytest
from pyspark.sql import functions as F

from recspark.operators import counting, encoding, ranking, samples, sequences, skew, splits, target
from recspark.operators.ordering import cumulative, global_rank, row_at
from recspark.operators.skew import attach, attach_side, key_profile, running_sums

HOT = 20  # rows per task: with 300 rows of one key, 15 splits


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        key = None if i % 50 == 1 else key
        rows.append((i, key, rng.randrange(1000) if key != "hot" else i * i, rng.randrange(2), rng.randrange(8)))
    return spark.createDataFrame(rows, "id long, key string, ts long, y int, item long").cache()


@pytest.fixture(autouse=True)
def nothing_is_small(monkeypatch):
    """The tables here are tiny; take the split paths all the same."""
    monkeypatch.setattr(skew, "SMALL_ROWS", -1)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_attach_splits_hot_keys_and_keeps_all_rows(log):
    table = log.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))
    split = attach(log, table, ["key"], rows_per_task=HOT)
    plain = log.join(table.drop("n"), "key", "left")
    assert rows_of(split, "id", "key", "total") == rows_of(plain, "id", "key", "total")


def test_attach_salts_are_spread(spark, log):
    table = log.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = attach(log, table.withColumn("v", F.lit(1)), ["key"], rows_per_task=HOT)
    text = plan._jdf.queryExecution().toString()
    assert "_salt" in text


def test_attach_side_finds_hot_keys_itself(log):
    side = log.where("key is not null").groupBy("key").agg(F.max("ts").alias("top"))
    split = attach_side(log, side, ["key"], rows_per_task=HOT)
    assert rows_of(split, "id", "top") == rows_of(log.join(side, "key", "left"), "id", "top")


def test_running_sums_in_blocks(log):
    present = log.where("key is not null")
    profile = key_profile(present, ["key"])
    sums = {"before": F.col("y"), "place": F.lit(1)}
    blocked = running_sums(present, profile, ["key"], ["ts", "id"], sums, HOT)
    plain = running_sums(present, profile, ["key"], ["ts", "id"], sums)
    columns = ("id", "before", "place")
    assert rows_of(blocked, *columns) == rows_of(plain, *columns)
    brute = {}
    for row in sorted(present.collect(), key=lambda r: (r.ts, r.id)):
        earlier = brute.setdefault(row.key, [])
        earlier.append((row.id, sum(y for *_, y in earlier), len(earlier), row.y))
    want = sorted((i, s, n) for seen in brute.values() for i, s, n, _ in seen)
    assert sorted(rows_of(blocked, *columns)) == want


@pytest.mark.parametrize("crowd", ["same time", "few times", "far away"])
def test_running_sums_when_rows_crowd(spark, crowd):
    times = {"same time": lambda i: 5, "few times": lambda i: i % 3, "far away": lambda i: 10**12 if i == 0 else i % 40}
    rows = [("hot" if i % 2 else f"k{i % 7}", times[crowd](i), 900 - i, i % 5) for i in range(900)]
    df = spark.createDataFrame(rows, "key string, ts long, id long, y int")
    profile = key_profile(df, ["key"])
    blocked = running_sums(df, profile, ["key"], ["ts", "id"], {"s": F.col("y")}, HOT)
    plain = running_sums(df, profile, ["key"], ["ts", "id"], {"s": F.col("y")})
    assert rows_of(blocked, "id", "s") == rows_of(plain, "id", "s")


@pytest.mark.parametrize("order_by", [["ts", "id"], ["name", "id"], ["same", "name"]])
def test_no_segment_holds_a_whole_hot_key(spark, order_by):
    rows = [("hot" if i % 4 else None, 5, i, f"n{i % 200:03d}{i}", "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, ts long, id long, name string, same string")
    cold, laid = skew.segments(df, key_profile(df, ["key"]), ["key"], order_by, 100)
    assert cold.isEmpty()
    sizes = {(r.key, r["_segment"]): r["count"] for r in laid.groupBy("key", "_segment").count().collect()}
    assert sum(sizes.values()) == 1000 and max(sizes.values()) <= 100
    # all rows of a segment stand before those of the next one
    ends = {}
    for r in laid.collect():
        ends.setdefault((r.key or "", r["_segment"]), []).append(tuple(r[c] for c in order_by))
    last = sorted(ends)
    for a, b in zip(last, last[1:]):
        assert a[0] != b[0] or max(ends[a]) < min(ends[b])


def test_the_log_is_shuffled_once_for_cold_and_twice_for_hot_keys(log):
    profile = key_profile(log, ["key"])
    plain = running_sums(log, profile, ["key"], ["ts", "id"], {"s": F.col("y")})
    text = plain._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Window" in text
    assert "_segment" not in text


def test_target_encodings_split_equals_plain(log):
    fitted = target.fit_target(log, ["key", "item"], "y")
    folded = log.withColumn("fold", (F.col("id") % 5).cast("int"))
    by_fold = target.fit_fold_target(folded, ["key"], "y", "fold")
    for rows in (HOT, 10**9):
        cells = {
            "expanding": target.expanding_mean_train(log, fitted, ["key", "item"], "y", ["ts", "id"], rows),
            "loo": target.leave_one_out_train(log, fitted, ["key", "item"], "y", rows),
            "smooth": target.smooth_mean(log, fitted, ["key", "item"], "y", 300, rows),
            "test": target.mean_test(log, fitted, ["key", "item"], "y", rows),
            "fold": target.fold_mean_train(folded, fitted, by_fold, ["key"], "y", "fold", rows),
        }
        got = {k: rows_of(v.withColumn("m", F.round("key_y_mean", 9)), "id", "m") for k, v in cells.items()}
        if rows == HOT:
            split = got
    assert split == got


def test_rows_without_key_get_the_prior(log):
    fitted = target.fit_target(log, ["key"], "y")
    prior = target.prior(fitted)
    means = target.expanding_mean_train(log, fitted, ["key"], "y", ["ts", "id"], HOT)
    missing = {r.key_y_mean for r in means.where("key is null").collect()}
    assert missing == {prior}
    assert means.count() == 900


def test_expanding_mean_ignores_own_and_later_rows(spark):
    rows = [(1, "a", 1), (2, "a", 0), (3, "a", 1), (4, "b", 1)]
    df = spark.createDataFrame(rows, "ts long, key string, y int")
    fitted = target.fit_target(df, ["key"], "y")
    means = target.expanding_mean_train(df, fitted, ["key"], "y", ["ts"])
    assert {r.ts: r.key_y_mean for r in means.collect()} == {1: 0.75, 2: 1.0, 3: 0.5, 4: 0.75}


def test_fold_mean_ignores_own_fold(spark):
    rows = [(0, "a", 1, 0), (1, "a", 0, 1), (2, "a", 0, 1), (3, "b", 1, 0)]
    df = spark.createDataFrame(rows, "id long, key string, y int, fold int")
    fitted = target.fit_target(df, ["key"], "y")
    by_fold = target.fit_fold_target(df, ["key"], "y", "fold")
    means = target.fold_mean_train(df, fitted, by_fold, ["key"], "y", "fold")
    assert {r.id: r.key_y_mean for r in means.collect()} == {0: 0.0, 1: 1.0, 2: 1.0, 3: 0.5}


def test_positive_counts(spark):
    train = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0)], "key string, y int")
    test = spark.createDataFrame([("a", 0), ("c", 0)], "key string, y int")
    fitted = target.fit_target(train, ["key"], "y")
    got = target.positive_count_train(train, fitted, ["key"], "y")
    assert rows_of(got, "key", "key_y_cnt") == [("a", 1), ("a", 1), ("b", 0)]
    got = target.positive_count_test(test, fitted, ["key"], "y")
    assert rows_of(got, "key", "key_y_cnt") == [("a", 2.0), ("c", 1.0)]


def test_count_and_distinct_encodings_split(log):
    fitted = counting.fit_counts(log, ["key"])
    split = counting.count_encode(log, fitted, ["key"], 4, HOT)
    plain = counting.count_encode(log, fitted, ["key"], 4)
    assert rows_of(split, "id", "key_cnt") == rows_of(plain, "id", "key_cnt")
    pairs = {"key": ["item", "y"], "item": ["key"]}
    table = counting.fit_distinct_counts(log, pairs)
    split = counting.distinct_encode(log, table, pairs, None, HOT)
    plain = counting.distinct_encode(log, table, pairs)
    sizes = {r.key: r.n for r in table.where("feature = 'key'").collect()}
    assert sizes["hot"] == log.where("key = 'hot'").count()
    assert rows_of(split, "id", "key_item_nunique") == rows_of(plain, "id", "key_item_nunique")


def test_dictionary_split_and_round_trip(log):
    fitted = encoding.fit_dictionary(log, ["key"])
    coded = encoding.encode(log, fitted, ["key"], unknown=-1, rows_per_task=HOT)
    assert rows_of(coded, "id", "key") == rows_of(encoding.encode(log, fitted, ["key"], unknown=-1), "id", "key")
    back = encoding.decode(coded, fitted, ["key"], rows_per_task=HOT)
    want = log.withColumn("key", F.coalesce("key", F.lit("unknow")))
    assert rows_of(back, "id", "key") == rows_of(want, "id", "key")


def test_user_items_are_whole_and_chunked(log):
    lists = sequences.user_items(log.where("key is not null"), "key", "id", ["ts", "id"], 50, HOT)
    got = lists.collect()
    assert max(len(r["items"]) for r in got) == 50
    hot = [i for r in sorted((r for r in got if r.key == "hot"), key=lambda r: r.chunk) for i in r["items"]]
    want = [r.id for r in sorted(log.where("key = 'hot'").collect(), key=lambda r: (r.ts, r.id))]
    assert hot == want


def test_sequence_ids_split(log, spark):
    texts = spark.createDataFrame([(i, "a a b c a") for i in range(30)] + [(99, "")], "id long, t string")
    tokens = F.filter(F.split("t", " "), lambda w: w != "")
    vocabulary = sequences.fit_vocabulary(texts, tokens, ["id"])
    ids = sequences.sequence_ids(texts, ["id"], tokens, vocabulary, 1, rows_per_task=10)
    got = {r.id: r.ids for r in ids.collect()}
    assert got[0] == [2, 2, 3, 4, 2] and got[99] == [] and len(got) == 31


def test_samples_split_equals_plain(log):
    users = log.where("key is not null")
    args = (users, "key", "item", ["ts", "id"], 5, 2)
    shape = ("key", "history", "item", "label", "hist_len", "split")
    split = samples.training_samples(*args, limit=30, rows_per_task=HOT)
    plain = samples.training_samples(*args, limit=30)
    assert rows_of(split, *shape) == rows_of(plain, *shape)


def test_global_rank_and_cumulative(spark):
    rng = random.Random(1)
    values = rng.sample(range(10**6), 5000)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v long, w long").repartition(16)
    got = {r.v: r.place for r in global_rank(df, ["v"], "place").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}
    sums, total = {}, 0
    for v in sorted(values):
        sums[v] = total
        total += v % 7
    got = cumulative(df, ["v"], {"before": F.col("w")})
    assert {r.v: r.before for r in got.collect()} == sums


@pytest.mark.parametrize("small", [1, 40, 10_000])
def test_row_at(spark, small):
    rng = random.Random(3)
    rows = [(rng.choice([5, 5, 5, -40, 10**15, rng.randrange(-(10**9), 10**9)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "o long, t long").cache()
    for place in (0, 123, 250, 499):
        assert row_at(df, "o", "t", lambda *_: place, bins=8, small=small) == sorted(rows)[place]


def test_stratified_folds_in_blocks(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1000)], "id long, y int")
    number = splits.draw(["id"], 918)
    blocked = splits.stratified_folds(df, "y", "id", number, 5, rows_per_task=50)
    plain = splits.stratified_folds(df, "y", "id", number, 5)
    assert rows_of(blocked, "id", "fold") == rows_of(plain, "id", "fold")
    counts = blocked.groupBy("y", "fold").count().collect()
    assert {(r.y, r["count"]) for r in counts} == {(0, 150), (1, 50)}


def _brute_sums(rows, order):
    """Sum of y over the earlier rows of the same key, by id."""
    out = {}
    for key in {r["key"] for r in rows}:
        total = 0
        for r in sorted((r for r in rows if r["key"] == key), key=order):
            out[r["id"]] = total
            total += r["y"]
    return out


@pytest.mark.parametrize("order_by", [["ts", "name", "id"], ["name", "ts", "id"], ["ts", "big", "id"], ["half", "id"]])
def test_running_sums_with_crowded_text_and_null_order(spark, order_by):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        ts = None if i % 9 == 0 else rng.choice([5, 5, 5, i])
        rows.append((i, "hot" if i % 5 else "cold", ts, f"n{rng.randrange(60)}", 2**60 + rng.randrange(40), rng.choice([None, 0.5, 0.25]), rng.randrange(9)))
    df = spark.createDataFrame(rows, "id long, key string, ts long, name string, big long, half double, y long")
    got = running_sums(df, key_profile(df, ["key"]), ["key"], order_by, {"s": F.col("y")}, HOT)
    wanted = _brute_sums(df.collect(), lambda r: [(r[c] is not None, r[c] if r[c] is not None else 0) for c in order_by])
    assert {r["id"]: r["s"] for r in got.collect()} == wanted


def test_splits_lose_no_row_with_nulls(spark):
    rows = [(i, None if i % 10 == 0 else i % 37, None if i % 17 == 3 else i, None if i % 7 == 0 else i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, ts long, tie long, label long")
    everything = sorted(r["id"] for r in df.collect())
    unplaced = {r[0] for r in rows if r[1] is None or r[2] is None}
    for held_out in (0.2, 0.95, 1.0):
        early, late = splits.ordered_split(df, "ts", "tie", held_out)
        ids = [r["id"] for r in early.collect()]
        assert sorted(ids + [r["id"] for r in late.collect()]) == everything
        placed = sorted((r for r in rows if r[0] not in unplaced), key=lambda r: (r[1], r[2]))
        size = max(int(300 * (1 - held_out)) - len(unplaced), 0)
        assert set(ids) == unplaced | {r[0] for r in placed[:size]}
    parts = splits.fraction_split(df, [0.5, 0.3, 0.2], F.col("tie") % 100, 100)
    assert sorted(r["id"] for p in parts for r in p.collect()) == everything
    folds = splits.stratified_folds(df, "label", "id", F.col("ts"), 4, 40, rows_per_task=50).collect()
    assert sorted(r["id"] for r in folds) == everything
    for label in (None, 0, 1, 2):
        counts = [sum(r["fold"] == f and r["label"] == label for r in folds) for f in range(4)]
        assert max(counts) - min(counts) <= 1


def test_fractions_are_coded_in_number_order(spark):
    df = spark.createDataFrame([(9.5, "9.5"), (100.0, "100"), (-1.0, "-1"), (10.5, "10.5"), (None, None)], "x double, t string")
    df = df.withColumn("d", F.col("x").cast("decimal(9,2)"))
    fitted = encoding.fit_dictionary(df, ["x", "d", "t"])
    coded = encoding.encode(df, fitted, ["d"], into={"d": "code"})
    assert [r["x"] for r in coded.where("x is not null").orderBy("code").collect()] == [-1.0, 9.5, 10.5, 100.0]
    values = [r["value"] for r in fitted.where("feature = 'x'").orderBy("code").collect()]
    assert values == ["-1.0", "9.5", "10.5", "100.0"]


def test_factor_vectors_of_long_and_text_ids(spark):
    rows = [(3_000_000_000 + u, f"item{(u * k) % 7}", 1) for u in range(20) for k in range(1, 5)]
    df = spark.createDataFrame(rows, "u long, m string, w int")
    users, items = ranking.factor_vectors(df, "u", "m", "w", rank=4, rounds=1)
    assert {r["u"] for r in users.collect()} == {r[0] for r in rows}
    assert {r["m"] for r in items.collect()} == {r[1] for r in rows}


def test_recent_items_see_every_event(spark):
    df = spark.createDataFrame([(i, i % 2, i * 7) for i in range(700)], "t long, u long, m long")
    last = {r["t"]: r["items"] for r in samples.recent_items(df, "u", "m", ["t"], 5).collect()}
    first = {r["t"]: r["items"] for r in samples.recent_items(df, "u", "m", ["t"], 5, keep="first").collect()}
    assert last[698] == [7 * t for t in (688, 690, 692, 694, 696)] and last[1] == []
    assert first[699] == [7 * t for t in (1, 3, 5, 7, 9)] and first[4] == [0, 14]


def test_rows_with_null_keys_are_spread_without_any_hot_key(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("key"))
    table = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = attach(rows, table, ["key"])
        counts = [r["count"] for r in joined.where("key is null").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(counts) > 4 and max(counts) < 3600 / 2
    assert rows_of(joined, "id", "top") == rows_of(rows.join(table.drop("n"), "key", "left"), "id", "top")


def test_hot_sentinels_that_the_side_lacks_are_split(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 90).alias("key"))
    side = spark.range(60).select(F.col("id").alias("key"), (F.col("id") * 3).alias("v"))
    for how in ("left", "inner"):
        split = attach_side(rows, side, ["key"], how, rows_per_task=HOT)
        assert rows_of(split, "id", "key", "v") == rows_of(rows.join(side, "key", how), "id", "key", "v")
    plan = attach_side(rows, side, ["key"], rows_per_task=HOT)._jdf.queryExecution().toString()
    assert "_salt" in plan

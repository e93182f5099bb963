"""Values the reference states in its comments, and its schema traps."""

import math

import pytest
from pyspark.sql import functions as F

from recspark.functions import arrays, text, vectors
from recspark.operators import cleaning, embeddings, encoding, metrics, samples, scaling, search, sequences
from recspark.operators.features import FeatureProcessor, FeatureSpec
from recspark.plans import competition, ranking_dataset, recall
from recspark.sources import scans, schemas, sinks
from recspark.storage import new_path


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def lists(spark, rows, kind="array<int>"):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, a {kind}")


def column(df, c):
    return [r.x for r in df.orderBy("i").select(c.alias("x")).collect()]


def test_pad_ids(spark):
    df = lists(spark, [[1, 3, 4], [5, 6, 7, 8], [9], [10, 11, 12]])
    want = [[1, 3, 4, 0, 0], [5, 6, 7, 8, 0], [9, 0, 0, 0, 0], [10, 11, 12, 0, 0]]
    assert column(df, arrays.pad(F.col("a"), 5)) == want


def test_pad_truncation_sides(spark):
    df = lists(spark, [[1, 2, 3, 4], [], [7]])
    assert column(df, arrays.pad(F.col("a"), 3)) == [[2, 3, 4], [0, 0, 0], [7, 0, 0]]
    assert column(df, arrays.pad(F.col("a"), 3, keep="first")) == [[1, 2, 3], [0, 0, 0], [7, 0, 0]]
    assert column(df, arrays.valid_length(arrays.pad(F.col("a"), 3))) == [3, 0, 1]


def test_vocabulary_ids(spark):
    names = ["b,a", "a,c", "c,a,d"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, t string")
    tokens = text.words(F.col("t"), ",")
    vocabulary = sequences.fit_vocabulary(df, tokens, ["i"])
    got = {r.token: r.id for r in vocabulary.collect()}
    assert got == {"OOV": 1, "a": 2, "c": 3, "b": 4, "d": 5}
    other = spark.createDataFrame([(0, "a,zz"), (1, "")], "i int, t string")
    ids = sequences.sequence_ids(other, ["i"], tokens, vocabulary, 1)
    padded = sequences.pad_to_longest(ids, "ids")
    assert {r.i: r.ids for r in padded.collect()} == {0: [2, 1], 1: [0, 0]}


def test_words_filter_and_lower(spark):
    assert one(spark, text.words(F.col("t")), t="Ab-c, (D)\te!") == ["ab", "c", "d", "e"]


def test_first_seen_vocabulary_keeps_case(spark):
    df = spark.createDataFrame([(0, "Drama|Comedy"), (1, "comedy|Drama")], "i int, t string")
    fitted = sequences.fit_first_seen_vocabulary(df, arrays.split_list(F.col("t")), ["i"])
    assert {r.token: r.id for r in fitted.collect()} == {"Drama": 1, "Comedy": 2, "comedy": 3}


def test_encoder_map(spark):
    df = spark.createDataFrame([(1565,), (224,), (426,), (224,)], "v long")
    fitted = encoding.fit_dictionary(df, ["v"])
    assert {r.value: r.code for r in fitted.collect()} == {"224": 0, "426": 1, "1565": 2}
    as_text = encoding.fit_dictionary(df, ["v"], as_text=True)
    assert {r.value: r.code for r in as_text.collect()} == {"1565": 0, "224": 1, "426": 2}


def test_history_codes(spark):
    main = spark.createDataFrame([(12,), (45,), (7,)], "item_id long")
    fitted = encoding.feature_dictionary(encoding.fit_dictionary(main, ["item_id"]), "item_id")
    df = spark.createDataFrame([(0, "12,45,7,99"), (1, None), (2, "7,7,7,12,12,45")], "i int, h string")
    got = sequences.history_codes(df, ["i"], "h", fitted)
    want = {0: [1, 2, 0, 0, 0], 1: [0] * 5, 2: [0, 0, 1, 1, 2]}
    assert {r.i: r.h for r in got.collect()} == want


def test_user_sample_growth(spark):
    played = [82, 91, 120, 98, 45, 7]
    rows = [(175, item, t) for t, item in enumerate(played)] + [(1, 5, 0), (2, 5, 0), (2, 6, 1)]
    df = spark.createDataFrame(rows, "user_id long, sm_id long, timestamp long")
    got = samples.training_samples(df, "user_id", "sm_id", ["timestamp"], 0, 3)
    mine = got.where("user_id = 175")
    positives = {tuple(r.history): r.sm_id for r in mine.where("label = 1 and split = 'train'").collect()}
    assert positives == {(82,): 91, (91, 82): 120, (120, 91, 82): 98, (98, 120, 91, 82): 45}
    test = mine.where("split = 'test'").collect()
    assert [(r.history, r.sm_id, r.label, r.hist_len) for r in test] == [([45, 98, 120, 91, 82], 7, 1, 5)]
    negatives = mine.where("label = 0").collect()
    assert len(negatives) == 12 and {r.sm_id for r in negatives} <= {5, 6}
    assert got.where("user_id = 1").count() == 0
    assert [r.split for r in got.where("user_id = 2").collect()] == ["test"]


def test_repeats_stay_in_history(spark):
    df = spark.createDataFrame([(11, i, t) for t, i in enumerate([44, 97, 97, 59, 63, 90])], "u long, m long, t long")
    rows = samples.leave_last_out(samples.prefix_histories(df, "u", "m", ["t"]))
    test = rows.where("split = 'test'").first()
    assert (test.history, test.m, test.hist_len) == ([63, 59, 97, 97, 44], 90, 5)


def test_user_who_saw_everything_has_no_negatives(spark):
    rows = [(1, i, i) for i in range(5)] + [(2, i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "u long, m long, t long")
    got = samples.training_samples(df, "u", "m", ["t"], 0, 2)
    assert got.where("u = 1 and label = 0").count() == 0
    assert {r.m for r in got.where("u = 2 and label = 0").collect()} <= {3, 4}


def test_unseen_rank_is_the_complement(spark):
    seen = [0, 2, 3, 7]
    df = spark.range(6).select(samples.unseen_rank(F.array(*[F.lit(s).cast("long") for s in seen]), F.col("id")).alias("r"))
    assert sorted(r.r for r in df.collect()) == [1, 4, 5, 6, 8, 9]


def test_masked_softmax(spark):
    df = spark.createDataFrame([([0.3, 0.1, 0.9], [1, 2, 0]), ([0.3, 0.1, 0.9], [3, 0, 0]), ([0.1, 0.2, 0.3], [0, 0, 0])], "s array<double>, i array<int>")
    got = [r.x for r in df.select(arrays.masked_softmax(F.col("s"), F.col("i")).alias("x")).collect()]
    assert got[0][2] == 0 and sum(got[0]) == pytest.approx(1)
    assert got[1] == [1, 0, 0]
    assert got[2] == pytest.approx([1 / 3] * 3)


def test_title_map(spark):
    title = F.from_json(F.lit('{"72":1,"73":1,"74":1,"75":1,"71":1}'), "map<string,int>")
    row = spark.range(1).select(arrays.map_sum(title).alias("s"), arrays.map_keys_or_empty(title).alias("k")).first()
    assert (row.s, row.k) == (5, ["72", "73", "74", "75", "71"])
    empty = spark.range(1).select(arrays.map_keys_or_empty(F.lit(None).cast("map<string,int>")).alias("k"))
    assert empty.first().k == []


def test_cjk_text(spark):
    assert one(spark, text.keep_characters(F.col("t")), t="孙悟空, abc 大闹!") == "孙悟空 大闹"
    assert one(spark, text.characters(F.col("t")), t="孙 悟a空") == ["孙", "悟", "空"]
    assert one(spark, text.characters(F.col("t")), t="abc") == [""]
    assert one(spark, text.strip_lines(F.col("t")), t="　孙悟空 \r\n\n \t\n大闹") == "孙悟空\n大闹"
    assert one(spark, text.without_words(F.split("t", " "), ["的"]), t="a 的 b a") == ["a", "b", "a"]


def test_quantile_bins(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    fitted = scaling.fit_quantile_bins(df, {"x": 10})
    edges = fitted.first().edges
    assert edges[1] == pytest.approx(1.3) and len(edges) == 11
    got = scaling.quantile_bin(df, fitted).collect()
    assert [r.x for r in got] == [0, 3, 6, 9, None]
    same = spark.createDataFrame([(5.0,)] * 4 + [(6.0,)], "x double")
    fitted = scaling.fit_quantile_bins(same, {"x": 4})
    assert fitted.first().edges == [5.0, 6.0]


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 7), (None, 7), (5.0, 7)], "x double, c int")
    scaled = scaling.standard_scale(df, scaling.fit_standard(df, ["x", "c"])).collect()
    assert sum(r.x for r in scaled) == pytest.approx(0)
    assert math.sqrt(sum(r.x**2 for r in scaled) / 3) == pytest.approx(1)
    assert {r.c for r in scaled} == {0.0}
    ranged = scaling.minmax_scale(df, scaling.fit_minmax(df, ["x", "c"])).collect()
    assert [r.x for r in ranged] == [0.0, None, 1.0] and {r.c for r in ranged} == {0.0}


def test_recode(spark):
    df = spark.createDataFrame([(" 50000+.",), (" - 50000.",), ("x",)], "v string")
    codes = {" - 50000.": 0, " 50000+.": 1}
    assert [r[0] for r in df.select(cleaning.recode(F.col("v"), codes)).collect()] == [1, 0, None]
    assert [r[0] for r in df.select(cleaning.equals(F.col("v"), "x")).collect()] == [0, 0, 1]


def write(spark, lines, name):
    path = new_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_schema_traps(spark):
    path = write(spark, ["57384\t52\t43192\t142828\t0\t0\t0\t0\t4513\t34178\t53085993699\t39\t喜剧\t刘德华"], "lists")
    row = scans.delimited(spark, path, schemas.CLICKS_WITH_LISTS).first()
    assert (row.genres, row.actors, row.uid, row["like"]) == ("喜剧", "刘德华", 57384, 0)
    short = write(spark, ["1\t2\t3\t4\t5\t0\t1\t0\t9\t8"], "short")
    row = scans.delimited(spark, short, schemas.CLICKS).first()
    assert (row.device, row.time, row.duration_time) == (8, None, None)
    song = write(spark, ['060456,611720463661,1672671210,5,hi,android,IN,1,0,11,1,1000.0,8989,"",1584604060,6,IN,0'], "song")
    row = scans.delimited(spark, song, schemas.SONGS, sep=",").first()
    assert (row.user_id, row.song_genres, row.is_new) == ("060456", None, 0)
    assert len(schemas.CENSUS.fields) == 43 and schemas.CENSUS.fields[0].name == "row_id"
    census = ",".join(["138481", "62", " Private", "43"] + ["0"] * 4 + [" Never married"] + ["0"] * 33 + [" 50000+."])
    row = scans.delimited(spark, write(spark, [census], "census"), schemas.CENSUS, sep=",").first()
    assert (row.row_id, row.age, row.class_worker, row.marital_stat, row.income_50k) == (
        138481, 62.0, " Private", " Never married", " 50000+.",
    )


def test_keyed_json_and_names(spark):
    path = write(spark, ['{"7": [0.5, 1, 2, 3, 4, 5, 6, 7], "9": [1]}'], "face")
    rows = {r.item_id: r for r in scans.keyed_json(spark, path, "item_id", schemas.FACE_NAMES).collect()}
    assert rows["7"].male_perc == 0.5 and rows["7"].femalie_num == 7 and rows["9"].female_perc is None
    path = write(spark, ['{"1209082": ["小李子", "汤姆·哈迪"]}'], "actors")
    row = scans.keyed_json(spark, path, "movie", None, "string").first()
    assert row["items"] == ["小李子", "汤姆·哈迪"]


def test_fixed_decimals(spark):
    path = new_path(spark, "decimals")
    df = spark.createDataFrame([(1, 0.123456), (2, None)], "id long, x double")
    sinks.write_delimited(df, path)
    got = {r.id: r.x for r in spark.read.csv(path, schema="id string, x string", header=True).collect()}
    assert got == {"1": "0.1235", "2": None}


def test_processor_reload_gives_same_rows(spark):
    rows = [
        (i, 50 + i, i % 3, i * 10, i % 2, i % 4, 0, 0, -1, 5, 100 + i, i, "喜剧,爱情" if i % 2 else "爱情", "成龙", "10,20,99", "0,1")
        for i in range(12)
    ]
    df = spark.createDataFrame([(*r,) for r in rows], schemas.CLICKS_WITH_HISTORY)
    spec = FeatureSpec(key="uid", **{**ranking_dataset.CLICK_FEATURES, "sparse": ranking_dataset.CLICK_FEATURES["sparse"][1:]})
    processor, described, parts = ranking_dataset.build(df, spec)
    sizes = {r.feat: r.feat_num for r in described.collect()}
    assert sizes["genres"] == 4 and sizes["item_id"] == 3 and sizes["history_item_ids"] is None
    assert sum(p.count() for p in parts) == 12
    path = new_path(spark, "processor")
    processor.save(path)
    again = FeatureProcessor.load(spark, path, spec).transform(df)
    first = processor.transform(df)
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    assert again.first().genres[-1] in (0, 2, 3)


def test_search_matches_brute_force_in_small_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 8))
    base[60:100] = base[3]  # a third of all rows are copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    names = ("vec_id", "embedding", "vec_id", "embedding")
    for metric, scores in (
        ("inner", base @ base.T),
        ("l2", -((base[:, None] - base[None]) ** 2).sum(-1)),
    ):
        found = search.exact_topk(df, df, 4, metric, *names, block=16).collect()
        got = {}
        for r in sorted(found, key=lambda r: r.place):
            got.setdefault(r.query_id, []).append(r.item_id)
        for q in range(120):
            order = sorted(range(120), key=lambda i: (-round(scores[q, i], 9), i))[:4]
            assert got[q] == order


def test_all_lists_equal_exact_search(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    centroids = search.centroids_of(df, "embedding", 7)
    lists_ = search.build_lists(df, "vec_id", "embedding", centroids)
    all_probed = search.list_topk(df, lists_, centroids, 5, 7, "vec_id", "embedding", block=50)
    exact = search.exact_topk(df, df, 5, "l2", "vec_id", "embedding", "vec_id", "embedding")
    key = ("query_id", "item_id", "place")
    assert sorted(r[:] for r in all_probed.select(*key).collect()) == sorted(r[:] for r in exact.select(*key).collect())


def test_fewer_items_than_k(spark):
    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10, 14)], "item_id long, item_vec array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "query_id long, query_vec array<double>")
    found = search.exact_topk(queries, items, 5)
    assert found.where("query_id = 1").count() == 4
    assert found.where("query_id = 2").count() == 0
    packed = search.packed(found).first()["items"]
    assert [r.score for r in packed] == sorted((r.score for r in packed), reverse=True)


def test_similarity_properties(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [0.0, 1.0])], "token string, vector array<double>")
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "x")], "p string, q string")
    got = {(r.p, r.q): r.similarity for r in embeddings.pair_similarity(pairs, df, "p", "q").collect()}
    assert got[("a", "a")] == 1 and got[("a", "b")] == pytest.approx(0.6) and got[("a", "x")] is None
    near = embeddings.analogy(df, ["a"], [], 2).collect()
    assert [r.token for r in near] == ["b", "c"]
    assert one(spark, vectors.l2_normalize(F.array(F.lit(0.0), F.lit(0.0))), t=1) is None


def test_metrics(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first().auc == pytest.approx(0.875)
    assert metrics.roc_auc(df.where("y = 1"), "y", "p").first().auc is None
    assert metrics.accuracy(df, "y", "p").first().accuracy == 0.75
    sure = spark.createDataFrame([(1, 1.0), (0, 0.0)], "y int, p double")
    assert metrics.log_loss(sure, "y", "p").first().log_loss == pytest.approx(0, abs=1e-12)
    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 5, 1)], "u int, i int, place int")
    truth = spark.createDataFrame([(1, 6), (2, 9), (3, 1)], "u int, i int")
    got = metrics.recall_at(ranked, truth, "u", "i", "place", (1, 2)).first()
    assert (got.recall_at_1, got.recall_at_2) == (0, pytest.approx(1 / 3))


def test_competition_and_recall_plans(spark):
    rows = [
        (i, u, u % 5, (u * i) % 11, i % 4, i % 3, i % 2, int(i % 3 == 0), 0, -1, i % 6, 1000 * i, i % 30)
        for i, u in enumerate([1, 2, 3] * 40)
    ]
    names = "event long, uid int, user_city long, item_id int, author_id long, item_city long, channel int, finish int, `like` int, music_id long, did long, creat_time long, video_duration int"
    df = spark.createDataFrame(rows, names)
    binned = competition.time_bins(df)
    assert binned.agg(F.max("video_duration")).first()[0] == 9
    keyed = competition.with_composites(binned)
    counted = competition.distinct_features(competition.count_features(keyed))
    assert counted.count() == 120 and "uid-author_id_cnt" in counted.columns
    train, test = keyed.where("event < 100"), keyed.where("event >= 100")
    a, b = competition.mean_features(train, test, "finish", ["event"])
    assert a.count() == 100 and b.where(F.col("`did-channel_finish_mean`").isNull()).count() == 0
    found, scores = recall.recommend_and_score(
        df.withColumn("w", F.lit(1)), "uid", "item_id", "w", ["event"], k=3, rank=4, cutoffs=(3,)
    )
    assert 0 <= scores.first().recall_at_3 <= 1 and found.count() <= 9

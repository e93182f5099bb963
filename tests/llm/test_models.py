"""Quality, URLs, vectors, tokens, packing and shards: round trips, invariants, brute force."""

import itertools
import math
import random
import types
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recspark.llm import packing, permutation_index, quality, resharding, token_files, tokens, url_filter
from recspark.session import table

from .conftest import both, words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


# quality


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels)
    scored = quality.with_score(docs, model).join(labels.select("doc_id", "quality"), "doc_id").where(quality.held_out("doc_id"))
    rows = scored.select("score", "quality").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.85
    assert sum(g >= 0.3 for g in good) / len(good) > 0.97


def test_quality_scores_odd_rows(spark, docs, rows):
    labels = spark.createDataFrame([(i, i % 3 > 0 and 1 or 0) for i in range(40)] + [(1, 0), (2, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    scored = quality.with_score(docs, model)
    assert set(scored.columns) == set(docs.columns)
    found = scored.select("doc_id", "text", "score").collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    for same in (r for r in found if r.doc_id is None):
        assert same.score == next(r.score for r in found if r.doc_id is None)
    # one text at a time gives the same as a batch
    batch = [r.text for r in found]
    alone = [quality.scores(pa.array([t], pa.string()), model)[0] for t in batch]
    assert np.allclose(alone, [r.score for r in found], atol=1e-9)


@pytest.mark.parametrize("label, score", [(None, 0.5), (1, 1.0), (0, 0.0)])
def test_quality_without_two_classes(spark, docs, label, score):
    labels = spark.createDataFrame([(i, label) for i in range(9)], "doc_id bigint, quality int")
    found = quality.with_score(docs.limit(3), quality.fit(docs, labels)).collect()
    assert all(abs(r.score - score) < 1e-6 for r in found)


# urls


def _likeliest(name, counts, total):
    def cost(parts):
        return sum(math.log(counts[p] / total) if p in counts else math.log(10 / total) - len(p) * math.log(10) for p in parts)

    cuts = itertools.chain.from_iterable(itertools.combinations(range(1, len(name)), k) for k in range(len(name)))
    splits = [[name[a:b] for a, b in zip((0, *c), (*c, len(name)))] for c in cuts]
    return max(cost(s) for s in splits), cost


def test_segments_are_likeliest():
    counts = {"the": 900, "an": 500, "thean": 3, "ing": 70, "tion": 60, "a": 400, "n": 2}
    for name in ("theantion", "thean", "aning", "xyz", "nana", "a"):
        best, cost = _likeliest(name, counts, 5000)
        split = url_filter.segment(name, counts, 5000)
        assert "".join(split) == name and math.isclose(cost(split), best)
    assert url_filter.segment("", counts, 5000) == []


URLS = [
    (1, "https://A.Example.NET/en/x?y=1#z"), (2, "http://example.net/fr/1"), (3, "http://badexample.net"), (4, "https://x.example.com/de/5"),
    (5, "https://x.example.com/DE/5"), (6, "https://m.org/fr/"), (7, "https://m.org/en/12/redshoes"), (8, None), (9, "no scheme/at all"), (10, ""),
    (11, "http://"), (12, "ftp://u://v/w"), (13, "https://ads-track.example.com/en/1?q"), (14, "https://redshoes.org/es/9"), (14, "https://redshoes.org/es/9"),
    (None, "https://bluehats.example.com/fr/#a"), (16, "https://net/en/"), (17, "https://x.example.com?/de/"),
]
BLOCK, ALLOW = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]


def _parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    return rest[:end].lower(), path


def test_url_rules_and_scores(spark):
    html = "<p class='a'>red shoes and blue hats</p> red hats ads track" * 20
    pages = spark.createDataFrame([(i, u, html if i != 2 else None, "x", 1, 0.5) for i, u in URLS], "page_id bigint, url string, html string, host string, n int, score double")
    found = url_filter.judge(pages, BLOCK, ALLOW).collect()
    got, want = [], []
    for page, url in URLS:
        host, path = _parsed(url)
        fits = [r for r in BLOCK + ALLOW if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        want.append((page, host, path, max(fits, key=len) if fits else None))
    got = [(r.page_id, r.host, r.path, r.rule) for r in found]
    assert both(got, want)[0] == both(got, want)[1]
    assert all(r.verdict == ("block" if r.rule in BLOCK else "allow") for r in found if r.rule)
    assert all(r.verdict == ("block" if r.score > 0 else "allow") for r in found if not r.rule)
    # the model again, from the same tokens
    counts = Counter("red shoes and blue hats red hats ads track".split() * 20 * (len(URLS) - 1))
    model, classes, tokens_of = {True: Counter(), False: Counter()}, Counter(), {}
    for r in found:
        host = [w for part in __import__("re").split(r"[^a-z]+", r.host) if part for w in url_filter.segment(part, counts, sum(counts.values()))]
        path = ["#%d" % len(w) if w.isdigit() else w for w in __import__("re").split(r"[^a-z0-9]+", r.path.lower()) if w]
        tokens_of[r.host, r.path] = [("h", w) for w in host] + [("p", w) for w in path]
        block = r.rule in BLOCK if r.rule else (True if set(host) & set(url_filter.BLOCKED_WORDS) else None)
        if block is not None:
            classes[block] += 1
            model[block].update(tokens_of[r.host, r.path])
    for r in found:
        odds = math.log((classes[True] + 1) / (classes[False] + 1))
        for t in tokens_of[r.host, r.path]:
            odds += math.log((model[True][t] + 1) / (sum(model[True].values()) + url_filter.BUCKETS))
            odds -= math.log((model[False][t] + 1) / (sum(model[False].values()) + url_filter.BUCKETS))
        assert abs(odds - r.score) < 1e-6, r
    assert url_filter.judge(pages.limit(0), BLOCK, ALLOW).count() == 0


# vectors


def test_neighbours(spark):
    random = np.random.default_rng(4)
    centers = random.normal(size=(12, 16))
    vectors = (centers[random.integers(0, 12, 1500)] + random.normal(size=(1500, 16)) * 0.6).tolist()
    rows = [(i, v, "x", 1) for i, v in enumerate(vectors)]
    rows += [(2000 + i, vectors[7], "x", 1) for i in range(60)]  # equal vectors, queries among them
    rows += [(3000, None, "x", 1), (3050, [0.0] * 16, "x", 1), (3100, [float("nan")] * 16, "x", 1), (3150, [1.0] * 3, "x", 1), (3200, [None] * 16, "x", 1)]
    rows += [(3250, [float("inf")] + [1.0] * 15, "x", 1), (None, vectors[3], "x", 1), (50, vectors[50], "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string, rank int")
    found = permutation_index.search(frame, F.col("vec_id") % 50 == 0, 5, block_rows=400, query_rows=16).collect()
    ids = np.array([r[0] for r in rows[:1560]])
    matrix = np.array([r[1] for r in rows[:1560]])
    length = np.sqrt((matrix**2).sum(1))
    by_query = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by_query) == {i for i in ids.tolist() if i % 50 == 0}
    hits = 0
    for query, near in by_query.items():
        own = matrix[np.flatnonzero(ids == query)[0]]
        score = (matrix * own).sum(1) / (length * np.sqrt((own**2).sum()))
        order = [i for i in np.lexsort((ids, -np.round(score, 12))) if ids[i] != query][:5]
        assert len(near) == 5 and query not in [v for v, _ in near]
        assert [(-round(s, 12), v) for v, s in near] == sorted((-round(s, 12), v) for v, s in near)
        assert all(abs(score[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for v, s in near)
        hits += len({v for v, _ in near} & set(ids[order].tolist()))
    assert hits / (5 * len(by_query)) >= 0.9
    few = permutation_index.search(frame.where("vec_id < 3"), F.col("vec_id") == 0, 5).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert permutation_index.search(frame.limit(0), F.col("vec_id") == 0, 5).count() == 0


# tokens


def test_pieces_are_encoded_as_whole_texts(tokenizer, rows):
    odd = ["don't we'll *'s x'*s it''s 'tis", "a—b… ‘quoted’ it’s", "é é Å ﬁ ½ ² ٣ 12.5% $3", "<|endoftext|> x", "foo\x0bbar\x0cbaz\x1cq\x85w", "İstanbul ΑΣ ΣΑΣ.", "日本語テキスト。", "x́.y .́z", "a'b'c.d,e!!f  g"]
    texts = [*odd, *[t for _, t in rows], None]
    column = pa.array(texts, pa.string()).slice(1)  # an offset in the buffers
    found = []
    for _, ids, first in tokens.encoder(VOCABULARY).texts(column):
        found += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]


def test_packing_leaves_no_encoder_in_its_worker(monkeypatch):
    """Workers are reused by other stages, and a tokenizer with its pieces is large."""
    made = []

    class Noted(tokens.Encoder):
        def __init__(self, path):
            super().__init__(path)
            made.append(weakref.ref(self))

    for module in (tokens, packing):
        monkeypatch.setattr(module, "Encoder", Noted, raising=False)
    monkeypatch.setattr(tokens, "_encoders", {})
    monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], ["doc_id", "text"])
    assert sum(b.num_rows for b in packing._encoded(VOCABULARY, 64)(iter([batch]))) == 2
    assert made and all(encoder() is None for encoder in made)


def test_token_files_round_trip(tokenizer, docs, rows):
    files = token_files.write(docs, VOCABULARY, 49_408)
    read = files.payload(files.lookup(files.keys)).collect()
    assert Counter((r.doc_id, r.ids) for r in read) == Counter((d, _ids(tokenizer, t).tobytes()) for d, t in rows)
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at and r.length == len(r.ids) // 4
        at += r.length
    order = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert len({(r.doc_id, r.place) for r in read}) == len(rows)
    unknown = docs.sparkSession.createDataFrame([(10**9 + i, 0) for i in range(2000)], "doc_id bigint, place bigint")
    assert files.lookup(unknown).count() == 0


def test_token_files_of_nothing(empty):
    files = token_files.write(empty, VOCABULARY, 49_408)
    assert files.checksums(files.lookup(files.keys)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    perfect, end = token_files.PerfectHash.load(token_files.PerfectHash.build(keys).dump())
    assert sorted(perfect.slots(keys).tolist()) == list(range(n))


# packing


def _check_pieces(tokenizer, rows, pieces, limit):
    assert len(pieces) >= len(rows)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    padding = total = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limit
        total += at
        padding += limit - at if at & (at - 1) else 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append(_ids(tokenizer, text))
    for doc_id, texts in wanted.items():
        assert sum(n for _, n, _, _ in by_doc[doc_id]) == sum(map(len, texts))
        if len(texts) == 1:
            ids, at = texts[0], 0
            for start, n, crc, whole in sorted(by_doc[doc_id]):
                assert (start, whole) == (at, len(ids)) and zlib.crc32(ids[start : start + n].tobytes()) == crc
                at += n
    return padding / max(total, 1)


@pytest.mark.parametrize("limit", [2048, 64])
def test_packing(tokenizer, docs, rows, limit):
    assert _check_pieces(tokenizer, rows, packing.pack(docs, VOCABULARY, limit).collect(), limit) < (0.02 if limit > 64 else 0.3)


def test_packing_with_gaps_that_only_cuts_fill(spark, tokenizer):
    rows = [(i, " ".join(["the"] * 1200)) for i in range(7)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _check_pieces(tokenizer, rows, packing.pack(frame, VOCABULARY).collect(), 2048) == 0


def test_packing_nothing(empty):
    assert packing.pack(empty, VOCABULARY).count() == 0


def test_shortest_pack_first():
    draw = random.Random(3)
    for _ in range(30):
        histogram = Counter(draw.choice([draw.randint(1, 100), 7, 50]) for _ in range(draw.randint(1, 300)))
        patterns = packing.shortest_pack_first(histogram, 100)
        used = Counter()
        for lengths, count in patterns:
            assert sum(lengths) <= 100 and count > 0 and list(lengths) == sorted(lengths, reverse=True)
            for n in lengths:
                used[n] += count
        assert used == histogram


# shards


def test_fewest_bytes_move():
    draw = random.Random(6)
    for _ in range(40):
        sizes = [draw.randint(0, 500) for _ in range(draw.randint(1, 9))]
        shards = draw.randint(1, 9)
        total = sum(sizes)
        room = [total // shards + (b < total % shards) for b in range(shards)]
        flow = resharding.fewest_moved(sizes, room)
        assert flow.sum(1).tolist() == sizes and flow.sum(0).tolist() == room and (flow >= 0).all()
        stays = sum(min(a, b) for a, b in zip(sizes, room))
        assert total - np.trace(flow) == total - stays
    cost = np.array([[1, 4], [2, 9]])
    assert (resharding.fewest_moved([5, 5], [5, 5], cost) * cost).sum() == 30
    with pytest.raises(ValueError):
        resharding.fewest_moved([3], [2])


def test_reshard(docs, rows, empty):
    old = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    placed, folder = resharding.reshard(docs, old, 4, 6)
    assert set(placed.columns) == {*docs.columns, "moved"}
    found = placed.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    slots, size = defaultdict(list), Counter()
    for r in found:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += len((r.text or "").encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(6))
    assert docs.sparkSession.read.parquet(folder).count() == len(rows)
    again = resharding.reshard(docs.coalesce(1), old, 4, 6)[0].collect()
    assert Counter((r.doc_id, r["shard"]) for r in again) == Counter((r.doc_id, r["shard"]) for r in found)
    assert resharding.reshard(empty, old, 4, 6)[0].count() == 0


def test_shards_come_out_nearly_equal(spark):
    placed, _ = resharding.reshard(table(spark, "/root/testdata/sf0.1", "documents"), F.pmod(F.xxhash64("doc_id"), F.lit(32)), 32, 40)
    sizes = [r["b"] for r in placed.groupBy("shard").agg(F.sum(F.octet_length("text") + 16).alias("b")).collect()]
    assert len(sizes) == 40 and max(sizes) < 1.02 * min(sizes)

"""Line runs, near duplicates, benchmark matches and repeated strings against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from recspark.llm import bytesarrays, decontamination, jaccard, line_runs, repeats
from recspark.llm.components import components
from recspark.llm.suffixes import search, suffix_order

from .conftest import both, words

LOWER = {c: c + 32 for c in range(65, 91)}


def test_suffix_order_is_the_sorted_order():
    for n, kinds in ((1, 1), (50, 2), (400, 3)):
        codes = np.random.default_rng(n).integers(1, kinds + 1, n)
        order, _ = suffix_order(codes, n)
        assert order.tolist() == sorted(range(n), key=lambda i: codes[i:].tolist())
    assert len(suffix_order(np.zeros(0, np.int64), 4)[0]) == 0


def test_search_finds_every_occurrence():
    codes = np.random.default_rng(1).integers(1, 4, 200)
    order, _ = suffix_order(codes, 200)
    wanted = np.array([[1, 2, 3], [3, 3, 0], [2, 0, 0]])
    low, high = search(np.concatenate((codes, np.zeros(3, np.int64))), order, wanted, np.array([3, 2, 1]))
    for row, length, a, b in zip(wanted, (3, 2, 1), low, high):
        found = [i for i in range(200) if codes[i : i + length].tolist() == row[:length].tolist()]
        assert sorted(order[a:b].tolist()) == found


def test_line_runs(docs, rows):
    once = []  # rows that repeat doc_id and text are one document
    for row in rows:
        if row not in once:
            once.append(row)
    cleaned = line_runs.without_repeats(docs)
    assert set(cleaned.columns) == {*docs.columns, "n_lines", "n_removed"}
    found = cleaned.collect()
    assert len(found) == len(rows)
    # the order of equal ids is that of a hash, so take it from the result: null first, then 3
    hashes = {(r[0], r[1]): r[2] for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text)").collect()}
    order = sorted(once, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r]))
    seen, gone = set(), defaultdict(set)
    for row in order:
        lines = [(n, l) for n, l in enumerate((row[1] or "").split("\n")) if l.split()]
        for i in range(len(lines)):
            for depth in (1, 2, 3):
                run = tuple(l for _, l in lines[i : i + depth])
                if len(run) == depth and (depth == 3 or sum(len(l.split()) for l in run) >= 8) and run in seen:
                    gone[row] |= {n for n, _ in lines[i : i + depth]}
                if len(run) == depth:
                    seen.add(run)
    assert any(gone.values())
    for r in found:
        assert r.n_removed == len(gone[next(o for o in once if o[0] == r.doc_id and _reduced(o[1], gone[o]) == r.text)])
    wanted = [(r[0], _reduced(r[1], gone[r])) for r in rows]
    assert both([(r.doc_id, r.text) for r in found], wanted)[0] == both([], wanted)[1]


def _reduced(text, gone):
    return text if text is None else "\n".join(l for n, l in enumerate(text.split("\n")) if n not in gone)


def _shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4)) if len(found) >= 5 else frozenset([tuple(found)] if found else [])


def _component_ids(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    smallest = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sets, [smallest[find(i)] for i in range(len(rows))], [find(i) for i in range(len(rows))]


def test_leaders_meet_every_other_set(spark):
    """A list of no more sets than leaders meets in all its pairs that lie in different
    components and may link; longer ones in some of them, and the join makes one row a set."""
    lists = {t: [(1000 * t + i, 20 + (7 * i) % 30, (5 * i) % 6, 1000 * t + i - i % 2) for i in range(m)] for t, m in enumerate([2, 3, 40, 300])}
    rows = [(t, *r) for t, own in lists.items() for r in own]
    postings = spark.createDataFrame(rows, "token long, x long, nx long, at long, root long")
    possible = {
        (min(x, y), max(x, y))
        for own in lists.values()
        for x, a, p, u in own
        for y, b, q, v in own
        if x != y and u != v and 7 * min(min(p, q) + min(a - p, b - q), a, b) >= 3 * (a + b)
    }
    for salt in (1, 2):
        found = [tuple(r) for r in jaccard._leader_pairs(postings, salt).collect()]
        assert len(found) == len(set(found)) and set(found) <= possible
        # the same leaders, paired one by one
        drawn = {}
        for t, own in lists.items():
            keys = [(r[0], salt * jaccard.LEADERS + j) for r in own for j in range(jaccard.LEADERS)]
            hashed = spark.createDataFrame(keys, "x long, j int").selectExpr("x", "j", "xxhash64(x, j) as h").collect()
            drawn[t] = {min((r.h, r.x) for r in hashed if r.j == j)[1] for j in {r.j for r in hashed}}
        wanted = {p for p in possible if drawn[p[0] // 1000] & set(p)}
        assert set(found) == wanted


def test_jaccard_components(docs, rows):
    sets, ids, _ = _component_ids(rows)
    found = jaccard.link_components(docs).collect()
    got, want = both(found, [(r[0], len(s), c) for r, s, c in zip(rows, sets, ids)])
    assert got == want
    assert max(Counter(ids).values()) > 100


def test_one_document_of_each_component_stays(docs, rows):
    sets, _, roots = _component_ids(rows)
    kept = jaccard.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {g for g, s in zip(roots, sets) if s}
    assert len(ids) == len(groups) + sum(not s for s in sets)
    best = {g: min((r[0] is None, r[0] or 0) for r, x in zip(rows, roots) if x == g) for g in groups}
    wanted = Counter([None if none else d for none, d in best.values()] + [r[0] for r, s in zip(rows, sets) if not s])
    assert Counter(ids) == wanted


@pytest.mark.parametrize("overlap", [0, 10, 40, 85, 86, 100])
def test_divide_skip_counts_exactly(overlap):
    query = np.sort(np.random.default_rng(2).choice(10**6, 100, replace=False)).astype(np.uint64)
    other = np.sort(np.concatenate((query[:overlap], np.arange(10**7, 10**7 + 100 - overlap)))).astype(np.uint64)
    filler = [np.sort(np.concatenate((query[50:], np.arange(k * 10**8, k * 10**8 + 50)))).astype(np.uint64) for k in range(1, 5)]
    linked = jaccard.divide_skip(query, [other, *filler])
    assert linked.tolist() == [100 * overlap >= 75 * (200 - overlap), *[False] * 4]
    assert jaccard.may_link(jaccard.sketch(query), jaccard.sketch(query[:90]), 100, 90)


def _items(rows):
    base = words(3, 90)
    return [
        (0, " ".join(base[5:30])), (1, "One two"), (2, None), (3, "..."), (None, " ".join(words(900, 60)[10:25])),
        (10, " ".join(base[20:45]).upper().replace("É", "É")), (0, " ".join(base[5:30])), (5, "never seen " * 9),
    ]


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_benchmark_matches(spark, docs, rows, block_bytes):
    items = _items(rows)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        own = word.findall((text or "").translate(LOWER))
        for i in range(max(len(own) - 9, min(len(own), 1))):
            windows[tuple(own[i : i + 10])].add("" if item is None else str(item))
    wanted = []
    for doc_id, text in rows:
        own, hit, met = word.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    met |= windows[tuple(own[i : i + size])]
                    hit |= set(range(i, i + size))
        wanted.append((doc_id, len(own), len(hit), ",".join(sorted(met))))
    found = decontamination.with_matches(docs, benchmark, block_bytes=block_bytes).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(sorted({m.item_id for m in r.matches}))) for r in found]
    assert both(got, wanted)[0] == both(got, wanted)[1]
    assert sum(w[2] > 0 for w in wanted) > 3
    longest = max(m.words for r in found for m in r.matches)
    assert longest == 25 or block_bytes < 1000
    clean = decontamination.clean(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(w[2] == 0 for w in wanted)


def _covered(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        yield np.cumsum(gone)[:-1] > 0


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1_500])
def test_repeated_strings(docs, rows, shard_bytes):
    """The small shards divide the anchors of the dense group over several."""
    length = 100
    texts = [(t or "").encode() for _, t in rows]
    wanted = []
    for (doc_id, _), t, gone in zip(rows, texts, _covered(texts, length)):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        wanted.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    found = repeats.without_repeats(docs, length, shard_bytes).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert both(got, wanted)[0] == both(got, wanted)[1]


def test_short_periods_give_few_stretches():
    """One anchor per period and text is kept, and strings at the end of a run get others."""
    run, own = "Is onhe. ", [" ".join(words(k, 90)).encode() for k in (21, 22)]
    for period in (b"x", b"ab", run.encode(), b"seventeen letters"):
        text = np.frombuffer(own[0] + period * (30_000 // len(period)) + own[1], np.uint8)
        bounds = np.array([0, len(text)])
        found = repeats.anchors(text, bounds, 400)
        keep, again = repeats.folded(text, bounds, found, 400)
        assert int((found[4] - found[3] + 1).sum()) == len(text) - 399  # each string has its anchor
        assert int(keep.sum()) < 30
        inside = np.zeros(len(text), bool)
        for a, b in zip(found[3][again].tolist(), found[4][again].tolist()):
            inside[a : b + 400] = True
        assert inside.sum() > 29_000


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1_500])
def test_repeats_of_short_periods(spark, shard_bytes):
    """Runs of a short period in one text only, in several, cut at other places, and once as
    long as a string; with nothing else that repeats."""
    length = 100
    own = [" ".join(words(40 + k, 60)) for k in range(12)]
    texts = [own[0] + "x" * 900 + own[1], own[2] + "Is onhe. " * 80, own[3] + "onhe. Is " * 60 + own[4]]
    texts += [own[5] + ("x" * 100) + own[6], "ab" * 300, own[7] + "Is onhe. " * 12 + own[8], own[9] + "zy" * 120 + own[10] + "zy" * 70]
    texts += [own[11] + "lone run " * 40, "q" * 100, "w" * 101, "é" * 90 + "x" * 99]
    texts = [t.encode() for t in texts]
    wanted = []
    for i, (t, gone) in enumerate(zip(texts, _covered(texts, length))):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        wanted.append((i, int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), kept))
    rows = [(i, t.decode()) for i, t in enumerate(texts)]
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), length, shard_bytes)
    assert sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()) == wanted


def test_shards_count_all_their_bytes(spark, monkeypatch):
    """Stretches with copies are in the shards of their anchor too, so they count."""
    sizes = []
    monkeypatch.setattr(repeats, "materialize", lambda df, label: sizes.append((label, df.collect())) or df)
    rows = [(7, i, 1 if i == 0 else 2, (f"{i:04d}" * 100).encode()) for i in range(60)]
    repeats.marked(spark.createDataFrame(rows, "anchor long, stretch long, n int, bytes binary"), 100, 2_000)
    (_, dealt), *_ = sizes
    held = Counter(r.shard for r in dealt)
    assert sum(held.values()) == 60 and max(held.values()) <= 30


def test_long_texts_come_in_pieces(monkeypatch):
    text = np.frombuffer(" ".join(words(8, 3000)).encode(), np.uint8)
    whole = repeats.anchors(text, np.array([0, len(text)]), 100)
    monkeypatch.setattr(repeats, "_PIECE", 1000)
    named = set()
    for low, at, piece, bounds in repeats._pieces(text, np.array([0, len(text)]), 100):
        _, value, place, first, last = repeats.anchors(piece, bounds, 100)
        named |= {(s + at, p + at) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist()) for s in range(a, b + 1)}
    assert named == {(s, p) for p, a, b in zip(whole[2].tolist(), whole[3].tolist(), whole[4].tolist()) for s in range(a, b + 1)}


def test_words_of_long_slices_keep_no_long_tables(monkeypatch):
    monkeypatch.setattr(bytesarrays, "_state", {})
    text = np.frombuffer(("One two  three " * 150_000).encode(), np.uint8)
    hashes, first = decontamination.words(text, np.array([0, len(text)]))
    assert len(bytesarrays._state["powers"]) < len(text) and first.tolist() == [0, 450_000]
    alone = [decontamination.words(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0] for w in (b"one", b"two", b"three")]
    assert (hashes.reshape(-1, 3) == np.array(alone)).all()


def test_empty_tables(spark, empty, docs):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert line_runs.without_repeats(empty).count() == 0
    assert jaccard.link_components(empty).count() == 0
    assert jaccard.first_of_each(empty).count() == 0
    assert repeats.without_repeats(empty).count() == 0
    assert decontamination.with_matches(empty, items).count() == 0
    assert decontamination.with_matches(docs, items).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("per_task", [3, 40, 10**6])
def test_components(spark, per_task):
    draw = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 150, (110, 2))] + [(i, i + 1) for i in range(200, 260)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    found = components(spark.createDataFrame(edges, "u long, v long").repartition(7), per_task).collect()
    assert sorted(map(tuple, found)) == sorted((n, find(n)) for n in root)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

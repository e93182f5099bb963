"""Periodic runs against brute force, and the query's digests from plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from recspark.llm import period_runs
from recspark.llm.grammar import Grammar
from recspark.llm.queries import QUERIES

from .conftest import CLASH, SCHEMA, odd_texts, words


def brute_runs(sequence, least=24):
    found = {}
    for period in range(1, len(sequence) // 3 + 1):
        at = 0
        while at + period < len(sequence):
            end = at
            while end + period < len(sequence) and sequence[end] == sequence[end + period]:
                end += 1
            if end - at + period >= max(least, 3 * period):
                found.setdefault((at, end - at + period), period)
            at = max(end, at + 1)
    return sorted((start, length, period) for (start, length), period in found.items())


def collapse(sequence, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(sequence) if i not in gone]


def sequences(seed, count):
    draw = random.Random(seed)
    out = []
    for _ in range(count):
        n = draw.choice([0, 1, 5, 24, 40, 120, 400])
        own = [draw.randrange(draw.choice([1, 2, 3, 30])) for _ in range(n)]
        if n > 10 and draw.random() < 0.6:
            period, at = draw.randint(1, n // 3), draw.randrange(n)
            own[at:] = [own[at + i % period] for i in range(n - at)]
        if n > 10 and draw.random() < 0.3:
            own[draw.randrange(n)] = 99
        out.append(own)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_runs_and_extensions(seed):
    texts = sequences(seed, 8)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    flat = np.array([w for t in texts for w in t], np.int64)
    found = period_runs.runs_of(flat, starts)
    for k, own in enumerate(texts):
        assert [tuple(r[1:]) for r in found.tolist() if r[0] == k] == brute_runs(own)
    grammar, draw, asked = Grammar(flat, starts), random.Random(seed), []
    for k, own in enumerate(texts):
        asked += [(k, *sorted(draw.sample(range(len(own)), 2))) for _ in range(20) if len(own) > 2]
    x, y = (np.array([grammar.place[starts[q[0]] + q[side]] for q in asked]) for side in (1, 2))
    for (k, i, j), after, before in zip(asked, grammar.extension(x, y), grammar.extension(x, y, back=True)):
        own = texts[k]
        assert own[i : i + after] == own[j : j + after] and (j + after == len(own) or own[i + after] != own[j + after])
        assert own[i - before : i] == own[j - before : j] and (i == before or own[i - before - 1] != own[j - before - 1])


def test_slices_of_candidates(monkeypatch):
    monkeypatch.setattr(period_runs, "QUERIES", 3)
    own = [0] * 90 + [1, 2, 3] * 30 + [4] * 40
    found = period_runs.runs_of(np.array(own * 2), np.array([0, len(own), 2 * len(own)]))
    assert [tuple(r[1:]) for r in found.tolist()] == brute_runs(own) * 2


def planted(doc_id, own):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(own)
    if doc_id is None or h % 10 or not n:
        return own
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return own[:a] + [own[a + (i - a) % p] for i in range(a, n)]


def test_operator_and_query(spark, tmp_path):
    texts = odd_texts() + [" ".join(words(i, 40 + 9 * i)) for i in range(40)]
    texts += ["la " * 900, "a b c " * 200 + "d", "\x1fx\x85y  " * 40, " ".join(words(3, 2_000)), "ab " * 24, "ab " * 23]
    rows = [(i, t, *CLASH) for i, t in enumerate(texts)] + [(None, "no id " * 30, *CLASH), (3, texts[20], *CLASH), (3, texts[20], *CLASH)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("runs", docs_clash())
    found = period_runs.with_runs(docs)
    assert set(found.columns) == {*docs.columns, "n_words", "collapsed"}
    for r in found.collect():
        own = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = brute_runs(own)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(own)
        assert r.collapsed == " ".join(collapse(own, runs)) and r["lang"] == "en"
    docs.drop("runs").write.parquet(f"{tmp_path}/documents.parquet")
    seen = QUERIES["op13_period_runs"](spark, str(tmp_path)).collect()
    wanted = []
    for doc_id, text, *_ in rows:
        own = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = brute_runs(own)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        texts_of = "".join(f"{s},{n},{p}\n" for s, n, p in runs), " ".join(collapse(own, runs))
        wanted.append((doc_id, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in texts_of)))
    assert sorted(map(tuple, seen), key=repr) == sorted(wanted, key=repr)
    assert sum(w[1] > 0 for w in wanted) > 6


def docs_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_empty(spark, empty):
    assert period_runs.with_runs(empty).count() == 0

"""Quality classifier: learned hashed word and character n-gram vectors, averaged per text.

A text's features are its words (between white space) and its 3- and 4-byte n-grams, hashed
to a fixed table of vectors. Their mean goes through a two-class softmax. Vectors and
softmax are trained together by stochastic gradient descent in numpy on a bounded sample of
labelled rows (`max_rows`); everything after that covers all rows and whole texts.

After training, each vector meets the softmax in one number, and a mean of products is the
product with the mean, so scoring looks up one number per feature instead of a vector.

Defined cases: a null or empty text has no features and gets the score of the bias alone;
rows without a label (or a null one) are scored and never trained on; a doc_id with several
labels takes its smallest; without any label the score is 0.5, with labels of one class it
is that class; repeated rows get equal scores; a column named like the new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesarrays import flat, give_back, prefix_hashes, runs, slices, span_hashes

BUCKET_BITS = 17
DIMENSIONS = 8
_WORD_SALT, _TRI, _QUAD = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Model:
    """One number per feature bucket, and the bias: log odds of label 1."""

    weights: np.ndarray
    bias: float


def _bucket(values: np.ndarray, salt: np.uint64) -> np.ndarray:
    return ((values * salt) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _feature_groups(data: np.ndarray, starts: np.ndarray):
    """(buckets, bounds per text) for words, 3-byte and 4-byte n-grams of flat texts."""
    first, last = runs(~_SPACE[data], starts)
    if len(first):
        hashes = span_hashes(prefix_hashes(data), first, last)
        yield _bucket(hashes, _WORD_SALT), np.searchsorted(first, starts)
    codes = data.astype(np.uint64)
    grams = codes
    for size, salt in ((2, None), (3, _TRI), (4, _QUAD)):
        if len(data) < size:
            return
        grams = (grams[:-1] << np.uint64(8)) | codes[size - 1 :]
        if salt is None:
            continue
        whole = np.ones(len(grams), bool)
        for back in range(1, size):  # grams that reach into the next text
            at = starts[1:] - back
            whole[at[(at >= 0) & (at < len(grams))]] = False
        yield _bucket(grams[whole], salt), np.concatenate(([0], np.cumsum(whole)))[np.minimum(starts, len(whole))]


def feature_bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares; at most one entry per bucket."""
    data, starts = flat(column)
    bags = []
    for row in range(len(starts) - 1):
        own = data[starts[row] : starts[row + 1]]
        groups = [g for g, _ in _feature_groups(own, np.array([0, len(own)]))]
        found = np.concatenate(groups) if groups else np.zeros(0, np.int32)
        buckets, counts = np.unique(found, return_counts=True)
        bags.append((buckets, (counts / max(len(found), 1)).astype(np.float32)))
    return bags


def _sums(table: np.ndarray, groups, rows: int) -> tuple[np.ndarray, np.ndarray]:
    total, count = np.zeros(rows), np.zeros(rows, np.int64)
    for buckets, bounds in groups:
        running = np.concatenate(([0.0], np.cumsum(table[buckets])))
        total += running[bounds[1:]] - running[bounds[:-1]]
        count += np.diff(bounds)
    return total, count


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    data, starts = flat(column)
    out = np.empty(len(starts) - 1)
    table = model.weights.astype(np.float64)
    for first, last in slices(starts):
        own = data[starts[first] : starts[last]]
        total, count = _sums(table, _feature_groups(own, starts[first : last + 1] - starts[first]), last - first)
        out[first:last] = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -500, 500)))
    return out


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    epochs: int = 4,
    rate: float = 4.0,
    batch: int = 16,
) -> Model:
    """Vectors and softmax by stochastic gradient descent; the seed is fixed."""
    size = 1 << BUCKET_BITS
    share = float(np.mean(labels)) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        bias = 0.0 if not len(labels) else (30.0 if share else -30.0)
        return Model(np.zeros(size, np.float32), bias)
    random = np.random.default_rng(7)
    vectors = np.asfortranarray(random.uniform(-0.5, 0.5, (size, DIMENSIONS)).astype(np.float32))
    softmax = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps = epochs * -(-len(labels) // batch)
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            now = rate * (1 - step / steps)
            step += 1
            ids = np.concatenate([bags[r][0] for r in rows])
            shares = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            taken = vectors[ids]
            means = np.stack([np.bincount(owner, taken[:, d] * shares, len(rows)) for d in range(DIMENSIONS)], 1)
            logits = means @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            wrong = odds / odds.sum(1, keepdims=True)
            wrong[np.arange(len(rows)), labels[rows]] -= 1
            back = (wrong @ softmax.T).astype(np.float32)
            softmax -= (now / len(rows) * (means.T @ wrong)).astype(np.float32)
            bias -= (now / len(rows) / 10 * wrong.sum(0)).astype(np.float32)
            for d in range(DIMENSIONS):
                vectors[:, d] -= np.bincount(ids, now * shares * back[owner, d], size)
    difference = softmax[:, 1] - softmax[:, 0]
    return Model((vectors @ difference).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 3000, max_entries: int = 1 << 24) -> Model:
    """Train on at most `max_rows` rows whose crc32(doc_id) mod 5 is not 0.

    The rows are those with the smallest hash of doc_id, in that order. One task trains: it keeps
    a bag of at most one entry per bucket for each row, and leaves out a row whose bag would make
    them more than `max_entries` (8 bytes each). Only the weights reach the driver.
    """
    label = F.col("quality").cast("int")
    sample = (
        labels.select("doc_id", label.alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # two large arrays, of which only what is filled takes memory
        ids, shares = np.empty(max_entries, np.int32), np.empty(max_entries, np.float32)
        marks, bounds = [], [0]
        for batch in batches:
            for row in range(batch.num_rows):
                (bag,) = feature_bags(batch.column("text").slice(row, 1))
                end = bounds[-1] + len(bag[0])
                if end <= max_entries:
                    ids[bounds[-1] : end], shares[bounds[-1] : end] = bag
                    marks.append(batch.column("label")[row].as_py())
                    bounds.append(end)
        bags = [(ids[a:b], shares[a:b]) for a, b in zip(bounds, bounds[1:])]
        model = train(bags, np.array(marks, np.int64))
        del bags, ids, shares
        give_back()
        columns = [pa.array([model.weights.tobytes()]), pa.array([model.bias])]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "bias"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    found = rows.select("text", "label").mapInArrow(trained, "weights binary, bias double").first()
    if found is None:  # no task for no rows
        return train([], np.zeros(0, np.int64))
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"])


def held_out(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Add the probability of label 1 for the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = pa.array(scores(texts, shared.value))
        give_back()
        return found

    return docs.withColumn(name, score("text"))

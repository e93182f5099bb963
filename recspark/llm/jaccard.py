"""N-gram Jaccard join by T-occurrence search over inverted lists (DivideSkip).

A document is the set of its 5-word shingles. Two documents link at a Jaccard similarity of
0.75 or more, which for sets of a and b shingles means an overlap of T = ceil(3 (a + b) / 7).

1. Documents with equal sets are one class from the start (a 64-bit hash of the set).
2. Linked sets share a shingle among the first quarter of either, in any common order of
   shingles. The order puts frequent shingles last, so posting lists stay short. Which
   shingles count as frequent is estimated on a sixteenth of the sets; a wrong guess costs
   time and never a link.
3. A list of up to `SHORT` sets gives all its pairs that length and position allow. Postings
   of frequent shingles and longer lists are kept as rows: each set in such a list meets
   `LEADERS` random sets of the list, components are formed, and only lists that still hold
   several components go on - first to other leaders, at last to all pairs across
   components. So a dense group of near copies costs a few pairs per member, and every pair
   that is neither tested nor already in one component gets tested.
4. A pair must pass a parity sketch: bit h mod w is the parity of the shingles with that
   hash, so the differing bits of two sketches never exceed the symmetric difference. This
   drops nearly all unlinked pairs and no linked one. All pairs of a long list are tested by
   sketches of eight times the width before they leave their task.
5. Remaining pairs are grouped by query set and answered by DivideSkip: the lists of the
   query's shingles are divided into long and short ones, the short ones are merged with
   counts, candidates that can still reach T are probed in the long ones by binary search.

Links become components by star contraction. Nothing of all documents reaches the driver
but the frequent shingles, at most `FREQUENT` numbers.

Defined cases: words are split at white space and A-Z lower-cased; a text with 1 to 4 words
has its whole sequence as its one shingle; null, empty and blank texts have an empty set and
link with nothing; repeated rows form one class; a null doc_id takes part but is never the
smallest id unless all of its component are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..storage import materialize
from .bytesarrays import LOWER, flat, give_back, mix, prefix_hashes, runs, slices, span_hashes
from .components import components

WORDS = 5
SHORT = 64
LEADERS = 8
FREQUENT = 200_000
SMALL_IDS = 500_000  # document ids that may be broadcast to find their texts
_SAMPLE = 16
_PER_GROUP = 1_000_000  # postings per group of lists
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False
_POSTING = np.dtype([("token", "<u8"), ("set", "<i8"), ("n", "<i4"), ("at", "<i4")])


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingles, bounds per row) by slices; each row's shingles are distinct and sorted."""
    data, starts = flat(column)
    for low, high in slices(starts):
        own = LOWER[data[starts[low] : starts[high]]]
        bounds = starts[low : high + 1] - starts[low]
        first, last = runs(_INSIDE[own], bounds)
        if not len(first):
            yield low, np.zeros(0, np.uint64), np.zeros(high - low + 1, np.int64)
            continue
        hashes = np.concatenate((span_hashes(prefix_hashes(own), first, last), np.zeros(WORDS, np.uint64)))
        word = np.searchsorted(first, bounds)
        counts = np.diff(word)
        text = np.repeat(np.arange(high - low), counts)
        left = word[1:][text] - np.arange(len(first))  # words from here to the text's end
        grams = np.zeros(len(first), np.uint64)
        for j in range(WORDS):
            grams = mix(grams + np.where(left > j, hashes[j : j + len(first)], np.uint64(0)) + np.uint64(j + 1))
        use = (left >= WORDS) | ((counts < WORDS)[text] & (left == counts[text]))
        grams, text = grams[use], text[use].astype(np.int32)
        by = np.argsort(grams, kind="stable")
        by = by[np.argsort(text[by], kind="stable")]
        grams, text = grams[by], text[by]
        fresh = np.ones(len(grams), bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        grams, text = grams[fresh], text[fresh]
        yield low, grams, np.searchsorted(text, np.arange(high - low + 1))


def set_ids(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set; empty sets have 0."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams + np.uint64(0x51ED270B)), dtype=np.uint64)))
    size = np.diff(bounds).astype(np.uint64)
    ids = mix(sums[bounds[1:]] - sums[bounds[:-1]] + size * np.uint64(0x9E3779B97F4A7C15))
    return np.where(size > 0, ids, np.uint64(0)).astype(np.int64)


def sketch(grams: np.ndarray, room: int = 1) -> bytes:
    """Parity of the shingles by hash modulo a power of two that is at least `room` times
    their number. With more room fewer shingles cancel out: 8 leaves few unlinked pairs."""
    width = 1 << max(6, min(room * len(grams) - 1, 1 << 21).bit_length()) if len(grams) else 64
    odd = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(left: bytes, right: bytes, a: int, b: int) -> bool:
    """Whether the sketches allow the overlap that sets of a and b shingles need."""
    x, y = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # fold the longer one
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum()) <= a + b - 2 * needed(a, b)


def needed(a, b):
    """The overlap that links sets of these sizes."""
    return -(-3 * (a + b) // 7)


def divide_skip(query: np.ndarray, candidates: list[np.ndarray]) -> np.ndarray:
    """Which candidates share the needed number of shingles with the query set."""
    sizes = np.array([len(c) for c in candidates])
    wanted = needed(sizes, len(query))
    tokens = np.concatenate(candidates)
    owner = np.repeat(np.arange(len(candidates)), sizes)
    at = np.minimum(np.searchsorted(query, tokens), len(query) - 1)
    inside = query[at] == tokens
    at, owner = at[inside], owner[inside]
    length = np.bincount(at, minlength=len(query))  # of each inverted list
    least = int(wanted.min())
    long_lists = min(int(least / (0.01 * np.log2(max(length.max(), 2)) + 1)), least - 1)
    is_long = np.zeros(len(query), bool)
    if long_lists > 0:
        is_long[np.argsort(length, kind="stable")[-long_lists:]] = True
    count = np.bincount(owner[~is_long[at]], minlength=len(candidates))
    alive = np.flatnonzero(count >= wanted - int(is_long.sum()))
    probes = query[is_long]
    for c in alive:
        place = np.searchsorted(candidates[c], probes)
        place[place == sizes[c]] = 0
        count[c] += int((candidates[c][place] == probes).sum())
    return count >= wanted


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, grams, bounds in shingle_sets(batch.column(1)):
            ids, sizes = set_ids(grams, bounds), np.diff(bounds)
            spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            sketches = [pa.array([sketch(grams[a:b], room) if b > a else None for a, b in spans], pa.binary()) for room in (1, 8)]
            own = [batch.column(i).slice(low, len(ids)) for i in (0, 2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sizes), pa.array(ids), *sketches], ["doc_id", "tie", "n", "set", "sketch", "wide"])
    give_back()


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, grams, bounds in shingle_sets(batch.column(0)):
            chosen = np.repeat(set_ids(grams, bounds) % _SAMPLE == 0, np.diff(bounds))
            yield pa.RecordBatch.from_arrays([pa.array(grams[chosen].astype(np.int64))], ["token"])
    give_back()


def _postings(frequent, groups: int):
    """Rows (group, postings) of the first quarter of each set; groups below 0 hold frequent
    shingles, spread over tasks as they come."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.sort(frequent.value)
        part = TaskContext.get().partitionId()
        done: set[int] = set()
        for batch in batches:
            for _, grams, bounds in shingle_sets(batch.column(0)):
                ids, sizes = set_ids(grams, bounds), np.diff(bounds)
                row = np.repeat(np.arange(len(ids)), sizes)
                common = np.zeros(len(grams), bool)
                if len(last):
                    at = np.minimum(np.searchsorted(last, grams), len(last) - 1)
                    common = last[at] == grams
                # frequent shingles behind the others of their row
                by = np.argsort(row * 2 + common, kind="stable")
                place = np.arange(len(grams)) - bounds[:-1][row]
                first = np.array([i for i, s in enumerate(ids.tolist()) if s and s not in done and not done.add(s)], np.int64)
                if len(done) > 1_000_000:
                    done.clear()
                take = np.zeros(len(ids), np.int64)
                take[first] = sizes[first] - (-(-3 * sizes[first] // 4)) + 1
                kept = place < take[row]
                out = np.empty(int(kept.sum()), _POSTING)
                out["token"], out["set"] = grams[by][kept], ids[row[kept]]
                out["n"], out["at"] = sizes[row[kept]], place[kept]
                group = (out["token"] % np.uint64(groups)).astype(np.int64)
                group[common[by][kept]] = -1 - part % groups
                by = np.argsort(group, kind="stable")
                out, group = out[by], group[by]
                head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else []
                parts = [p.tobytes() for p in np.split(out, head[1:])] if len(group) else []
                yield pa.RecordBatch.from_arrays([pa.array(group[head] if len(group) else [], pa.int64()), pa.array(parts, pa.binary())], ["group", "postings"])
        give_back()

    return emit


def _allowed(a, b, at_a, at_b):
    """Whether sizes and positions in the common order allow a link."""
    t = needed(a, b)
    return (np.minimum(np.minimum(at_a, at_b) + 1 + np.minimum(a - at_a, b - at_b) - 1, np.minimum(a, b)) >= t)


def list_pairs(postings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the short lists as rows (set, set, size, size), and postings of longer lists."""
    postings = postings[np.lexsort((postings["set"], postings["token"]))]
    fresh = np.ones(len(postings), bool)
    fresh[1:] = (postings["token"][1:] != postings["token"][:-1]) | (postings["set"][1:] != postings["set"][:-1])
    postings = postings[fresh]
    head = np.flatnonzero(np.concatenate(([True], postings["token"][1:] != postings["token"][:-1]))) if len(postings) else np.zeros(0, np.int64)
    length = np.diff(np.append(head, len(postings)))
    left_all, right_all = [], []
    index = np.arange(len(postings))
    to_end = np.repeat(head + length, length) - index
    short = np.repeat(length <= SHORT, length)
    for shift in range(1, SHORT):
        left = index[short & (to_end > shift)]
        if not len(left):
            break
        x, y = postings[left], postings[left + shift]
        ok = _allowed(x["n"].astype(np.int64), y["n"].astype(np.int64), x["at"].astype(np.int64), y["at"].astype(np.int64))
        left_all.append(left[ok])
        right_all.append(left[ok] + shift)
    left, right = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left_all, right_all))
    pairs = np.stack([postings["set"][left], postings["set"][right], postings["n"][left], postings["n"][right]], 1)
    return (np.unique(pairs, axis=0) if len(pairs) else pairs), postings[~short]


def _rows(token, left, right, a, b, at) -> pa.Table:
    columns = [pa.array(np.asarray(c, np.int64)) for c in (left, a, at)]
    empty = pa.nulls(len(columns[0]), pa.int64())
    token, right, b = (empty if c is None else pa.array(np.asarray(c).astype(np.int64)) for c in (token, right, b))
    return pa.table([token, columns[0], right, columns[1], b, columns[2]], ["token", "x", "y", "nx", "ny", "at"])


def _joined(table: pa.Table) -> pa.Table:
    postings = np.concatenate([np.frombuffer(p.as_buffer(), _POSTING) for p in table["postings"]])
    if table["group"][0].as_py() < 0:
        return _rows(postings["token"], postings["set"], None, postings["n"], None, postings["at"])
    pairs, rest = list_pairs(postings)
    found = _rows(None, pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3], np.zeros(len(pairs)))
    found = pa.concat_tables([found, _rows(rest["token"], rest["set"], None, rest["n"], None, rest["at"])])
    del postings, pairs, rest
    give_back()
    return found


class _Links:
    """Tests pairs of sets; texts are read again only for sets that a sketch lets through."""

    def __init__(self, docs: DataFrame, described: DataFrame):
        self.docs = docs
        self.sets = materialize(
            described.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide")),
            "sets",
        )

    def among(self, pairs: DataFrame) -> DataFrame:
        """Linked pairs (u, v) of `pairs` (x, y)."""

        @arrow_udf("boolean")
        def sketched(x: pa.Array, y: pa.Array, nx: pa.Array, ny: pa.Array) -> pa.Array:
            rows = zip(x.to_pylist(), y.to_pylist(), nx.to_pylist(), ny.to_pylist())
            return pa.array([may_link(*r) for r in rows], pa.bool_())

        def side(name):
            return self.sets.select(F.col("set").alias(name), F.col("n").alias(f"n{name}"), F.col("sketch").alias(f"s{name}"))

        pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        near = pairs.join(side("x"), "x").join(side("y"), "y")
        near = materialize(near.where(sketched("sx", "sy", "nx", "ny")).select("x", "y"), "near")
        if near.isEmpty():
            return near.select(F.col("x").alias("u"), F.col("y").alias("v"))

        wanted = near.select(F.col("x").alias("set")).union(near.select("y")).distinct()
        ids = materialize(self.sets.join(wanted, "set").select("doc_id").distinct(), "near-ids")
        if ids.count() <= SMALL_IDS:
            ids = F.broadcast(ids)

        def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, grams, bounds in shingle_sets(batch.column(0)):
                    raw = [grams[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(set_ids(grams, bounds)), pa.array(raw, pa.binary())], ["set", "grams"])
            give_back()

        rows = self.docs.select("doc_id", "text").join(ids, ids["doc_id"].eqNullSafe(self.docs["doc_id"]), "left_semi")
        grams = rows.select("text").mapInArrow(full, "set long, grams binary")
        # repeated doc_ids can give a set twice, or sets that nobody asked for
        grams = grams.join(wanted, "set").groupBy("set").agg(F.first("grams").alias("grams"))
        grams = materialize(grams, "grams")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (batch.column(i).to_numpy() for i in (0, 1))
                head = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else []
                for low, high in zip(head, [*head[1:], len(x)]):
                    query = np.frombuffer(batch.column(2)[int(low)].as_buffer(), np.uint64)
                    candidates = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column(3).slice(low, high - low)]
                    linked = divide_skip(query, candidates)
                    yield pa.RecordBatch.from_arrays([pa.array(x[low:high][linked]), pa.array(y[low:high][linked])], ["u", "v"])
            give_back()

        def with_grams(frame, name):
            return frame.join(grams.select(F.col("set").alias(name), F.col("grams").alias(f"g{name}")), name)

        full_pairs = with_grams(with_grams(near, "y"), "x").select("x", "y", "gx", "gy").sortWithinPartitions("x")
        return materialize(full_pairs.mapInArrow(search, "u long, v long"), "links")


def _leader_pairs(postings: DataFrame, salt: int) -> DataFrame:
    """Each set of a list with `LEADERS` random sets of that list in other components.

    The leaders of a list stay one array, so the join gives a row per posting; only pairs that
    sizes and places allow become rows."""
    first = [F.min_by(F.struct("x", "nx", "at", "root"), F.xxhash64("x", F.lit(salt * LEADERS + j))).alias(f"l{j}") for j in range(LEADERS)]
    leaders = postings.groupBy("token").agg(*first).select("token", F.array_distinct(F.array(*[f"l{j}" for j in range(LEADERS)])).alias("leaders"))

    def apart_and_possible(l: Column) -> Column:
        a, b, p, q = F.col("nx"), l["nx"], F.col("at"), l["at"]
        reach = F.least(F.least(p, q) + F.least(a - p, b - q), a, b)
        return (l["x"] != F.col("x")) & (l["root"] != F.col("root")) & (7 * reach >= 3 * (a + b))

    met = postings.join(leaders, "token").select("x", F.explode(F.filter("leaders", apart_and_possible)).alias("l"))
    return met.select(F.least("x", "l.x").alias("x"), F.greatest("x", "l.x").alias("y")).distinct()


_CHUNK = 512


def _sketch_matrix(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of at least `width` bytes as rows, the wider ones folded to it."""
    rows = np.empty((len(sketches), width), np.uint8)
    for i, raw in enumerate(sketches):
        rows[i] = np.bitwise_xor.reduce(np.frombuffer(raw, np.uint8).reshape(-1, width), 0)
    return rows.view(np.uint64)


def near_pairs(left: np.ndarray, right: np.ndarray, x, root, n, at, sketches: list[bytes]) -> np.ndarray:
    """Pairs of these rows in different components that sizes, places and sketches allow."""
    found = [np.zeros((0, 2), np.int64)]
    widths = np.array([len(s) for s in sketches])
    # linked sets differ by a third at most, so their sketches by a factor of two
    for a in np.unique(widths[left]):
        for b in (a // 2, a, 2 * a):
            own, others = left[widths[left] == a], right[widths[right] == b]
            if not len(own) or not len(others):
                continue
            width = int(min(a, b))
            ours = _sketch_matrix([sketches[i] for i in own], width)
            theirs = _sketch_matrix([sketches[i] for i in others], width)
            for i, mine in zip(own.tolist(), ours):
                ok = np.flatnonzero((root[others] != root[i]) & (x[others] != x[i]) & _allowed(n[i], n[others], at[i], at[others]))
                j = others[ok]
                apart = np.bitwise_count(theirs[ok] ^ mine).sum(1)
                j = j[apart <= n[i] + n[j] - 2 * needed(n[i], n[j])]
                found.append(np.stack([np.minimum(x[i], x[j]), np.maximum(x[i], x[j])], 1))
    return np.unique(np.concatenate(found), axis=0)


def _all_pairs(postings: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of a list that lie in different components and may link, by pairs of chunks
    of the list."""
    counts = postings.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / _CHUNK).cast("int").alias("chunks"))
    rows = postings.join(counts, "token").withColumn("own", F.pmod(F.xxhash64("x"), F.col("chunks")).cast("int"))
    rows = rows.join(sets.select(F.col("set").alias("x"), F.col("wide").alias("sketch")), "x")
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = spread.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    cells = cells.select("token", "low", "high", "own", "x", "root", "nx", "at", "sketch")

    def meet(table: pa.Table) -> pa.Table:
        own, x, root, n, at = (table[c].to_numpy() for c in ("own", "x", "root", "nx", "at"))
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        found = near_pairs(left, right, x, root, n, at, table["sketch"].to_pylist())
        return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], ["x", "y"])

    return cells.groupBy("token", "low", "high").applyInArrow(meet, "x long, y long").distinct()


def _placed(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, hash of its text, shingle count, set and root set."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    tied = docs.withColumn("tie", F.xxhash64("text"))
    described = materialize(tied.mapInArrow(_described, f"doc_id {kind}, tie long, n long, set long, sketch binary, wide binary"), "described")
    sampled = docs.select("text").mapInArrow(_sampled, "token long").groupBy("token").count().where("count >= 3")
    frequent = sampled.orderBy(F.desc("count"), "token").limit(FREQUENT).select("token").toArrow()["token"].to_numpy()
    shared = spark.sparkContext.broadcast(frequent.astype(np.uint64))
    total = described.agg(F.sum("n")).first()[0] or 0
    groups = max(spark.sparkContext.defaultParallelism, -(-total // (4 * _PER_GROUP)))

    schema = "token long, x long, y long, nx long, ny long, at long"
    blobs = docs.select("text").mapInArrow(_postings(shared, groups), "group long, postings binary")
    rows = materialize(blobs.groupBy("group").applyInArrow(_joined, schema), "lists")
    links = _Links(docs, described)
    edges = links.among(rows.where("y is not null").select("x", "y"))
    lists = rows.where("y is null").select("token", "x", "nx", "at").distinct()
    lists = materialize(lists.join(lists.groupBy("token").count().where("count > 1").select("token"), "token"), "long-lists")
    roots = components(edges)
    for salt in (1, 2, None):
        known = lists.join(roots.select(F.col("node").alias("x"), "root"), "x", "left").withColumn("root", F.coalesce("root", "x"))
        several = known.groupBy("token").agg((F.min("root") < F.max("root")).alias("several")).where("several").select("token")
        lists = materialize(known.join(several, "token").select("token", "x", "nx", "at", "root"), "open-lists")
        if lists.isEmpty():
            break
        found = links.among(_leader_pairs(lists, salt) if salt else _all_pairs(lists, links.sets))
        lists = lists.drop("root")
        if not found.isEmpty():
            roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found))

    roots = roots.withColumnRenamed("node", "set")
    return described.drop("sketch", "wide").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text)."""
    placed = _placed(docs)
    smallest = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    own = placed.join(smallest, "root", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay when each component keeps one, that with the smallest
    doc_id (null last, then by hash of the text). Rows with an empty set all stay."""
    placed = materialize(_placed(docs).select("doc_id", "tie", "n", "root"), "placed").where("n > 0")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    first = placed.groupBy("root").agg(F.min(row).alias("first"))
    first = first.select("root", F.col("first.doc_id").alias("one"), F.col("first.tie").alias("one_tie"))
    gone = placed.join(first, "root").where(~(F.col("doc_id").eqNullSafe(F.col("one")) & (F.col("tie") == F.col("one_tie"))))
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("tie").alias("_gone_tie")).distinct()
    keyed = docs.withColumn("_tie", F.xxhash64("text"))
    kept = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["_gone"]) & (keyed["_tie"] == gone["_gone_tie"]), "left_anti")
    again = placed.groupBy("doc_id", "tie").count().where("count > 1")
    if again.isEmpty():
        return kept.drop("_tie")
    # rows that repeat doc_id and text: one stays
    again = again.select(F.col("doc_id").alias("_again"), F.col("tie").alias("_again_tie"))
    matching = kept["doc_id"].eqNullSafe(again["_again"]) & (kept["_tie"] == again["_again_tie"])
    once = kept.join(again, matching, "left_semi").dropDuplicates(["doc_id", "_tie"])
    return kept.join(again, matching, "left_anti").unionByName(once).drop("_tie")

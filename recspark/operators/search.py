"""Exact and cluster-pruned vector top-k.

Both sides are cut into blocks of bounded size. A cell is one query block against one
item block of the same cluster: a matrix product in one task that returns at most k rows
per query, so the scored pairs never leave the task. A large cluster simply has more
blocks, so its size does not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..storage import materialize

BLOCK = 65_536  # vectors of one side in one cell
SMALL_BLOCK = 1_024  # not worth splitting further
STRIP = 64  # queries scored at a time inside a cell
CODED_STRIP = 128  # the same for codes, whose first scores are single floats
CODED_GROUP = 32  # items of a list of codes whose best first score stands for them
TILE = 2_048  # items whose first scores are made at a time
CELLS_PER_CORE = 16  # of lists of codes, so that cells of unlike size fill the cores
MAX_LISTS = 65_536  # centroids are sent to all tasks, so their number is bounded
_GROUP = 64  # columns whose best score stands for them
_PLACES = 9  # scores equal to this many decimals are ties, broken by item id

Scores = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _inner(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return q @ v.T


def _minus_l2(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    scores = q @ v.T
    scores *= 2
    scores -= (v * v).sum(1)
    scores -= (q * q).sum(1)[:, None]
    return np.minimum(scores, 0.0, out=scores)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best rounded scores of each row, ties by column.

    The k-th best of the maxima of groups of columns bounds the k-th best score from
    below, so few scores are left to be ranked.
    """
    rows, columns = scores.shape
    whole = columns // _GROUP
    if whole >= k:
        bounds = scores[:, : whole * _GROUP].reshape(rows, whole, _GROUP).max(axis=2)
    else:
        bounds = scores
    best = min(k, columns)
    least = np.partition(bounds, bounds.shape[1] - best, axis=1)[:, bounds.shape[1] - best, None]
    row, column = np.nonzero(scores >= least - 10.0**-_PLACES)
    order = np.lexsort((column, -np.round(scores[row, column], _PLACES), row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row] < k
    return row[kept], column[kept]


def _stacked(side: pd.DataFrame, name: str, unit: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one side; with `unit` normalised and without zero vectors."""
    ids = side[f"{name}_id"].to_numpy()
    vectors = np.stack(side[f"{name}_vec"].to_numpy()).astype(np.float64)
    if unit:
        norms = np.sqrt((vectors * vectors).sum(1))
        ids, vectors = ids[norms > 0], vectors[norms > 0] / norms[norms > 0, None]
    return ids, vectors


def _cell(k: int, scores_of: Scores, sign: float, unit: bool = False):
    def run(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(queries) and len(items):
            # ties go to the least id
            ids, v = _stacked(items.sort_values("item_id"), "item", unit)
            names, q = _stacked(queries, "query", unit)
            for start in range(0, len(q) if len(v) else 0, STRIP):
                scores = scores_of(q[start : start + STRIP], v)
                row, column = _best(scores, k)
                parts.append((names[start + row], ids[column], sign * scores[row, column]))
        columns = ("query_id", "item_id", "score")
        if not parts:
            return pd.DataFrame({c: [] for c in columns})
        return pd.DataFrame({c: np.concatenate(p) for c, p in zip(columns, zip(*parts))})

    return run


def _cells(q: DataFrame, v: DataFrame, query_extra: tuple[str, ...] = (), item_extra: tuple[str, ...] = ()):
    """Both sides grouped by cell, each repeated for the blocks of the other side.

    Both have the columns `cluster`, `query_blocks` and `item_blocks`; extra columns go along.
    """
    place = ["cluster", "query_block", "item_block"]

    def grouped(side: DataFrame, own: str, other: str, extra: tuple[str, ...]):
        number = F.pmod(F.xxhash64(f"{own}_id"), F.col(f"{own}_blocks")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        cells = side.withColumn(f"{own}_block", number).withColumn(f"{other}_block", every)
        return cells.select(*place, f"{own}_id", f"{own}_vec", *extra).groupBy(*place)

    return grouped(q, "query", "item", query_extra), grouped(v, "item", "query", item_extra)


def _with_block_counts(
    pairs: DataFrame, q: DataFrame, v: DataFrame, block: int, query_block: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Route the queries to the lists of `pairs`, and add the blocks of each list to both sides.

    Only the written pairs are counted; a query's vector meets them in the join before the
    cells. At most MAX_LISTS rows are broadcast.
    """

    def blocks(side: DataFrame, name: str, block: int) -> DataFrame:
        number = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int")
        return side.groupBy("cluster").agg(number.alias(f"{name}_blocks"))

    # only the probed lists are read, as whole folders; there are at most MAX_LISTS of them
    v = v.join(F.broadcast(pairs.select("cluster").distinct()), "cluster", "left_semi")
    sizes = F.broadcast(blocks(pairs, "query", query_block or block).join(blocks(v, "item", block), "cluster"))
    return q.join(pairs, "query_id").join(sizes, "cluster"), v.join(sizes, "cluster")


def _ranked(scored: DataFrame, k: int, ascending: bool) -> DataFrame:
    rounded = F.round("score", _PLACES)
    order = rounded if ascending else rounded.desc()
    best = Window.partitionBy("query_id").orderBy(order, "item_id")
    ranked = scored.withColumn("place", F.row_number().over(best))
    return ranked.where(F.col("place") <= k)


def _side(df: DataFrame, name: str, key: str, vec: str) -> DataFrame:
    chosen = df.select(F.col(key).alias(f"{name}_id"), F.col(vec).alias(f"{name}_vec"))
    return chosen.where(F.col(f"{name}_vec").isNotNull())


def _out_schema(queries: DataFrame, items: DataFrame) -> str:
    query = queries.schema["query_id"].dataType.simpleString()
    item = items.schema["item_id"].dataType.simpleString()
    return f"query_id {query}, item_id {item}, score double"


def exact_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "cosine",
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    item_id: str = "item_id",
    item_vec: str = "item_vec",
    block: int = BLOCK,
) -> DataFrame:
    """`(query_id, item_id, score, place)`: the k best items of every query.

    `metric` is `cosine` (both sides normalised, zero vectors match nothing), `inner`
    or `l2` (squared distance, ascending). With fewer than k items fewer rows come back.
    """
    q = _side(queries, "query", query_id, query_vec)
    v = _side(items, "item", item_id, item_vec)
    # counts of whole tables come from the file footers
    rows, others = queries.count(), items.count()
    query_blocks, item_blocks = max(1, -(-rows // block)), max(1, -(-others // block))
    # smaller blocks keep all cores busy; split the side that repeats fewer vectors
    cells = 4 * queries.sparkSession.sparkContext.defaultParallelism
    while query_blocks * item_blocks < cells and rows > 2 * SMALL_BLOCK * query_blocks:
        if others * query_blocks <= rows * item_blocks or others < 2 * SMALL_BLOCK * item_blocks:
            query_blocks *= 2
        else:
            item_blocks *= 2
    blocks = [
        F.lit(0).alias("cluster"),
        F.lit(query_blocks).alias("query_blocks"),
        F.lit(item_blocks).alias("item_blocks"),
    ]
    return _search(q.select("*", *blocks), v.select("*", *blocks), k, metric)


def _search(q: DataFrame, v: DataFrame, k: int, metric: str) -> DataFrame:
    left, right = _cells(q, v)
    l2 = metric == "l2"
    cell = _cell(k, _minus_l2 if l2 else _inner, -1.0 if l2 else 1.0, metric == "cosine")
    scored = left.cogroup(right).applyInPandas(cell, _out_schema(q, v))
    return _ranked(scored, k, ascending=l2)


def single_query_topk(
    items: DataFrame, score: Column, k: int, item_id: str = "item_id"
) -> DataFrame:
    """The k best items for one query, whose score is an expression: a distributed top-k."""
    scored = items.select(F.col(item_id).alias("item_id"), score.alias("score"))
    return scored.orderBy(F.round("score", _PLACES).desc(), "item_id").limit(k)


def centroids_of(df: DataFrame, vec: str, groups: int, seed: int = 42, rounds: int = 10) -> DataFrame:
    """`(cluster, centroid)` trained by k-means on all vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = df.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = KMeans(k=groups, seed=seed, maxIter=rounds).fit(features)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, centroid array<double>")


def _matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = centroids.select("cluster", "centroid").orderBy("cluster").limit(MAX_LISTS + 1).collect()
    if len(rows) > MAX_LISTS:
        raise ValueError(f"at most {MAX_LISTS} clusters")
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)


def _near(df: DataFrame, vec: str, centroids: DataFrame, probes: int) -> Column:
    """The `probes` nearest clusters of a vector and their squared distances, nearest first."""
    names, matrix = _matrix(centroids)
    shared = df.sparkSession.sparkContext.broadcast((names, matrix))

    @arrow_udf("array<struct<cluster:int,distance:double>>")
    def clusters(vectors: pa.Array) -> pa.Array:
        labels, centres = shared.value
        found, distances = [], []
        for start in range(0, len(vectors), STRIP):
            part = _rows_of(vectors[start : start + STRIP])
            scores = _minus_l2(part, centres)
            nearest = np.argsort(-np.round(scores, _PLACES), axis=1, kind="stable")[:, :probes]
            found.append(labels[nearest].ravel())
            distances.append(-np.take_along_axis(scores, nearest, axis=1).ravel())
        width = min(probes, len(labels))
        columns = [pa.array(np.concatenate([*c, np.zeros(0)]), t) for c, t in ((found, pa.int32()), (distances, pa.float64()))]
        entries = pa.StructArray.from_arrays(columns, ["cluster", "distance"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * width, pa.int32()), entries)

    return clusters(F.col(vec))


def _rows_of(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def nearest_clusters(df: DataFrame, vec: str, centroids: DataFrame, probes: int) -> Column:
    """The `probes` nearest clusters of a vector, nearest first, ties by cluster id."""
    return F.transform(_near(df, vec, centroids, probes), lambda n: n["cluster"])


def build_lists(items: DataFrame, item_id: str, item_vec: str, centroids: DataFrame) -> DataFrame:
    """`(item_id, item_vec, cluster)`: every item in the list of its nearest centroid.

    Written with one folder per cluster, so a search reads the probed lists only.
    """
    v = items.select(
        F.col(item_id).alias("item_id"), F.col(item_vec).cast("array<double>").alias("item_vec")
    )
    v = v.where("item_vec IS NOT NULL")
    nearest = F.get(nearest_clusters(v, "item_vec", centroids, 1), 0)
    return materialize(v.withColumn("cluster", nearest), "lists", partition_by=["cluster"])


def probe(queries: DataFrame, query_id: str, query_vec: str, centroids: DataFrame, probes: int) -> DataFrame:
    """`(query_id, cluster, distance)`: one row per query and probed cluster, without vectors.

    Written, because the pairs are counted and then searched. Query ids are unique.
    """
    q = _side(queries, "query", query_id, query_vec)
    near = _near(q, "query_vec", centroids, probes)
    return materialize(q.select("query_id", F.inline(near)), "probes")


def list_topk(
    queries: DataFrame,
    lists: DataFrame,
    centroids: DataFrame,
    k: int,
    probes: int = 10,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    block: int = BLOCK,
) -> DataFrame:
    """Squared-distance top-k among the items of the probed lists; all lists give exact search."""
    pairs = probe(queries, query_id, query_vec, centroids, probes)
    q = _side(queries, "query", query_id, query_vec)
    return _search(*_with_block_counts(pairs, q, lists, block), k, "l2")


def split_vector(vec: Column, parts: int, size: int) -> list[Column]:
    """`parts` equal slices of a vector of `size` numbers."""
    width = size // parts
    return [F.slice(vec, i * width + 1, width) for i in range(parts)]


def train_codebooks(
    lists: DataFrame, parts: int, size: int, codes: int, centroids: DataFrame | None = None, seed: int = 42
) -> DataFrame:
    """`(part, code, word)`: k-means words for each slice of the (residual) vectors."""
    source = _residuals(lists, centroids) if centroids is not None else lists
    # written once as single floats, a column per part, so each training reads its own slice
    pieces = [p.cast("array<float>").alias(f"part{i}") for i, p in enumerate(split_vector(F.col("item_vec"), parts, size))]
    source = materialize(source.select(*pieces), "slices")

    def train(part: int) -> DataFrame:
        words = centroids_of(source, f"part{part}", codes, seed)
        number = F.lit(part).alias("part")
        return words.select(number, F.col("cluster").alias("code"), F.col("centroid").alias("word"))

    # the parts are independent, so their jobs may share the cluster
    with ThreadPoolExecutor(parts) as pool:
        return reduce(DataFrame.unionAll, pool.map(train, range(parts)))


def _residuals(lists: DataFrame, centroids: DataFrame) -> DataFrame:
    joined = lists.join(F.broadcast(centroids), "cluster")  # at most MAX_LISTS rows
    residual = F.zip_with("item_vec", "centroid", lambda x, c: x - c)
    return joined.select("item_id", residual.alias("item_vec"), "cluster")


def _books(codebooks: DataFrame) -> np.ndarray:
    """Words as an array [part, code, width]; parts x codes rows by construction."""
    rows = codebooks.orderBy("part", "code").select("part", "word").collect()
    parts = max(r.part for r in rows) + 1
    return np.array([r.word for r in rows], dtype=np.float64).reshape(parts, len(rows) // parts, -1)


def quantise(lists: DataFrame, codebooks: DataFrame, centroids: DataFrame | None = None) -> DataFrame:
    """`(item_id, codes, own, cluster)`: the nearest word w of each slice of a vector or, with
    `centroids`, of its difference from its centroid c; ties by code.

    `own` is the part of a squared distance that no query changes: |w|^2, plus 2 c w with `centroids`.
    """
    joined = lists.join(F.broadcast(centroids), "cluster") if centroids is not None else lists  # at most MAX_LISTS rows
    shared = lists.sparkSession.sparkContext.broadcast(_books(codebooks))

    def coded(v: np.ndarray, centre: np.ndarray | float) -> pa.Array:
        books = shared.value
        pieces = (v - centre).reshape(len(v), books.shape[0], -1)
        best = [np.argmax(np.round(_minus_l2(pieces[:, p], books[p]), _PLACES), axis=1) for p in range(books.shape[0])]
        words = np.concatenate([books[p][b] for p, b in enumerate(best)], axis=1)
        own = (words * words).sum(1) + 2 * (words * centre).sum(1)
        offsets = pa.array(np.arange(len(v) + 1) * books.shape[0], pa.int32())
        codes = pa.ListArray.from_arrays(offsets, pa.array(np.stack(best, axis=1).ravel(), pa.int32()))
        return pa.StructArray.from_arrays([codes, pa.array(own)], ["codes", "own"])

    kind = "struct<codes:array<int>,own:double>"
    if centroids is None:

        @arrow_udf(kind)
        def described(vectors: pa.Array) -> pa.Array:
            return coded(_rows_of(vectors), 0.0)

        found = described("item_vec")
    else:

        @arrow_udf(kind)
        def described(vectors: pa.Array, centres: pa.Array) -> pa.Array:
            return coded(_rows_of(vectors), _rows_of(centres))

        found = described("item_vec", "centroid")
    return joined.select("item_id", found.alias("_c"), "cluster").select("item_id", "_c.codes", "_c.own", "cluster")


def _least_of_each(codes: np.ndarray, k: int) -> np.ndarray:
    """Rows, in order, without those after the k first of the same codes, which equal scores cannot place."""
    order = np.lexsort(codes.T[::-1])
    laid = codes[order]
    new = np.r_[True, (laid[1:] != laid[:-1]).any(axis=1)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(laid)), 0))
    return np.sort(order[np.arange(len(laid)) - first < k])


def _bounds(q: np.ndarray, words: np.ndarray, tile: np.ndarray, bounds: np.ndarray) -> None:
    """The best product of each query with each group of words, tile by tile, so that no score leaves the cache.

    Word g + i * (TILE / CODED_GROUP) of a tile is in its group g.
    """
    width = TILE // CODED_GROUP
    for number, start in enumerate(range(0, len(words), TILE)):
        scores = np.matmul(q, words[start : start + TILE].T, out=tile[: len(q)])
        layers = scores.reshape(len(q), CODED_GROUP, width)
        np.max(layers, axis=1, out=bounds[: len(q), number * width : (number + 1) * width])


def _coded_cell(k: int, shared, residual: bool):
    """A matrix product of single floats finds the few groups of items that may hold one of the
    best; the distances of these items come from their codes."""

    def run(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        books = shared.value
        parts = []
        if len(queries) and len(items):
            items = items.sort_values("item_id")  # ties go to the least id
            codes = np.stack(items["item_vec"].to_numpy()).astype(np.int64)
            kept = _least_of_each(codes, k)
            ids, own, codes = items["item_id"].to_numpy()[kept], items["own"].to_numpy()[kept], codes[kept]
            size = books.shape[0] * books.shape[2]
            # the last number of a word takes off its own part; words that fill the last tile lose to all
            words = np.zeros((-(-len(kept) // TILE) * TILE, size + 1), np.float32)
            words[:, size] = -np.inf
            words[: len(kept), :size] = np.concatenate([books[p][codes[:, p]] for p in range(books.shape[0])], axis=1)
            words[: len(kept), size] = -own
            longest = np.sqrt((words[: len(kept)].astype(np.float64) ** 2).sum(1).max())
            tile, bounds = np.empty((CODED_STRIP, TILE), np.float32), np.empty((CODED_STRIP, len(words) // CODED_GROUP), np.float32)
            shifts = np.arange(CODED_GROUP) * (TILE // CODED_GROUP)
        for start in range(0, len(queries) if len(items) else 0, CODED_STRIP):
            some = queries.iloc[start : start + CODED_STRIP]
            q = np.stack(some["query_vec"].to_numpy()).astype(np.float64)
            norms = (q * q).sum(1)
            _bounds(np.c_[2 * q, np.ones(len(q))].astype(np.float32), words, tile, bounds)
            found = bounds[: len(q)]
            at = found.shape[1] - k
            least = np.partition(found, at, axis=1)[:, at].astype(np.float64) if at >= 0 else np.full(len(q), -np.inf)
            # a product of so many single floats may be off by half of this, a tie by the rest
            least -= (size + 4) * 2.0**-22 * np.sqrt(4 * norms + 1) * longest + 2 * 10.0**-_PLACES
            row, group = np.nonzero(found >= least[:, None])
            width = TILE // CODED_GROUP
            column = (group // width * TILE + group % width)[:, None] + shifts
            row, column = np.repeat(row, CODED_GROUP), column.ravel()
            row, column = row[column < len(kept)], column[column < len(kept)]
            # products of each query's slices with all words; no list changes them
            products = np.einsum("qpw,pcw->pqc", q.reshape(len(q), books.shape[0], -1), books)
            base = some["distance"].to_numpy() if residual else norms
            scores = -(base[row] + own[column])
            for part, table in enumerate(products):
                scores += 2 * table[row, codes[column, part]]
            scores = np.minimum(scores, 0.0)
            order = np.lexsort((column, -np.round(scores, _PLACES), row))
            row, column, scores = row[order], column[order], scores[order]
            best = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row] < k
            parts.append((some["query_id"].to_numpy()[row[best]], ids[column[best]], -scores[best]))
        columns = ("query_id", "item_id", "score")
        if not parts:
            return pd.DataFrame({c: [] for c in columns})
        return pd.DataFrame({c: np.concatenate(p) for c, p in zip(columns, zip(*parts))})

    return run


def quantised_topk(
    queries: DataFrame,
    coded: DataFrame,
    codebooks: DataFrame,
    centroids: DataFrame,
    k: int,
    probes: int = 10,
    residual: bool = False,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    block: int = BLOCK,
) -> DataFrame:
    """Approximate squared-distance top-k from codes.

    A distance falls into the query's to the centroid (known from probing), the item's own part
    and products of the query's slices with words, which are the same for all its lists. So
    neither queries nor words are shifted for each list of residual codes. Scored pairs grow with
    queries x items x probes / lists.
    """
    pairs = probe(queries, query_id, query_vec, centroids, probes)
    shared = queries.sparkSession.sparkContext.broadcast(_books(codebooks))
    q = _side(queries, "query", query_id, query_vec)
    # codes are short, so a list may be repeated for more blocks of queries; the pairs are written
    share = pairs.count() // (CELLS_PER_CORE * queries.sparkSession.sparkContext.defaultParallelism)
    some = min(block, max(SMALL_BLOCK, share))
    q, v = _with_block_counts(pairs, q, coded.withColumnRenamed("codes", "item_vec"), block, some)
    left, right = _cells(q, v, ("distance",), ("own",))
    scored = left.cogroup(right).applyInPandas(_coded_cell(k, shared, residual), _out_schema(q, v))
    return _ranked(scored, k, ascending=True)


def packed(ranked: DataFrame, decimals: int = 4) -> DataFrame:
    """`(query_id, items)`: the ranked items of each query as one list of (item_id, score)."""
    entry = F.struct("place", "item_id", F.round("score", decimals).alias("score"))
    entries = F.array_sort(F.collect_list(entry))
    items = F.transform(entries, lambda e: F.struct(e["item_id"].alias("item_id"), e["score"].alias("score")))
    return ranked.groupBy("query_id").agg(items.alias("items"))


def unpacked(lists: DataFrame, user: str, items: str) -> DataFrame:
    """One row per entry of a packed list."""
    return lists.select(user, F.inline(items))


def truth_table(test: DataFrame, user: str, item: str) -> DataFrame:
    """`(user, items)`: the held-out items of each user; the split holds out one."""
    return test.groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("items"))

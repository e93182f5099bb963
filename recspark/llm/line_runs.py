"""Line dedup by a suffix array over line-id sequences, built by distributed prefix doubling.

Lines get ids (the ranks of distinct repeated lines); each round pairs the rank of a place
with the rank `h` lines further on, sorts the distinct pairs and numbers them, which doubles
the depth of the order. Places whose group is down to one member leave the rounds: their
suffix is sorted and their line run is unique. A group at depth d is an interval of the
suffix array with a common prefix of at least d lines.

A repeated run qualifies with `min_lines` lines, or with `min_words` words in fewer. Every
copy but the first (in order of doc_id, then row hash, then line) loses the run's lines. As
any longer repeat is a union of windows of `min_lines` lines, the intervals at that depth
and at the powers of two below it are enough, and runs that touch merge into maximal ones.

Groups are reduced to one row (count, first place) before the shuffle, and the ranks go back
to the places by a join that splits hot keys, so a line that a third of the rows hold never
meets in one task. Only hashes of lines are sorted; texts move once, for the rewrite.

Defined cases: lines are separated by line feeds and compared exactly, by 96-bit hashes;
blank lines belong to no run and stay; a null or empty text is left as it is; rows that
repeat doc_id and text are judged as one document and all keep its result; a null doc_id
comes first; extra columns are kept, and the new columns replace columns of their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import global_rank
from ..operators.skew import attach
from ..storage import materialize

MIN_LINES = 3
MIN_WORDS = 8
_KEY = ["_k1", "_k2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """A 128-bit key of doc_id and text."""
    return docs.withColumns({"_k1": F.xxhash64("doc_id", "text"), "_k2": F.xxhash64("text", F.lit(1), "doc_id")})


def _lines() -> Column:
    """Lines with words: number, two hashes, words."""
    every = F.transform(
        F.split("text", "\n", -1),
        lambda line, n: F.struct(
            n.alias("line"), F.xxhash64(line).alias("a"), F.hash(line).alias("b"), F.regexp_count(line, F.lit(r"\S+")).alias("words")
        ),
    )
    return F.filter(every, lambda line: line["words"] > 0)


def _ranked(places: DataFrame, by: list[str]) -> DataFrame:
    """Places of groups with several members, with the group's rank and first place.

    The rank is the place of the group in the order of `by`: with ids this starts the
    doubling, with pairs of ranks it is one round of it.
    """
    groups = places.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", *_KEY, "i")).alias("_first"))
    ranks = materialize(global_rank(groups.where("n > 1"), by, "rank"), "line-ranks")
    kept = attach(places, ranks, by, "n", "inner")
    place = F.struct("doc_id", *_KEY, "i")
    later = ~place.eqNullSafe(F.col("_first"))
    columns = ["doc_id", *_KEY, "i", "line", "words", "rank"]
    return materialize(kept.withColumn("later", later).select(*columns, "later"), "line-places")


def _pairs(places: DataFrame, shift: int) -> DataFrame:
    """Each place with the rank and words `shift` lines further on in its document."""
    ahead = places.select(*_KEY, (F.col("i") - shift).alias("i"), F.col("rank").alias("r2"), F.col("words").alias("w2"))
    joined = places.withColumnRenamed("rank", "r1").join(ahead, [*_KEY, "i"])
    return joined.select("doc_id", *_KEY, "i", "line", "r1", "r2", (F.col("words") + F.col("w2")).alias("words"))


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Sequence places of lines in later copies, and the line number of each place."""
    whole = _keyed(docs.select("doc_id", "text").where("length(text) > 0")).withColumn("lines", _lines())
    # rows that repeat doc_id and text become one, before the shuffle
    once = whole.groupBy("doc_id", *_KEY).agg(F.first("lines").alias("lines"))
    exploded = once.select("doc_id", *_KEY, F.posexplode("lines").alias("i", "l"))
    sequence = materialize(exploded.select("doc_id", *_KEY, "i", "l.*"), "lines")

    found = []

    def note(places: DataFrame, depth: int, wanted: Column) -> None:
        runs = places.where(F.col("later") & wanted)
        spread = F.explode(F.sequence(F.col("i"), F.col("i") + depth - 1))
        found.append(runs.select(*_KEY, spread.alias("i")))

    depth, places = 1, _ranked(sequence, ["a", "b"])
    while depth < min_lines:
        note(places, depth, F.col("words") >= min_words)
        if 2 * depth > min_lines:
            break
        places = _ranked(_pairs(places, depth), ["r1", "r2"])
        depth *= 2
    if depth < min_lines:
        places = _ranked(_pairs(places, min_lines - depth), ["r1", "r2"])
    note(places, min_lines, F.lit(True))
    return reduce(DataFrame.unionByName, found).distinct(), sequence


def without_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the later copies of repeated runs deleted from `text`; adds n_lines (as
    given) and n_removed."""
    copies, sequence = later_copies(docs, min_lines, min_words)
    gone = copies.join(sequence.select(*_KEY, "i", "line"), [*_KEY, "i"])
    gone = gone.groupBy(*_KEY).agg(F.collect_list("line").alias("_gone"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    carried = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    carried = carried.withColumns({"doc_id": F.col(names["doc_id"]), "text": F.col(names["text"])})
    joined = _keyed(carried).join(gone, _KEY, "left")
    # array() binds the split lines once; without it each use would split the text again
    lines = F.array(F.split("text", "\n", -1))
    n_lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n", -1))).otherwise(0)

    def kept(line: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(line) - 1), F.col("_gone"))
        return F.array_join(F.transform(left, lambda i: line[i]), "\n")

    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.transform(lines, kept)[0])
    out = {c: F.col(n) for c, n in names.items()} | {"text": text}
    removed = F.coalesce(F.size("_gone"), F.lit(0))
    removed = F.when(F.col("_gone").isNull(), 0).otherwise(removed)
    return joined.select(
        *[v.alias(c) for c, v in out.items()], n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed")
    )

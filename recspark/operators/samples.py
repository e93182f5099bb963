"""Training samples: histories, leave-last-out split, negatives, profiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import pad
from ..storage import materialize
from .ordering import global_rank
from .profiling import frequent_values
from .skew import ROWS_PER_TASK, attach

FIRST_EVENTS = 100  # fixed value: the samples use the first events of each user


def first_events(
    df: DataFrame, user: str, order_by: Sequence[str], limit: int = FIRST_EVENTS
) -> DataFrame:
    """The first `limit` rows of each user, with their 0-based `place`.

    The filter is on the row number itself, which lets Spark prune to `limit` rows per
    user before the shuffle, so a hot user is harmless.
    """
    earliest = Window.partitionBy(user).orderBy(*order_by)
    ranked = df.withColumn("_n", F.row_number().over(earliest)).where(F.col("_n") <= limit)
    return ranked.withColumn("place", F.col("_n") - 1).drop("_n")


def prefix_histories(
    df: DataFrame, user: str, item: str, order_by: Sequence[str], limit: int = FIRST_EVENTS
) -> DataFrame:
    """Add `history` (items before this one, newest first), `hist_len` and `events` (of the user)."""
    events = first_events(df, user, order_by, limit)
    own = Window.partitionBy(user)
    earlier = own.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumns(
        {
            "history": F.reverse(F.collect_list(item).over(earlier)),
            "hist_len": F.col("place"),
            "events": F.count(F.lit(1)).over(own),
        }
    )


def recent_items(
    df: DataFrame, user: str, item: str, order_by: Sequence[str], length: int, keep: str = "last"
) -> DataFrame:
    """Add `items`: up to `length` items of the user before this event, oldest first.

    `keep="last"` gives those just before the event, `"first"` the user's earliest ones.
    All events count; the window holds `length` items, never a whole history.
    """
    ordered = Window.partitionBy(user).orderBy(*order_by)
    if keep == "last":
        before = ordered.rowsBetween(-length, -1)
        return df.withColumn("items", F.collect_list(item).over(before))
    opening = df.withColumn("_n", F.row_number().over(ordered))
    early = F.when(F.col("_n") <= length, F.col(item))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return opening.withColumn("items", F.collect_list(early).over(before)).drop("_n")


def leave_last_out(histories: DataFrame) -> DataFrame:
    """Add `split`: the last event of a user is `test`, others `train`, the first is not used."""
    last = F.col("place") == F.col("events") - 1
    used = histories.where(F.col("place") >= 1)
    return used.withColumn("split", F.when(last, "test").otherwise("train"))


def popular_items(df: DataFrame, item: str, min_count: int) -> DataFrame:
    """`(item, n, rank)`: items with more than `min_count` rows, ranked by id from 0."""
    counted = frequent_values(df, item, min_count, "n")
    return materialize(global_rank(counted, [item], "rank"), "popular")


def unseen_rank(seen: Column, number: Column) -> Column:
    """The rank of the `number`-th item not in `seen`, an ascending list of ranks."""
    return F.aggregate(seen, number, lambda acc, s: F.when(s <= acc, acc + 1).otherwise(acc))


def seen_ranks(
    events: DataFrame, user: str, item: str, popular: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add `seen`, the ranks of the popular items among the user's events, ascending."""
    ranked = attach(events, popular, [item], rows_per_task=rows_per_task)
    own = Window.partitionBy(user)
    seen = F.array_sort(F.collect_set("rank").over(own))
    return ranked.withColumn("seen", seen).drop("rank")


def default_draw(user: str, seed: int = 100) -> Callable[[Column, Column], Column]:
    """A number fixed by user, place and repeat; unrelated to the item."""
    return lambda place, repeat: F.xxhash64(F.col(user), place, repeat, F.lit(seed))


def training_samples(
    df: DataFrame,
    user: str,
    item: str,
    order_by: Sequence[str],
    min_count: int,
    negatives: int,
    draw: Callable[[Column, Column], Column] | None = None,
    limit: int = FIRST_EVENTS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`(user, history, item, label, hist_len, split)` with negatives for the train rows.

    Negatives are popular items the user has not seen, with replacement. No candidate
    list is built: the popular items are ranked once, a number below the count of the
    unseen ones is drawn, and the user's seen ranks (at most `limit`) shift it to the
    rank of the unseen item. Users who have seen every popular item get no negatives.
    """
    draw = draw or default_draw(user)
    histories = prefix_histories(df.select(user, item, *order_by), user, item, order_by, limit)
    shape = [user, "history", item, "label", "hist_len", "split"]
    popular = popular_items(df, item, min_count)
    total = popular.count()
    if negatives == 0 or total == 0:
        return leave_last_out(histories).withColumn("label", F.lit(1)).select(*shape)
    used = leave_last_out(seen_ranks(histories, user, item, popular, rows_per_task))
    unseen = F.lit(total) - F.size("seen")
    repeats = F.when(
        (F.col("split") == "train") & (unseen > 0), F.sequence(F.lit(-1), F.lit(negatives - 1))
    ).otherwise(F.array(F.lit(-1)))
    spread = used.withColumn("_j", F.explode(repeats))
    number = F.pmod(draw(F.col("place"), F.col("_j")), unseen).cast("long")
    rank = F.when(F.col("_j") >= 0, unseen_rank(F.col("seen"), number))
    # positives go along without a rank, so histories and windows are computed once; a rank is
    # drawn about as often as any other, so none is hot
    drawn = spread.withColumn("rank", rank).drop("seen")
    listed = popular.select("rank", F.col(item).alias("_drawn"), F.lit(0).alias("n"))
    met = attach(drawn, listed, ["rank"], rows_per_task=rows_per_task)
    label = (F.col("_j") < 0).cast("int")
    chosen = F.when(F.col("_j") < 0, F.col(item)).otherwise(F.col("_drawn"))
    return met.withColumns({item: chosen, "label": label}).select(*shape)


def fit_profile(
    df: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """`(key, columns.., n)`: the values of the first row of each key, and its rows."""
    first = F.min_by(F.struct(*columns), F.struct(*order_by)).alias("_first")
    grouped = df.groupBy(key).agg(first, F.count(F.lit(1)).alias("n"))
    return materialize(grouped.select(key, "_first.*", "n"), "profile")


def attach_profiles(
    samples: DataFrame,
    user_profile: DataFrame,
    user: str,
    item_profile: DataFrame,
    item: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Look up both profiles; ids without a profile get NULLs."""
    samples = attach(samples, user_profile, [user], rows_per_task=rows_per_task)
    return attach(samples, item_profile, [item], rows_per_task=rows_per_task)


def model_rows(
    samples: DataFrame,
    user_profile: DataFrame,
    user: str,
    item_profile: DataFrame,
    item: str,
    length: int = 15,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Pad the history to its first `length` items and attach both profiles."""
    padded = samples.withColumn("history", pad(F.col("history"), length, keep="first"))
    return attach_profiles(padded, user_profile, user, item_profile, item, rows_per_task)


def top_unseen(
    df: DataFrame,
    user: str,
    item: str,
    order_by: Sequence[str],
    min_count: int,
    top: int,
    limit: int = FIRST_EVENTS,
) -> DataFrame:
    """`(user, place, item)`: the `top` most frequent popular items a user has not seen.

    The popular items are ranked by count, so these are the first unseen ranks: found
    from the user's own seen ranks, without pairing users and items.
    """
    counted = frequent_values(df, item, min_count, "n")
    popular = materialize(global_rank(counted, [F.desc("n"), item], "rank"), "popular")
    total = popular.count()
    events = first_events(df.select(user, item, *order_by), user, order_by, limit)
    ranked = attach(events, popular, [item])
    seen = ranked.groupBy(user).agg(F.array_sort(F.collect_set("rank")).alias("seen"))
    unseen = F.lit(total) - F.size("seen")
    places = F.filter(F.sequence(F.lit(0), F.lit(top - 1)), lambda j: j < unseen)
    wanted = seen.withColumn("place", F.explode(places))
    wanted = wanted.withColumn("rank", unseen_rank(F.col("seen"), F.col("place").cast("long")))
    # no wanted rank is above top + limit, so this is a small table by construction
    items = popular.where(F.col("rank") < top + limit).select("rank", item)
    return wanted.join(F.broadcast(items), "rank").select(user, "place", item)


def unseen_pairs(pairs: DataFrame, seen: DataFrame, user: str, item: str) -> DataFrame:
    """The `(user, item)` rows that do not occur in `seen`."""
    return pairs.join(seen.select(user, item).distinct(), [user, item], "left_anti")

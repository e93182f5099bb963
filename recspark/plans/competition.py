"""The feature table of the short-video competition: bins, counts, target means, side tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import composite_key, hour_of_day, map_keys_or_empty, map_sum
from ..operators.cleaning import fill_from, fit_means
from ..operators.counting import count_encode, distinct_encode, fit_counts, fit_distinct_counts
from ..operators.encoding import encode, fit_dictionary
from ..operators.scaling import fit_minmax, fit_quantile_bins, minmax_scale, quantile_bin
from ..operators.skew import attach, attach_side, key_profile
from ..operators.target import expanding_mean_train, fit_target, mean_test
from ..storage import materialize

# fixed values: the composite keys, key columns and bin counts of the competition features
COMPOSITES = {
    "uid-author_id": ("uid", "author_id"),
    "uid-did": ("uid", "did"),
    "did-channel": ("did", "channel"),
}
COUNT_KEYS = ["uid", "did", "item_id", "author_id", "uid-author_id"]
MEAN_KEYS = ["uid-author_id", "uid-did", "did-channel", "uid", "did", "item_id"]
DISTINCT = {
    "uid": ["item_city", "item_id", "author_id", "music_id"],
    "item_id": ["user_city", "uid"],
    "author_id": ["uid"],
}
DISTINCT_BINS = {
    "uid_item_city_nunique": 10,
    "uid_item_id_nunique": 10,
    "uid_author_id_nunique": 10,
    "uid_music_id_nunique": 10,
    "item_id_user_city_nunique": 10,
    "item_id_uid_nunique": 30,
    "author_id_uid_nunique": 20,
}


def time_bins(df: DataFrame, time: str = "creat_time", duration: str = "video_duration") -> DataFrame:
    """Duration in 10 and hour of day in 24 quantile bins, both from one scan."""
    df = df.withColumn(time, hour_of_day(F.col(time)))
    return quantile_bin(df, fit_quantile_bins(df, {duration: 10, time: 24}))


def with_composites(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: composite_key(F.col(a), F.col(b)) for name, (a, b) in COMPOSITES.items()}
    )


def count_features(df: DataFrame) -> DataFrame:
    return count_encode(df, fit_counts(df, COUNT_KEYS), COUNT_KEYS, bins=10)


def distinct_features(df: DataFrame) -> DataFrame:
    return distinct_encode(df, fit_distinct_counts(df, DISTINCT), DISTINCT, DISTINCT_BINS)


def mean_features(
    train: DataFrame, test: DataFrame, target: str, order_by: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Expanding means for the training rows, training means for the others.

    A composite key that the rows lack is there for its own mean only, so no other shuffle carries it.
    """
    fitted = fit_target(with_composites(train), MEAN_KEYS, target)
    for key in MEAN_KEYS:
        made = {key: composite_key(*map(F.col, COMPOSITES[key]))} if key in COMPOSITES else {}
        made = {} if key in train.columns else made
        train = expanding_mean_train(train.withColumns(made), fitted, [key], target, order_by).drop(*made)
        test = mean_test(test.withColumns(made), fitted, [key], target).drop(*made)
    return train, test


def with_titles(df: DataFrame, titles: DataFrame) -> DataFrame:
    """Add the title length (missing: mean over the titles) and its word ids (missing: none)."""
    features = titles.select(
        "item_id",
        map_sum(F.col("title_features")).alias("title_len"),
        map_keys_or_empty(F.col("title_features")).alias("title_words"),
    )
    means = fit_means(features.withColumn("title_len", F.col("title_len").cast("double")), ["title_len"])
    joined = attach_side(df, features, ["item_id"]).withColumn(
        "title_words", F.coalesce("title_words", F.array().cast("array<string>"))
    )
    return fill_from(joined.withColumn("title_len", F.col("title_len").cast("double")), means)


def with_vector(df: DataFrame, side: DataFrame, vector: str, prefix: str, size: int = 128) -> DataFrame:
    """Add one column per dimension of a side vector; rows without one get zeros."""
    joined = attach_side(df, side.select("item_id", vector), ["item_id"])
    dims = [
        F.coalesce(F.get(vector, i).cast("double"), F.lit(0.0)).alias(f"{prefix}{i}")
        for i in range(size)
    ]
    return joined.select(*[c for c in joined.columns if c != vector], *dims)


# fixed values: the category columns besides the counts
CATEGORIES = ["uid", "user_city", "item_id", "author_id", "item_city", "channel", "music_id", "did", "video_duration", "creat_time"]


def category_columns() -> list[str]:
    return [*CATEGORIES, *[f"{k}_cnt" for k in COUNT_KEYS], *DISTINCT_BINS]


def dense_columns(target: str, titles: bool = True) -> list[str]:
    return [*[f"{k}_{target}_mean" for k in MEAN_KEYS], *(["title_len"] if titles else [])]


def features(
    train: DataFrame,
    test: DataFrame,
    target: str,
    order_by: list[str],
    titles: DataFrame | None = None,
    video: DataFrame | None = None,
    audio: DataFrame | None = None,
    vector_size: int = 128,
) -> DataFrame:
    """The whole feature table, with `is_test`: bins, counts, distinct counts, target means, side
    tables, then codes for the category columns (missing is -1) and [0, 1] for the dense ones.

    Bins, counts and codes are fitted on all rows, target means on the training rows. `video`
    and `audio` are `(item_id, vector)` with one row per item.
    """
    rows = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    # read by four fits and their joins
    rows = materialize(time_bins(rows), "competition-rows")
    rows = distinct_features(count_features(with_composites(rows)).drop(*COMPOSITES))
    known, new = mean_features(rows.where("NOT is_test"), rows.where("is_test"), target, order_by)
    rows = known.unionByName(new)
    categories, dense = category_columns(), dense_columns(target, titles is not None)
    filled = {c: F.coalesce(F.col(c), F.lit(-1).cast(rows.schema[c].dataType)) for c in categories}
    item, missing = F.col("item_id"), F.col("item_id").isNull()
    # the codes replace the item, so the side tables' key is kept beside them
    rows = rows.withColumns({"_item": F.coalesce(item, F.lit(0).cast(rows.schema["item_id"].dataType)), "_none": missing, **filled})
    rows = materialize(rows, "competition-features")
    sides = item_sides(rows, titles, video, audio, vector_size)
    coded = encode(rows, fit_dictionary(rows, categories), categories)
    own = minmax_of(rows, sides, dense)
    # last, as a row is never shuffled with its vectors
    whole = attach(coded, sides, ["_item", "_none"]).drop("_item", "_none")
    return minmax_scale(whole, own)


def item_sides(
    rows: DataFrame, titles: DataFrame | None, video: DataFrame | None, audio: DataFrame | None, vector_size: int
) -> DataFrame:
    """`(_item, _none, n, ..)`: the side columns of each item of the rows, with `n` its rows.

    Side tables are joined to the items, not to the rows; `_none` is the item of rows without one.
    """
    items = key_profile(rows, ["_item", "_none"])
    items = items.withColumn("item_id", F.when(~F.col("_none"), F.col("_item")))
    for side, prefix in ((video, "vd"), (audio, "ad")):
        if side is not None:
            items = with_vector(items, side, "vector", prefix, vector_size)
    if titles is not None:
        items = with_titles(items, titles)
    return materialize(items.drop("item_id"), "competition-items")


def minmax_of(rows: DataFrame, sides: DataFrame, dense: Sequence[str]) -> DataFrame:
    """`fit_minmax` of the rows with their side columns, without joining them: each item has rows."""
    of_items = [c for c in dense if c in sides.columns]
    fitted = fit_minmax(rows, [c for c in dense if c not in of_items])
    return fitted.unionByName(fit_minmax(sides, of_items)) if of_items else fitted

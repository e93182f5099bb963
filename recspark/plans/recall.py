"""From a play log to recommendations and their recall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.metrics import recall_at
from ..operators.ranking import factor_vectors
from ..operators.samples import fit_profile, leave_last_out, model_rows, training_samples
from ..operators.search import exact_topk
from ..storage import materialize


def sample_rows(
    df: DataFrame,
    user: str,
    item: str,
    order_by: Sequence[str],
    user_columns: Sequence[str],
    item_columns: Sequence[str],
    min_count: int = 0,
    negatives: int = 3,
    length: int = 15,
    draw=None,
) -> DataFrame:
    """Histories, negatives and both profiles: the rows a two-tower model trains on."""
    samples = training_samples(df, user, item, order_by, min_count, negatives, draw)
    users = fit_profile(df, user, user_columns, order_by)
    items = fit_profile(df, item, item_columns, order_by)
    return model_rows(samples, users, user, items, item, length)


def recommend_and_score(
    df: DataFrame,
    user: str,
    item: str,
    weight: str,
    order_by: Sequence[str],
    k: int = 50,
    rank: int = 32,
    cutoffs: tuple[int, ...] = (10, 50),
) -> tuple[DataFrame, DataFrame]:
    """Train vectors without the held-out last items, search, and measure recall.

    All events take part; the last of each user with several is held out.
    """
    own = Window.partitionBy(user)
    place = F.row_number().over(own.orderBy(*order_by)) - 1
    placed = df.withColumns({"place": place, "events": F.count(F.lit(1)).over(own)})
    truth = leave_last_out(placed).where(F.col("split") == "test").select(user, item)
    train = placed.where(F.col("place") < F.col("events") - 1)
    users, items = factor_vectors(train, user, item, weight, rank)
    found = exact_topk(users, items, k, "cosine", user, "vector", item, "vector")
    found = materialize(found, "recommended").select(
        F.col("query_id").alias(user), F.col("item_id").alias(item), "score", "place"
    )
    return found, recall_at(found, truth, user, item, "place", cutoffs)

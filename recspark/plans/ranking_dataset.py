"""Click log to model rows: scale, code, pad, describe, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import FeatureProcessor, FeatureSpec
from ..operators.splits import draw, fraction_split

PARTS = ("train", "valid", "test")

# fixed values: the roles of the click log columns
CLICK_FEATURES = dict(
    dense=["time", "duration_time"],
    sparse=[
        "uid",
        "user_city",
        "item_id",
        "author_id",
        "item_city",
        "channel",
        "music_id",
        "device",
    ],
    sequences=["actors", "genres"],
    histories={"history_item_ids": "item_id", "history_citys": "item_city"},
)


def build(
    df: DataFrame, spec: FeatureSpec, held_out: float = 0.2, seed: int = 42, number: Column | None = None, size: int | None = None
) -> tuple[FeatureProcessor, DataFrame, list[DataFrame]]:
    """The fitted processor, the feature spec and the train, validation and test rows.

    The test rows are held out first, then the same share of the others for validation.
    `number`, in [0, `size`), places a row; without it a hash of the key does.
    """
    processor = FeatureProcessor(spec).fit(df)
    rows = processor.transform(df)
    rest = 1 - held_out
    shares = [rest * rest, rest * held_out, held_out]
    parts = fraction_split(rows, shares, draw([spec.key], seed)) if number is None else fraction_split(rows, shares, number, size)
    return processor, processor.feature_spec(), parts


def named(parts: list[DataFrame]) -> DataFrame:
    """The parts as one table with a column `part`."""
    train, valid, test = (p.select(F.lit(n).alias("part"), "*") for n, p in zip(PARTS, parts))
    return train.unionByName(valid).unionByName(test)

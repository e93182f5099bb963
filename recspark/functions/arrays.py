"""Column functions on lists, maps and plain numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, result: Callable[[Column], Column]) -> Column:
    """`result(value)` with `value` computed once.

    An expression used inside a lambda is computed again for every element; bound as the
    only element of an array it is not.
    """
    return F.get(F.transform(F.array(value), result), 0)


def split_list(text: Column, separators: str = "[,|]") -> Column:
    """Delimited text to an array; NULL gives one empty token, as an empty text does."""
    return F.split(F.coalesce(text, F.lit("")), separators)


def join_list(items: Column, separator: str = ",") -> Column:
    return F.array_join(items, separator)


def pad(items: Column, length: int, filler: object = 0, keep: str = "last") -> Column:
    """Cut or fill at the end to exactly `length`; long lists keep the `last` or `first` items."""
    filler = F.lit(filler)
    if keep == "last":
        start = F.greatest(F.size(items) - length, F.lit(0)) + 1
        kept = F.slice(items, start, F.lit(length))
    else:
        kept = F.slice(items, 1, length)
    return F.slice(F.concat(kept, F.array_repeat(filler, length)), 1, length)


def valid_length(items: Column) -> Column:
    """Number of entries that are not the padding 0."""
    return F.size(F.filter(items, lambda x: x != 0))


def map_sum(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda acc, x: acc + x)


def map_keys_or_empty(counts: Column) -> Column:
    return F.coalesce(F.map_keys(counts), F.array().cast("array<string>"))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def hour_of_day(seconds: Column) -> Column:
    """Fractional hour of a time in epoch seconds."""
    return F.pmod(seconds, F.lit(86400)) / F.lit(3600.0)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax(scores: Column) -> Column:
    """Weights over an array of doubles; the maximum is taken off first."""

    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(powers, lambda x: x / t))

    def powers_of(given: Column) -> Column:
        return let(F.array_max(given), lambda top: F.transform(given, lambda x: F.exp(x - top)))

    return let(let(scores, powers_of), shares)


def masked_softmax(scores: Column, ids: Column) -> Column:
    """`softmax` over the positions whose id is not the padding 0; all padding gives equal weights."""
    hidden = F.lit(float(1 - 2**32))  # fixed value: the score of padding
    return softmax(F.zip_with(scores, ids, lambda s, i: F.when(i != 0, s).otherwise(hidden)))


def named_items(values: Column, names: Sequence[str]) -> list[Column]:
    """Array to named columns, by position."""
    return [F.get(values, i).alias(name) for i, name in enumerate(names)]

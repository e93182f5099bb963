"""Times as whole numbers, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without time zone."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(column)
    # without a zone the clock reading counts as it is; a cast would use the session zone
    days = F.unix_date(column.cast("date")).cast("long")
    minutes = F.hour(column).cast("long") * 60 + F.minute(column)
    seconds = F.extract(F.lit("SECOND"), column) * 1_000_000
    return (days * 1440 + minutes) * 60_000_000 + seconds.cast("long")

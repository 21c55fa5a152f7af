"""Reading text as typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_type(text: Column, kind: T.DataType) -> Column:
    """Text as a value of the type, or null; whole numbers may be written with a fraction of 0."""
    if isinstance(kind, T.LongType):
        number = text.try_cast("double")
        return F.coalesce(text.try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))
    if isinstance(kind, T.DoubleType):
        number = text.try_cast("double")
        return F.when(~F.isnan(number), number)
    return text.try_cast(kind)

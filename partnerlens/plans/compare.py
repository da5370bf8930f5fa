"""Canonical result shape for cross-engine comparison.

Counts stay bigint, money becomes double rounded to 2 places, other
fractions double rounded to 6, timestamps stay without zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = F.round(c.cast("double"), 2)
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)

"""Result types that every engine prints alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, days and times as text, flags as numbers, arrays as joined text."""
    return df.select(*[_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def _plain(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return c.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    if isinstance(kind, T.ArrayType):
        items = c
        if isinstance(kind.elementType, T.StructType):
            names = kind.elementType.fieldNames()
            items = F.transform(c, lambda x: F.concat_ws(":", *[x[n].cast("string") for n in names]))
        return F.array_join(items, ",")
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])))
        return F.array_join(entries, ",")
    return c

"""Plain value types at the report boundary: exact amounts as doubles, dates and times as ISO text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def present(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        shown.append(c.alias(field.name))
    return df.select(*shown)

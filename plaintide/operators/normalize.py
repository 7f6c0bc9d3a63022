"""Projection to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.functions.scalar import from_utc_wall, instant, strict_cast, typed_null
from plaintide.schemas import BRONZE


def normalize_schema(df: DataFrame, schema: T.StructType = BRONZE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the declared fields in order: cast, typed NULL if absent, extra columns dropped.

    A value that cannot be cast fails the query. Times without a zone are UTC; timestamps keep milliseconds. `keep` names columns that
    stay behind the declared ones, such as a partition column.
    """

    def field(declared: T.StructField) -> Column:
        name, target = declared.name, declared.dataType
        if name not in df.columns:
            return typed_null(target).alias(name)
        column, source = F.col(name), df.schema[name].dataType
        if isinstance(target, T.TimestampType):
            if isinstance(source, (T.TimestampNTZType, T.DateType)):
                column = from_utc_wall(column)
            elif source != target:
                column = strict_cast(instant(column.cast("string")), target, name)
            return F.timestamp_millis(F.unix_millis(column)).alias(name)
        if source == target:
            return column
        return strict_cast(column, target, name).alias(name)

    return df.select(*[field(f) for f in schema], *keep)

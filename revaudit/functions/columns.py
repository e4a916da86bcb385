"""Column expressions used by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
NAME_SEPARATOR = "|"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: str | Column) -> Column:
    """Remove every double quote: ``replace(s, '"', '')``."""
    return F.replace(col(c), F.lit('"'), F.lit(""))


def null_to_blank(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def upper_utf8(c: str | Column) -> Column:
    return F.upper(col(c))


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar days from ``start`` to ``end`` (midnights crossed), as bigint."""
    return F.datediff(col(end), col(start)).cast("bigint")


def ts_text(c: str | Column) -> Column:
    """Timestamp rendered to the second, ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col(c), TEXT_TS_FORMAT)


def any_nonzero(*cols: str | Column) -> Column:
    """``a <> 0 OR b <> 0 ..``; a NULL sum is not non-zero."""
    return reduce(or_, [col(c) != 0 for c in cols])


def sorted_text(c: str | Column, separator: str = NAME_SEPARATOR) -> Column:
    """Aggregate over distinct values: the non-NULL ones, byte-order sorted, joined by ``separator``."""
    return F.array_join(F.array_sort(F.collect_list(col(c))), separator)


def split_names(c: str | Column, separator: str = NAME_SEPARATOR) -> Column:
    return F.split(col(c), re.escape(separator))


def with_defaults(df: DataFrame, keep_null: tuple[str, ...] = ()) -> DataFrame:
    """Replace NULL by the type default of a column store: '' / 0 / epoch / false.

    Columns in ``keep_null`` stay nullable (the day differences, whose missing
    value is NULL in the audited table as well).
    """
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        t = field.dataType
        if field.name in keep_null:
            out.append(c)
            continue
        if isinstance(t, T.StringType):
            default = F.lit("")
        elif isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType,
                            T.DoubleType, T.FloatType, T.DecimalType)):
            default = F.lit(0).cast(t)
        elif isinstance(t, T.TimestampNTZType):
            default = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        elif isinstance(t, T.TimestampType):
            default = F.lit(0).cast(T.TimestampType())
        elif isinstance(t, T.DateType):
            default = F.lit("1970-01-01").cast(T.DateType())
        elif isinstance(t, T.BooleanType):
            default = F.lit(False)
        else:
            out.append(c)
            continue
        out.append(F.coalesce(c, default).alias(field.name))
    return df.select(*out)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double (for engine-neutral comparison of results)."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])

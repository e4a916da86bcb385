"""Join helpers: dimension lookups behind a proven size bound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dimensions of a plan are broadcast only as far as their rows together hold at most
# this many bytes (measured, not estimated): the driver builds each of them, and takes several times its
# bytes for it.  The others' lookups are shuffle joins, which AQE may still turn into a broadcast from the real shuffle size.
DEFAULT_BROADCAST_BYTES = 16 << 20
_ROW_BYTES = 32  # of one row's own overhead and fixed-width columns' upper bound, each


def _row_bytes(df: DataFrame) -> Column:
    parts = [F.lit(_ROW_BYTES)]
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        text = isinstance(field.dataType, (T.StringType, T.BinaryType))
        parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8 if text else F.lit(_ROW_BYTES))
    return reduce(lambda a, b: a + b, parts).cast("long")


def measured_bytes(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Bytes of each table's rows, in one job: a partial sum per task, one long each."""
    sums = [df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).select(F.lit(name).alias("name"), "bytes")
            for name, df in tables.items()]
    return {r["name"]: r["bytes"] for r in reduce(DataFrame.unionByName, sums).collect()}


def fitting(sizes: dict[str, int], max_bytes: int) -> dict[str, bool]:
    """Which tables may be broadcast, smallest first, so that all of them together hold at most ``max_bytes``."""
    fits, held = {}, 0
    for name, n in sorted(sizes.items(), key=lambda item: item[1]):
        fits[name] = held + n <= max_bytes
        held += n if fits[name] else 0
    return fits


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           columns: dict[str, str], max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
           broadcast: bool | None = None) -> DataFrame:
    """Left-outer lookup of ``dim`` columns (``{dim column: output name}``) by one key.

    The dimension side is projected to the key and the wanted columns before the
    join, renamed so that the same dimension can play several roles.  ``broadcast``
    is the result of an earlier size check; None checks here.
    """
    key_alias = f"__lk_{fact_key}"
    side = dim.select(F.col(dim_key).alias(key_alias),
                      *[F.col(src).alias(dst) for src, dst in columns.items()])
    if broadcast is None:
        broadcast = measured_bytes({"dim": side})["dim"] <= max_broadcast_bytes
    if broadcast:
        side = F.broadcast(side)
    return (fact.join(side, fact[fact_key] == side[key_alias], "left")
                .drop(key_alias))


def assert_unique(dim: DataFrame, key: str) -> None:
    """Raise if ``key`` repeats in ``dim`` (a repeated key multiplies looked-up sums)."""
    dup = dim.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"dimension key {key!r} is not unique, e.g. {dup[0][key]!r}")

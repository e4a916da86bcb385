"""Exact money sums at every scale.

``sum`` of a ``decimal(18,2)`` widens to ``decimal(28,2)``, which Spark adds with
arbitrary-precision objects, row by row.  An amount of at most 18 digits is
therefore summed as a long count of minor units (10**-scale each), which stays in
the code-generated hash aggregate and is exact; the result becomes a decimal of the
input's scale once per group.  Wider decimals are summed as they are.  Floating-point amounts
are refused: they have no exact minor unit; cast them to a decimal first.

The conversion to units goes through a double where that is provably exact: for
``|amount| * 10**scale < 2**50`` the nearest double's error and the product's rounding
stay below one half together, so rounding recovers the integer.  Other amounts take the
decimal route, with the same result.

A long sum overflows past 9.2e18 minor units.  Under ANSI mode (``SESSION_DEFAULTS``, and
Spark's default) that is an error; where a session has it off, units are
summed as decimals (``unit_sum``), so that no sum wraps.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOUBLE_BOUND = 2 ** 50


class Money(NamedTuple):
    """How an amount column is summed: its scale, and whether it is too wide for longs."""

    scale: int
    wide: bool = False


def money_scale(df: DataFrame, name: str) -> Money:
    t = df.schema[name].dataType
    if isinstance(t, T.DecimalType):
        return Money(t.scale, t.precision > 18)
    if isinstance(t, T.IntegralType):
        return Money(0)
    raise TypeError(f"amount column {name!r} is {t.simpleString()}; cast it to a decimal")


def to_units(c: str | Column, money: Money) -> Column:
    """Amount -> long count of minor units (exact); wide amounts stay decimals."""
    c = F.col(c) if isinstance(c, str) else c
    if money.wide:
        return c
    factor = 10 ** money.scale
    fast = F.rint(c.cast("double") * F.lit(float(factor))).cast("long")
    exact = (c * F.lit(factor).cast("decimal(19,0)")).cast("long")
    return F.when(F.abs(c) < F.lit(_DOUBLE_BOUND // factor), fast).otherwise(exact)


def unit_sum(c: str | Column, money: Money) -> Column:
    """Sum of units that raises or widens, but never wraps."""
    c = F.col(c) if isinstance(c, str) else c
    ansi = SparkSession.active().conf.get("spark.sql.ansi.enabled", "true").lower() == "true"
    return F.sum(c) if money.wide or ansi else F.sum(c.cast("decimal(28,0)"))


def from_units(c: str | Column, money: Money) -> Column:
    """Units -> ``decimal(38, scale)``, exactly."""
    c = F.col(c) if isinstance(c, str) else c
    out = f"decimal(38,{money.scale})"
    if money.wide:
        return c.cast(out)
    digits = min(37 - money.scale, 30)
    return (c.cast(f"decimal({digits},0)") * F.lit(Decimal(1).scaleb(-money.scale))).cast(out)

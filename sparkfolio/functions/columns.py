"""Column-level helpers, all JVM-side built-ins (no Python UDFs).

Spark 4 runs with ANSI mode on: a bad string cast or a division by zero
raises. The reference was written for null-on-failure, so every parse and
every division that may see a zero goes through the ``try_`` forms here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: str | Column) -> Column:
    """String/number -> double, null when it does not parse."""
    return _col(c).try_cast(T.DoubleType())


def as_long(c: str | Column) -> Column:
    """String/number -> bigint, null when it does not parse or fit. Decimal text
    loses its fraction ("1234.0" is 1234), as in a cast outside ANSI mode."""
    return F.coalesce(_col(c).try_cast(T.LongType()),
                      _col(c).try_cast(T.DecimalType(38, 10)).try_cast(T.LongType()))


def as_date(c: str | Column) -> Column:
    """String -> date, null when it does not parse."""
    return _col(c).try_cast(T.DateType())


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null; ``keys`` come from ``left``."""
    names = {k: f"__{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[n]) for k, n in names.items()])
    return left.join(right, on).drop(*names.values())


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is zero or null."""
    return F.try_divide(_col(num), _col(den))


def changed(old: Column, new: Column, null_safe: bool = True) -> Column:
    """True when a tracked value differs.

    ``null_safe=True`` treats null -> value and value -> null as a change;
    ``False`` keeps SQL ``!=`` semantics (a null on either side is never a
    change), which is what the reference's change detection does.
    """
    if null_safe:
        return ~old.eqNullSafe(new)
    return F.coalesce(old != new, F.lit(False))


def any_changed(pairs: list[tuple[Column, Column]], null_safe: bool = True) -> Column:
    return reduce(lambda a, b: a | b, [changed(o, n, null_safe) for o, n in pairs])


def round_doubles(df: DataFrame, scale: int = 6) -> DataFrame:
    """Round every double column on output (used by the oracle-checked queries).

    Doubles from windows and aggregates differ between engines in the last
    bits; comparisons are made at 6 decimal places. Never round inside a
    computation, only on the final projection.
    """
    cols = [
        F.round(F.col(f.name), scale).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(cols)


def ints_to_long(df: DataFrame) -> DataFrame:
    """Cast int columns to bigint so result schemas match SQL engines."""
    cols = [
        F.col(f.name).cast(T.LongType()).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(cols)

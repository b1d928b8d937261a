"""Column expressions with the library's rules for what is missing: NULL, never 0, NaN or infinity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """NaN becomes NULL; for every double that enters the library."""
    return F.when(~F.isnan(col(c)), col(c))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """NULL where either side is or the denominator is 0."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def when_full(value: Column, present: Column, size: int) -> Column:
    """A window's aggregate only where all of its rows had a value."""
    return F.when(present == size, value)


def formatted(pattern: str, value: Column) -> Column:
    """A number by a pattern; an em dash where missing, which the pattern alone would print as cut text."""
    return F.when(value.isNotNull(), F.format_string(pattern, value)).otherwise("—")


def signed_percent(c: str | Column, digits: int = 2) -> Column:
    """+1.23%; an em dash where missing."""
    return formatted(f"%+.{digits}f%%", col(c) * 100)


def shown(c: str | Column, digits: int = 2) -> Column:
    return formatted(f"%.{digits}f", col(c).cast("double"))


def signed(c: str | Column, digits: int = 2) -> Column:
    return formatted(f"%+.{digits}f", col(c).cast("double"))


def group_or_own(group: str | Column, key: str | Column) -> Column:
    """The group, or a printable placeholder of its own for a key that has none."""
    return F.coalesce(F.nullif(col(group).cast("string"), F.lit("")), F.concat(F.lit("__no_sector__:"), col(key).cast("string")))


def flags(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two arrays, as double."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

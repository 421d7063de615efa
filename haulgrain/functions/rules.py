"""Predicates and business rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import ColumnOrName, as_column


# --- predicates -----------------------------------------------------------------------------


def non_blank(c: ColumnOrName, min_length: int = 2) -> Column:
    """Text of at least ``min_length`` characters; one-character values count as blank."""
    return F.length(F.coalesce(as_column(c), F.lit(""))) >= min_length


def not_sentinel(c: ColumnOrName, sentinel: str) -> Column:
    """Value differs from the sentinel; NULL does not pass."""
    return as_column(c) != F.lit(sentinel)


def not_text_null(c: ColumnOrName) -> Column:
    """Drops real NULLs and the text ``NULL`` some extracts write instead."""
    return as_column(c) != F.lit("NULL")


def measurable(status: ColumnOrName, dates: Iterable[ColumnOrName], done: str = "7") -> Column:
    """A shipment that can be measured: finished, with every one of the dates present."""
    checks = [as_column(status) == F.lit(done), *(not_text_null(d) for d in dates)]
    return reduce(lambda a, b: a & b, checks)


# --- rules ----------------------------------------------------------------------------------


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1) -> Column:
    """``num / den * scale``, NULL for a zero or NULL denominator."""
    ratio = F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))
    return ratio if scale == 1 else ratio * F.lit(float(scale))


def clamp_floor(c: ColumnOrName, floor: float = 0) -> Column:
    """Raise values below the floor to it.  NULL stays NULL (``greatest`` would ignore it)."""
    value = as_column(c)
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def dispatch_by_code(code: ColumnOrName, mapping: Mapping[Iterable[str] | str, ColumnOrName]) -> Column:
    """Pick a column by code; ``mapping`` goes from one code or several codes to a column.

    Codes not listed give NULL.
    """
    code = as_column(code)
    picked: Column | None = None
    for codes, target in mapping.items():
        listed = code.isin([codes] if isinstance(codes, str) else list(codes))
        value = as_column(target)
        picked = F.when(listed, value) if picked is None else picked.when(listed, value)
    if picked is None:
        raise ValueError("mapping is empty")
    return picked


def on_time_flag(promised: ColumnOrName, actual: ColumnOrName) -> Column:
    """1 if the promise was kept, 0 if not, NULL if either moment is unknown."""
    promised, actual = as_column(promised), as_column(actual)
    return F.when(promised >= actual, 1).when(promised < actual, 0)


def presence(c: ColumnOrName) -> Column:
    """1 where the value is known, 0 where it is NULL: the distinct count of a key within itself."""
    return as_column(c).isNotNull().cast("long")

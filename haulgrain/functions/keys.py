"""Business-key columns.

Shipment, material and carrier numbers arrive as text, padded with zeros by some sources and not
by others.  Every function here takes and returns a ``Column``, passes NULL through and stays
inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c: ColumnOrName, mode: str = "all", keep_zero: bool = False) -> Column:
    """Strip leading zeros: ``mode="all"`` removes every one, ``mode="one"`` only the first.

    The text ``0`` becomes empty; ``keep_zero=True`` keeps one zero in that case.
    """
    text = as_column(c)
    if mode == "all":
        stripped = F.ltrim(text, F.lit("0"))
    elif mode == "one":
        stripped = F.regexp_replace(text, "^0", "")
    else:
        raise ValueError(f"mode must be 'all' or 'one', not {mode!r}")
    if not keep_zero:
        return stripped
    return F.when((stripped == "") & (text != ""), F.lit("0")).otherwise(stripped)


def tail_key(c: ColumnOrName, n: int) -> Column:
    """Last ``n`` characters; a shorter text is returned whole."""
    return F.right(as_column(c), F.lit(n))


def padded_key(c: ColumnOrName, n: int, fill: str = "0") -> Column:
    """Left-pad to ``n`` characters.  Longer texts are kept whole (plain ``lpad`` would cut them)."""
    text = as_column(c).cast("string")
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, fill))


def composite_key(*cols: ColumnOrName, sep: str = "-") -> Column:
    """Join parts into one text key; NULL if any part is NULL (unlike ``concat_ws``)."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append(as_column(c).cast("string"))
    return F.concat(*parts)

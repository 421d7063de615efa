"""Joins of facts with per-key rows when single keys can hold a large share of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salt_column(by: Sequence[str], salts: int) -> Column:
    """Salt from the content of some columns and the split the row is read in.

    Both are the same when a lost task is run again, which a random number is not, and copies of
    one row spread over the splits they are stored in.
    """
    content = F.xxhash64(*(F.col(c) for c in by))
    return F.pmod(content + F.spark_partition_id(), F.lit(salts)).cast("int")


def join_totals(
    facts: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    salts: int = 1,
    salt_by: Sequence[str] | None = None,
    keep_salt: bool = False,
) -> DataFrame:
    """Join facts with a frame that has at most one row per key.

    Such a frame usually comes straight from an aggregate on the same keys.  Adaptive execution
    does not split a hot key of a join that sits directly on that aggregate, so the join also
    compares a salt: both sides are then exchanged for the join, and hot partitions are split.

    ``salts > 1`` moreover repeats the totals once per salt, which divides every key over that
    many partitions from the start; it suits few, large groups.  ``salt_by`` names the columns
    that spread them (an identifier of the rows); left out, all columns do.

    No side is hinted: Spark broadcasts the totals by itself when their size, known or measured
    at run time, allows it.  ``keep_salt`` leaves ``_salt`` in the rows: a ``distinct`` or grouping on the
    keys, the salt and more columns then needs no further exchange.  ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    extra = [c for c in totals.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        extra = []
    twice = sorted({c.lower() for c in facts.columns} & {c.lower() for c in extra})
    if twice:
        raise ValueError(f"columns on both sides of the join: {twice}")
    right_keys = [f"_r_{k}" for k in keys]
    right = totals.select(*(F.col(k).alias(r) for k, r in zip(keys, right_keys)), *extra)
    if salts > 1:
        left_salt = salt_column(salt_by or facts.columns, salts)
        right_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    else:
        left_salt, right_salt = _single_salt(keys), _single_salt(right_keys)
    left = facts.withColumn("_salt", left_salt)
    right = right.withColumn("_r_salt", right_salt)
    matches = [
        F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r)
        for k, r in zip(keys, right_keys)
    ]
    matches.append(F.col("_salt") == F.col("_r_salt"))
    joined = left.join(right, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*right_keys, "_r_salt", *([] if keep_salt else ["_salt"]))


def join_apart(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on common keys that gets exchanges of its own, so that hot keys can be split.

    Neither side's earlier partitioning is reused (see ``join_totals``); keys may repeat on both.
    """
    salted = [df.withColumn("_salt", _single_salt(keys)) for df in (left, right)]
    return salted[0].join(salted[1], [*keys, "_salt"], how).drop("_salt")


def _single_salt(keys: Sequence[str]) -> Column:
    """Zero for every row, computed from the keys so that the planner keeps it as a join key.

    Never NULL, so that inner and outer joins of one frame filter nothing and share its exchange.
    """
    return F.coalesce(F.pmod(F.xxhash64(*(F.col(k) for k in keys)), F.lit(1)).cast("int"), F.lit(0))

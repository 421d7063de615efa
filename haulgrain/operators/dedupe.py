"""Choosing rows: latest periods, latest row per key, first or last stage, child exclusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import ColumnOrName, as_column
from .skew import join_totals


def latest_n_periods(df: DataFrame, period: ColumnOrName, n: int) -> DataFrame:
    """Rows of the ``n`` highest period keys.

    Only the distinct keys are ranked: they are deduplicated before the shuffle and the top ``n``
    come from a take-ordered step, so no window runs over the facts.  The lowest of them reaches the
    rows as a scalar, in a filter that Spark applies before the joins ``df`` is made of; a join with
    the keys would come after these.  A NULL period ranks last, as in a descending
    ``dense_rank``, and is kept while it is among the ``n``.
    """
    if n < 1:
        raise ValueError("n must be positive")
    key = as_column(period)
    ranked = df.select(key.alias("_period")).distinct().orderBy(F.col("_period").desc_nulls_last())
    # NULL where it is the n-th key itself or there are fewer keys: then every row is kept
    lowest = ranked.offset(n - 1).limit(1).scalar()
    return df.filter(lowest.isNull() | (key >= lowest))


def _total_order(order: Sequence[Column], tiebreak: Sequence[str]) -> list[Column]:
    return [*order, *(F.col(c).desc_nulls_last() for c in tiebreak)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the highest ``order``, NULLs last.

    Ties are settled by ``tiebreak`` (highest first); left out, all remaining columns settle them,
    so the survivor never depends on the partitioning.  The rank filter is applied inside each
    partition before the shuffle, hence a hot key sends one row per task.
    """
    named = {c for c in order if isinstance(c, str)} | set(keys)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in named]
    descending = [as_column(c).desc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*_total_order(descending, tiebreak))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedupe_on_keys(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per key under a total order (``dropDuplicates`` leaves the survivor to chance)."""
    rest = [c for c in (tiebreak or df.columns) if c not in keys]
    return latest_per_key(df, keys, rest[:1], rest[1:]) if rest else df.distinct()


def keep_min_stage(df: DataFrame, key: str, stage: str) -> DataFrame:
    """Rows at the smallest stage of their key.

    The minima come from a map-side combined aggregate and the rows are kept by a semi join on
    (key, stage), whose hot partitions adaptive execution splits; a window would sort all rows of
    a hot key in one task.  Rows with a NULL key or stage are dropped.
    """
    minima = df.groupBy(key).agg(F.min(stage).alias(stage))
    return join_totals(df, minima, [key, stage], "left_semi")


def final_stage_attr(
    df: DataFrame, key: str, stage: str, attrs: Sequence[str], prefix: str = "final_"
) -> DataFrame:
    """Attributes of the row with the highest stage per key, ties settled by the attributes."""
    narrow = df.select(key, stage, *attrs)
    last = latest_per_key(narrow, [key], [stage], list(attrs))
    return last.select(key, *(F.col(a).alias(prefix + a) for a in attrs))


def drop_linked_children(
    df: DataFrame, key: str, child_keys: DataFrame, child_key: str
) -> DataFrame:
    """Rows whose key is not listed as a child of another row.

    Child keys are deduplicated before they are shuffled.  A NULL key has no match and stays.
    """
    children = child_keys.select(F.col(child_key).alias(key)).dropna().distinct()
    return join_totals(df, children, [key], "left_anti")


def first_event(df: DataFrame, keys: Sequence[str], ts: str, attrs: Sequence[str]) -> DataFrame:
    """First event time per key with the highest attribute values seen at that time.

    Two combined aggregates and no join: maxima per (key, time), then the ones at the minimum time.
    """
    per_moment = df.groupBy(*keys, ts).agg(*(F.max(a).alias(a) for a in attrs))
    first = per_moment.groupBy(*keys).agg(
        F.min(ts).alias(f"first_{ts}"),
        F.min_by(F.struct(*attrs), F.col(ts)).alias("_first"),
    )
    return first.select(*keys, f"first_{ts}", *(F.col(f"_first.{a}").alias(a) for a in attrs))


def last_event_attr(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """Attributes of the row with the highest ``order`` tuple: a real arg-max per key.

    A maximum over a struct compares field by field, so the attributes of one row stay together
    (independent maxima may combine values no single row has).  ``order`` columns come back too.
    """
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *attrs)).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in (*order, *attrs)))

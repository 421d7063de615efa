"""Lookups, bridges and matching with a fallback."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reshape import union_all
from .skew import join_apart, join_totals
from .stage import Stage, no_stage


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    cols: Sequence[str] | Mapping[str, str],
    null_safe: bool = False,
    stage: Stage = no_stage,
) -> DataFrame:
    """Left join that never multiplies rows: the dimension is reduced to one row per key first.

    ``on`` maps columns of ``df`` to key columns of ``dim`` (or lists common names); ``cols`` maps
    output names to columns of ``dim``.  Where the dimension repeats a key, the highest value of
    each column is taken.  The dimension is broadcast only when Spark finds it under its size
    threshold.  What Spark derives for a dimension made by joins or unions is far above its real
    size, and ``df`` is then shuffled before it can be measured: a ``stage`` that writes the reduced
    dimension (``lookup_`` and the key names) shows its size beforehand.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    wanted = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    named = dim.select(
        *(F.col(d).alias(k) for k, d in pairs.items()),
        *(F.col(c).alias(o) for o, c in wanted.items()),
    )
    unique = named.groupBy(*pairs).agg(*(F.max(o).alias(o) for o in wanted))
    unique = stage(unique, "_".join(["lookup", *pairs, *wanted]))
    return join_totals(df, unique, list(pairs), null_safe=null_safe)


def bridge(df: DataFrame, hops: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Chain of inner joins; each hop maps columns reached so far to columns of the next frame.

    The key columns of a hop are not repeated in the result.
    """
    for frame, keys in hops:
        renamed = frame.withColumnsRenamed({right: left for left, right in keys.items()})
        df = df.join(renamed, list(keys), "inner")
    return df


def override_for(
    df: DataFrame, key: str, listed: Sequence[str] | DataFrame, name: str, use: str, otherwise: str
) -> DataFrame:
    """``name`` is the column ``use`` for listed keys and ``otherwise`` for all others.

    The list is data: either a short sequence or a frame whose first column holds the keys.
    """
    if not isinstance(listed, DataFrame):
        hit = F.col(key).isin(list(listed))
        return df.withColumn(name, F.when(hit, F.col(use)).otherwise(F.col(otherwise)))
    keys = listed.select(F.col(listed.columns[0]).alias("_listed")).withColumn("_hit", F.lit(1))
    marked = lookup(df, keys, {key: "_listed"}, ["_hit"])
    picked = F.when(F.col("_hit") == 1, F.col(use)).otherwise(F.col(otherwise))
    return marked.withColumn(name, picked).drop("_hit")


def fallback_match(
    facts: DataFrame,
    ref: DataFrame,
    exact_keys: Sequence[str],
    coarse_keys: Sequence[str],
    keep_duplicates: bool = False,
    regroup: Callable[[DataFrame], DataFrame] | None = None,
    stage: Stage = no_stage,
    spread: int = 1,
) -> DataFrame:
    """Match on the exact keys, and what is left over on the coarser ones.

    Facts without an exact match go through ``regroup`` (for instance a rollup to the coarse
    grain) and are matched on ``coarse_keys``.  ``match_tier`` is 1 for an exact match, 2 for a
    coarse one and 0 for none.  Every fact comes out in one tier.  With ``keep_duplicates=True``
    unmatched facts are also kept in their ungrouped form with tier 0, which counts them twice.

    One left join marks the facts that meet an exact row; it is handed to ``stage`` as
    ``fallback_matched`` because matched and unmatched rows part there.  A second left join does
    the same on the coarse keys.

    ``spread`` > 1 is for few exact keys with many reference rows each, where a small input makes a
    large result: the facts are dealt out to so many tasks by their content, and each key to so many
    join keys, for which the reference is repeated.
    """
    tried = stage(_marked(facts, ref, exact_keys, spread), "fallback_matched")
    exact = tried.filter("_hit = 1").drop("_hit").withColumn("match_tier", F.lit(1))
    rest = tried.filter("_hit IS NULL").select(*facts.columns)
    regrouped = regroup(rest) if regroup is not None else rest
    tier = F.when(F.col("_hit") == 1, 2).otherwise(0)
    coarse = _marked(regrouped, ref, coarse_keys).withColumn("match_tier", tier).drop("_hit")
    parts = [exact, coarse]
    if keep_duplicates:
        parts.append(rest.withColumn("match_tier", F.lit(0)))
    return union_all(parts, fill_missing=True)


def _marked(facts: DataFrame, ref: DataFrame, keys: Sequence[str], spread: int = 1) -> DataFrame:
    """Facts with the reference rows of their keys and ``_hit`` = 1, or NULL where there is none.

    Columns that both have stay the facts' own.
    """
    shared = [c for c in ref.columns if c in facts.columns and c not in keys]
    found = ref.drop(*shared).withColumn("_hit", F.lit(1))
    if spread == 1:
        return join_apart(facts, found, keys, "left")
    # the salt is the row's task, so it follows from the content alone
    by = [F.xxhash64(*(F.col(c) for c in facts.columns)), F.lit(spread)]
    salted = facts.withColumn("_part", F.pmod(*by).cast("int")).repartition(spread, "_part")
    repeated = found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return join_apart(salted, repeated, [*keys, "_part"], "left").drop("_part")

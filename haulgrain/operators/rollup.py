"""Grain-safe aggregates.

Every operator is built from ``groupBy().agg()`` with combinable functions, so rows are reduced
inside the map tasks before they are shuffled and a hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import ColumnOrName, as_column
from ..functions.rules import safe_ratio
from .skew import join_totals
from .stage import Stage, no_stage


@dataclass(frozen=True)
class RollupSpec:
    """Column roles of a rollup: what to group by and how each other column is reduced.

    Each role is a list of column names, or a mapping from output name to input column.
    """

    keys: Sequence[str]
    attributes: Sequence[str] | dict[str, str] = field(default_factory=list)  # max
    minima: Sequence[str] | dict[str, str] = field(default_factory=list)
    sums: Sequence[str] | dict[str, str] = field(default_factory=list)
    means: Sequence[str] | dict[str, str] = field(default_factory=list)
    distinct_counts: Sequence[str] | dict[str, str] = field(default_factory=list)
    row_count: str | None = None

    @staticmethod
    def _pairs(role: Sequence[str] | dict[str, str]) -> list[tuple[str, str]]:
        return list(role.items()) if isinstance(role, dict) else [(c, c) for c in role]

    def with_remaining_attributes(
        self, df: DataFrame, exclude: Sequence[str] = ()
    ) -> "RollupSpec":
        """Give every column of ``df`` that has no role yet the attribute role."""
        roles = (self.attributes, self.minima, self.sums, self.means, self.distinct_counts)
        taken = {*self.keys, *exclude}
        for role in roles:
            for out, src in self._pairs(role):
                taken |= {out, src}
        rest = {c: c for c in df.columns if c not in taken}
        return replace(self, attributes={**dict(self._pairs(self.attributes)), **rest})

    def aggregates(self, attributes: bool = True) -> list[Column]:
        pairs = self._pairs
        out = [F.max(s).alias(o) for o, s in pairs(self.attributes)] if attributes else []
        out += [F.min(s).alias(o) for o, s in pairs(self.minima)]
        out += [F.sum(s).alias(o) for o, s in pairs(self.sums)]
        out += [F.avg(s).alias(o) for o, s in pairs(self.means)]
        out += [F.count_distinct(s).alias(o) for o, s in pairs(self.distinct_counts)]
        if self.row_count:
            out.append(F.count(F.lit(1)).alias(self.row_count))
        return out


def wide_rollup(df: DataFrame, spec: RollupSpec, coherent: bool = False) -> DataFrame:
    """Group at a grain and reduce each column by its role.

    Attributes are reduced by their own maximum each, which may mix values of different rows.
    ``coherent=True`` takes them from one row instead, the one with the highest attribute tuple
    (one struct to aggregate rather than many columns).
    """
    attributes = spec._pairs(spec.attributes)
    if not (coherent and attributes):
        return df.groupBy(*spec.keys).agg(*spec.aggregates())
    row = F.max(F.struct(*(F.col(s).alias(o) for o, s in attributes))).alias("_row")
    others = spec.aggregates(attributes=False)
    rolled = df.groupBy(*spec.keys).agg(row, *others)
    named = [c for c in rolled.columns if c not in (*spec.keys, "_row")]
    return rolled.select(*spec.keys, *(F.col(f"_row.{o}").alias(o) for o, _ in attributes), *named)


def rollup_of_repeated(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """``wide_rollup`` for a grain that most rows have to themselves.

    A maximum over text has no fixed size, so Spark reduces it by sorting all rows.  Here the keys are
    counted first, which it does by hash over the key columns alone and combines before the
    shuffle.  Rows whose key occurs once are their own result: they are only projected.  The sort is
    left to the rows of repeated keys.  The keys that repeat meet the rows in one join, broadcast
    where Spark measures them to be small.  Where most keys repeat this is an additional pass;
    ``wide_rollup`` is then the better choice.
    """
    keys = list(spec.keys)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    marked = join_totals(df, repeated, keys, null_safe=True)
    rolled = marked.where("_times IS NOT NULL").drop("_times").groupBy(*keys).agg(*spec.aggregates())
    pairs = spec._pairs
    single = {o: F.col(s) for role in (spec.attributes, spec.minima, spec.sums, spec.means) for o, s in pairs(role)}
    single |= {o: F.when(F.col(s).isNotNull(), 1).otherwise(0) for o, s in pairs(spec.distinct_counts)}
    if spec.row_count:
        single[spec.row_count] = F.lit(1)
    kinds = dict(rolled.dtypes)
    alone = marked.where("_times IS NULL").select(*keys, *(value.cast(kinds[o]).alias(o) for o, value in single.items()))
    return rolled.unionByName(alone)


def rollup_beside(
    df: DataFrame,
    spec: RollupSpec,
    facts: DataFrame,
    on: Sequence[str],
    null_too: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """``wide_rollup`` with the columns of ``facts`` beside each of its rows.

    ``facts`` has one row per ``on`` and ``null_too``, which are keys of the grain; a NULL meets a NULL
    in ``null_too`` and nothing in ``on``.  The rows are dealt out once: the exchange of the join, which
    adaptive execution splits for a hot key, has all rows of a group together.  Grouped first, wide rows
    would be dealt out for the grouping and again for the join.  ``how`` is ``left`` or ``inner``.
    """
    marks = {f"_null_or_{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in null_too}
    keys = [*on, *marks]
    named = [c for c in facts.columns if c not in (*on, *null_too)]
    packed = facts.select(*on, *(m.alias(c) for c, m in marks.items()), F.struct(*named).alias("_facts"))
    joined = join_totals(df.withColumns(marks) if marks else df, packed, keys, how, keep_salt=True)
    rolled = joined.groupBy(*spec.keys, *marks, "_salt").agg(*spec.aggregates(), F.first("_facts").alias("_facts"))
    own = [c for c in rolled.columns if c not in (*marks, "_salt", "_facts")]
    return rolled.select(*own, *(F.col("_facts").getField(c).alias(c) for c in named))


def distinct_then_sum(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], grain: Sequence[str] = ()
) -> DataFrame:
    """Sum measures over the distinct (key, grain, measures) tuples."""
    tuples = df.select(*dict.fromkeys([*keys, *grain, *measures])).distinct()
    return tuples.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))


def distinct_value_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum the distinct values of each measure on its own, all in one grouping."""
    return df.groupBy(*keys).agg(*(F.sum_distinct(F.col(m)).alias(m) for m in measures))


def distinct_text_sum(df: DataFrame, keys: Sequence[str], text: str, name: str) -> DataFrame:
    """Sum numbers stored as text, each distinct text once: ``1`` and ``1.0`` are two values.

    The cast comes after the deduplication; text that is no number counts as NULL.
    """
    texts = df.select(*keys, text).distinct()
    return texts.groupBy(*keys).agg(F.sum(F.col(text).try_cast("double")).alias(name))


def max_then_sum(
    df: DataFrame,
    outer: Sequence[str],
    inner: Sequence[str],
    measures: Sequence[str] | dict[str, str],
) -> DataFrame:
    """Maximum of each measure per inner grain, then the sum of those per outer grain."""
    named = RollupSpec._pairs(measures)
    grain = list(dict.fromkeys([*outer, *inner]))
    peak = df.groupBy(*grain).agg(*(F.max(s).alias(o) for o, s in named))
    return peak.groupBy(*outer).agg(*(F.sum(o).alias(o) for o, _ in named))


def presence_flag(df: DataFrame, key: str, cond: ColumnOrName, name: str) -> DataFrame:
    """Per key: 1 if any row meets the condition, otherwise NULL."""
    return df.groupBy(key).agg(F.max(F.when(as_column(cond), 1)).alias(name))


def ratio_of_counts(
    df: DataFrame, keys: Sequence[str], num: str, den: str, name: str, scale: float = 100
) -> DataFrame:
    """Distinct and plain count ratios of two columns: ``name`` and ``name + "_rows"``."""
    counts = df.groupBy(*keys).agg(
        F.count_distinct(num).alias("_dn"),
        F.count_distinct(den).alias("_dd"),
        F.count(num).alias("_n"),
        F.count(den).alias("_d"),
    )
    return counts.select(
        *keys,
        safe_ratio("_dn", "_dd", scale).alias(name),
        safe_ratio("_n", "_d", scale).alias(f"{name}_rows"),
    )


def attach_group_total(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] | dict[str, str],
    mask_null: bool = True,
    salts: int = 1,
    salt_by: Sequence[str] | None = None,
    prefix: str = "sum_",
    stage: Stage = no_stage,
) -> DataFrame:
    """Group totals next to every detail row.

    The totals are one combined aggregate joined back on the keys; a window would put all rows of
    a hot key into one task.  With few, large groups give ``salts``, which spreads each group over
    that many join keys.  ``mask_null=True`` leaves the total NULL where a key is NULL, as an
    equality join does; ``False`` treats NULL as a group of its own.  A ``stage`` that writes
    ``group_totals`` shows that they are few, so that the details are not shuffled for them.
    """
    if isinstance(measures, dict):
        named = list(measures.items())
    else:
        named = [(prefix + m, m) for m in measures]
    totals = stage(df.groupBy(*keys).agg(*(F.sum(s).alias(o) for o, s in named)), "group_totals")
    return join_totals(df, totals, keys, null_safe=not mask_null, salts=salts, salt_by=salt_by)


def flatten_hierarchy(
    df: DataFrame, key: str, levels: Sequence[str], coherent: bool = False
) -> DataFrame:
    """One row per key with its hierarchy levels."""
    spec = RollupSpec(keys=[key], attributes=list(levels))
    return wide_rollup(df.select(key, *levels), spec, coherent)

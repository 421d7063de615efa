"""Operators on hand-made frames: NULLs, ties, duplicates, fan-out, bad values."""

import pytest
from pyspark.sql import functions as F

from haulgrain.operators import dedupe, match, reshape, rollup
from haulgrain.operators.skew import join_totals
from haulgrain.operators.stage import checkpointed, persisted, written
from haulgrain.sources.sink import conform


def rows(df, *cols):
    got = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in got.collect()), key=lambda r: [(v is None, str(v)) for v in r])


# --- choosing rows --------------------------------------------------------------------------


def test_latest_n_periods_keeps_the_highest_keys(spark):
    weeks = [f"2020{w:02d}" for w in range(1, 16)]
    df = spark.createDataFrame([(w, i) for w in weeks for i in range(3)] + [(None, 0)], "w string, i int")
    kept = dedupe.latest_n_periods(df, "w", 13)
    assert {r[0] for r in rows(kept, "w")} == set(weeks[2:])
    assert kept.count() == 39


def test_latest_n_periods_keeps_null_only_among_the_latest(spark):
    df = spark.createDataFrame([("202001",), (None,), (None,)], "w string")
    assert dedupe.latest_n_periods(df, "w", 2).count() == 3
    assert dedupe.latest_n_periods(df, "w", 1).count() == 1
    with pytest.raises(ValueError):
        dedupe.latest_n_periods(df, "w", 0)


def test_latest_per_key_settles_ties(spark):
    data = [("a", "20200101", 1), ("a", "20200101", 2), ("a", None, 9), ("b", None, 3), ("b", "", 4)]
    df = spark.createDataFrame(data, "k string, ts string, v int")
    for parts in (1, 4):
        assert rows(dedupe.latest_per_key(df.repartition(parts), ["k"], ["ts"])) == [
            ("a", "20200101", 2),
            ("b", "", 4),
        ]


def test_dedupe_on_keys_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i % 5, i % 7, i) for i in range(100)], "k int, a int, b int")
    one = rows(dedupe.dedupe_on_keys(df.coalesce(1), ["k"]))
    assert one == rows(dedupe.dedupe_on_keys(df.repartition(7), ["k"]))
    assert len(one) == 5
    assert dedupe.dedupe_on_keys(df.select("k"), ["k"]).count() == 5


def test_final_ship_to_is_taken_before_the_stage_cut(spark):
    data = [("l", 1, "dc"), ("l", 2, "shop"), ("m", 1, "x")]
    df = spark.createDataFrame(data, "load string, stage int, ship_to string")
    final = dedupe.final_stage_attr(df, "load", "stage", ["ship_to"])
    assert rows(final) == [("l", "shop"), ("m", "x")]
    assert rows(dedupe.keep_min_stage(df, "load", "stage"), "ship_to") == [("dc",), ("x",)]


def test_keep_min_stage_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame([("l", 1), ("l", 1), ("l", 2), (None, 1)], "load string, stage int")
    assert rows(dedupe.keep_min_stage(df, "load", "stage")) == [("l", 1), ("l", 1)]


def test_text_stages_sort_wrongly_until_cast(spark):
    df = spark.createDataFrame([("l", "9"), ("l", "10")], "load string, stage string")
    assert df.agg(F.max("stage")).collect()[0][0] == "9"
    number = df.withColumn("stage", F.col("stage").try_cast("int"))
    assert number.agg(F.max("stage")).collect()[0][0] == 10


def test_children_are_dropped_and_null_keys_stay(spark):
    loads = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "load_id string")
    children = spark.createDataFrame([("2",), ("2",), (None,), ("9",)], "child string")
    assert rows(dedupe.drop_linked_children(loads, "load_id", children, "child")) == [("1",), (None,)]


def test_argmax_differs_from_independent_maxima(spark):
    data = [("l", 2, "20200101", "A"), ("l", 1, "20200202", "B")]
    df = spark.createDataFrame(data, "load string, stage int, ts string, ship_to string")
    apart = df.groupBy("load").agg(F.max("stage"), F.max("ts"), F.max("ship_to"))
    assert rows(apart) == [("l", 2, "20200202", "B")]
    together = dedupe.last_event_attr(df, ["load"], ["stage", "ts"], ["ship_to"])
    assert rows(together) == [("l", 2, "20200101", "A")]


def test_first_event_takes_maxima_at_the_first_moment(spark):
    data = [("l", 1, 5, 1), ("l", 1, 3, None), ("l", 2, 99, 99), ("m", None, 7, 7)]
    df = spark.createDataFrame(data, "load string, ts int, a int, b int")
    assert rows(dedupe.first_event(df, ["load"], "ts", ["a", "b"])) == [
        ("l", 1, 5, 1),
        ("m", None, None, None),
    ]


# --- aggregates -----------------------------------------------------------------------------


def test_rollup_roles_and_coherent_rows(spark):
    data = [("k", 1, "z", 1.0), ("k", 2, "a", 3.0)]
    df = spark.createDataFrame(data, "key string, lvl int, name string, qty double")
    spec = rollup.RollupSpec(["key"], attributes=["lvl", "name"], sums={"total": "qty"}, row_count="n")
    assert rows(rollup.wide_rollup(df, spec)) == [("k", 2, "z", 4.0, 2)]
    assert rows(rollup.wide_rollup(df, spec, coherent=True)) == [("k", 2, "a", 4.0, 2)]
    filled = rollup.RollupSpec(["key"], sums=["qty"]).with_remaining_attributes(df, exclude=["lvl"])
    assert rollup.wide_rollup(df, filled).columns == ["key", "name", "qty"]


def test_distinct_tuples_and_distinct_values(spark):
    data = [("l", 1.0, 2.0), ("l", 1.0, 2.0), ("l", 1.0, 3.0), ("l", None, 3.0)]
    df = spark.createDataFrame(data, "load string, a double, b double")
    assert rows(rollup.distinct_then_sum(df, ["load"], ["a", "b"])) == [("l", 2.0, 8.0)]
    assert rows(rollup.distinct_value_sum(df, ["load"], ["a", "b"])) == [("l", 1.0, 5.0)]


def test_distinct_texts_are_summed_after_the_cast(spark):
    df = spark.createDataFrame([("l", "1"), ("l", "1.0"), ("l", "1"), ("l", "abc")], "load string, t string")
    assert rows(rollup.distinct_text_sum(df, ["load"], "t", "units")) == [("l", 2.0)]


def test_max_then_sum(spark):
    data = [("l", "i", 1.0), ("l", "i", 4.0), ("l", "j", 2.0), ("l", "k", None)]
    df = spark.createDataFrame(data, "load string, item string, q double")
    assert rows(rollup.max_then_sum(df, ["load"], ["item"], ["q"])) == [("l", 6.0)]


def test_group_total_of_null_keys(spark):
    df = spark.createDataFrame([(1, "u", 2.0), (2, "u", 3.0), (3, None, 5.0)], "i int, unit string, q double")
    for salts in (1, 4):
        masked = rollup.attach_group_total(df, ["unit"], ["q"], salts=salts)
        assert rows(masked, "i", "sum_q") == [(1, 5.0), (2, 5.0), (3, None)]
        kept = rollup.attach_group_total(df, ["unit"], ["q"], mask_null=False, salts=salts, salt_by=["i"])
        assert rows(kept, "i", "sum_q") == [(1, 5.0), (2, 5.0), (3, 5.0)]


def test_ratio_of_counts_is_null_without_a_denominator(spark):
    df = spark.createDataFrame([("l", "a", None), ("m", None, "b"), ("m", "a", "b")], "k string, n string, d string")
    assert rows(rollup.ratio_of_counts(df, ["k"], "n", "d", "pct")) == [
        ("l", None, None),
        ("m", 100.0, 50.0),
    ]


# --- joins ----------------------------------------------------------------------------------


def test_lookup_never_multiplies_rows(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 7), ("c", 3), (None, 9)], "code string, v int")
    assert rows(match.lookup(facts, dim, {"k": "code"}, ["v"])) == [
        ("a", 7),
        ("a", 7),
        ("b", None),
        (None, None),
    ]
    safe = match.lookup(facts, dim, {"k": "code"}, {"w": "v"}, null_safe=True)
    assert rows(safe)[-1] == (None, 9)


def test_join_totals_refuses_ambiguous_columns(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="both sides"):
        join_totals(df, df, ["k"])


def _matched(spark, **options):
    facts = spark.createDataFrame(
        [("o1", "z1", 5), ("o2", "z1", 2), ("o3", "z1", 3), ("o4", "z9", 1), (None, "z1", 4)],
        "origin string, zone string, cnt int",
    )
    ref = spark.createDataFrame(
        [("o1", "z1", 10), ("o8", "z1", 11)], "origin string, zone string, cost int"
    )

    def regroup(rest):
        return rest.groupBy("zone").agg(F.max("cnt").alias("cnt"))

    out = match.fallback_match(facts, ref, ["origin"], ["zone"], regroup=regroup, **options)
    return rows(out, "zone", "cnt", "cost", "match_tier")


def test_fallback_emits_each_fact_in_one_tier(spark):
    assert _matched(spark) == [
        ("z1", 4, 10, 2),
        ("z1", 4, 11, 2),
        ("z1", 5, 10, 1),
        ("z9", 1, None, 0),
    ]


def test_fallback_with_duplicates_counts_unmatched_twice(spark):
    extra = [("z1", 2, None, 0), ("z1", 3, None, 0), ("z1", 4, None, 0), ("z9", 1, None, 0)]
    assert sorted(_matched(spark, keep_duplicates=True), key=str) == sorted(
        [*_matched(spark), *extra], key=str
    )


def test_override_by_list_and_by_table(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("y", 1.0, 2.0), (None, 1.0, 2.0)], "k string, a double, b double")
    listed = spark.createDataFrame([("x",), ("x",)], "name string")
    for source in (["x"], listed):
        got = match.override_for(df, "k", source, "r", "a", "b")
        assert rows(got, "k", "r") == [("x", 1.0), ("y", 2.0), (None, 2.0)]


def test_bridge_drops_rows_without_a_hop(spark):
    a = spark.createDataFrame([("o1", "t1"), ("o2", "t9")], "order string, truck string")
    b = spark.createDataFrame([("t1", "big")], "code string, kind string")
    assert rows(match.bridge(a, [(b, {"truck": "code"})]), "order", "kind") == [("o1", "big")]


# --- reshaping, sinks, stages ---------------------------------------------------------------


def test_unpivot_example(spark):
    df = spark.createDataFrame([(1, 0.1, 4.0), (2, 0.6, 10.0), (3, None, 1.0)], "id int, col1 double, col2 double")
    assert rows(reshape.unpivot_measures(df, ["id"])) == [
        (1, "col1", 0.1),
        (1, "col2", 4.0),
        (2, "col1", 0.6),
        (2, "col2", 10.0),
        (3, "col1", None),
        (3, "col2", 1.0),
    ]
    mixed = df.withColumn("col2", F.col("col2").cast("string"))
    with pytest.raises(TypeError):
        reshape.unpivot_measures(mixed, ["id"])


def test_union_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    assert rows(reshape.union_all([a, a.select("s", "i")])) == [(1, "x"), (1, "x")]


def test_conform(spark):
    df = spark.createDataFrame([("7", "abc", 1)], "A string, b string, extra int")
    schema = "b INT, a DECIMAL(9,2)"
    out = conform(df, schema)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "decimal(9,2)"]
    assert out.collect()[0][0] is None and float(out.collect()[0][1]) == 7.0
    with pytest.raises(Exception):
        conform(df, schema, on_bad="error").collect()
    with pytest.raises(ValueError, match="missing"):
        conform(df, "zzz INT")
    assert conform(df, "zzz INT", fill_missing=True).collect()[0][0] is None
    with pytest.raises(ValueError, match="ambiguous"):
        conform(df.join(df.select(F.col("A").alias("a2"), F.col("b").alias("B"))), "b INT")


def test_stages_do_not_change_rows(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    for stage in (persisted, checkpointed, written(spark), written(spark, "other")):
        assert rows(stage(df, "numbers")) == rows(df)
    df.unpersist()

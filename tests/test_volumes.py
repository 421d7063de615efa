"""How often wide rows are shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from haulgrain.operators.dedupe import latest_n_periods
from haulgrain.operators.match import fallback_match, lookup
from haulgrain.operators.rollup import RollupSpec, rollup_beside, rollup_of_repeated, wide_rollup
from haulgrain.operators.skew import join_totals
from haulgrain.operators.stage import Bucketed, _joined_as_dealt, buckets_for, written
from haulgrain.plans import fill_hub, fill_load, scorecard, tender
from haulgrain.session import tune
from haulgrain.sources.versions import publish
from haulgrain.testbed import queries as q
from haulgrain.testbed.frames import frame, frames

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    tune(spark)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rollup_of_repeated_shuffles_its_rows_once(spark, no_broadcast):
    rows = spark.range(400).select((F.col("id") % 300).cast("string").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    text = final_plan(rollup_of_repeated(rows, RollupSpec(["k"], attributes=["t"])))
    assert text.count("concat(t") == 1  # the rows as they are


def test_a_staged_lookup_is_broadcast_from_the_start(spark):
    """A small dimension whose size Spark only guesses, high above the threshold."""
    code = F.col("id").cast("string")
    dim = spark.range(1000).join(spark.range(1000).withColumnRenamed("id", "i"), F.col("id") == F.col("i")).select(code.alias("code"), "i")
    facts = spark.range(5_000_000).select(code.alias("code"))

    def planned(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    assert "SortMergeJoin" in planned(lookup(facts, dim, ["code"], ["i"]).select("i"))
    staged = lookup(facts, dim, ["code"], ["i"], stage=written(spark))
    assert "SortMergeJoin" not in planned(staged) and "BroadcastHashJoin" in planned(staged)
    assert staged.count() == 5_000_000 and staged.where("i IS NOT NULL").count() == 1000


def test_promises_come_with_the_load(spark):
    text = q.QUERIES["mart_on_time"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join LeftOuter" in line]
    assert joins and not any("profl_method_code" in line for line in joins)


def test_distinct_after_a_join_on_the_load_needs_no_exchange(spark, no_broadcast):
    items = spark.range(100).select((F.col("id") % 10).cast("string").alias("load"), F.lit("x").alias("a"))
    loads = spark.range(10).select(F.col("id").cast("string").alias("load"), "id")
    text = final_plan(join_totals(items, loads, ["load"], "inner", keep_salt=True).distinct().drop("_salt"))
    assert len([line for line in text.split("\n") if "Exchange" in line]) == 2


def test_buckets_grow_with_the_rows():
    assert buckets_for(0) == buckets_for(2_000_000) == 8
    assert buckets_for(36_000_000) == 144


def test_few_keys_of_a_spread_match_use_many_tasks(spark, no_broadcast):
    facts = spark.range(600).select(F.when(F.col("id") >= 0, "n").otherwise("m").alias("k"), (F.col("id") % 2).alias("c"), "id")
    ref = spark.createDataFrame([("n", 0, "r1"), ("n", 1, "r2"), ("m", 1, "r3")], "k string, c bigint, r string")
    plain = fallback_match(facts, ref, ["k"], ["c"])
    wide = fallback_match(facts, ref, ["k"], ["c"], spread=16)
    assert sorted(map(str, wide.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [d.where("match_tier = 1").select(F.spark_partition_id()).distinct().count() for d in (plain, fallback_match(facts, ref, ["k"], ["c"], spread=16))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks[0] == 1 and tasks[1] > 3


def test_items_with_their_lane_are_grouped_by_order_without_a_further_exchange(spark, no_broadcast):
    """The last join deals the items out by order, and the rollup works inside its parts."""
    plan = q.wide_rollup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("SortMergeJoin [l_orderkey")]


def test_parts_of_a_shuffle_stay_small(spark):
    """About 100 MB on 8 cores: a part per core would be larger than ``session.PART``."""
    tune(spark)
    rows = spark.range(4_000_000).select(*(F.xxhash64(F.col("id") + i).alias(f"c{i}") for i in range(3)))
    assert rows.repartition("c0").rdd.getNumPartitions() >= 11


def test_latest_weeks_are_cut_before_the_joins(spark, no_broadcast):
    items, orders = q.table(spark, SF, "lineitem"), q.table(spark, SF, "orders")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select(F.year("l_shipdate").alias("y"), "o_orderdate")
    kept = latest_n_periods(joined, "y", 2)
    text = kept._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert "scalar-subquery" in text.split("Relation")[0]
    last = joined.agg(F.max("y")).first()[0]
    assert kept.count() == joined.where(F.col("y") >= last - 1).count()


def test_methods_hotspot_does_not_compile_are_not_generated(spark):
    assert int(tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_week_of_the_fill_rows_is_computed_once_a_row(spark):
    seen = {}

    def stage(df, name):
        seen[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return spark.createDataFrame(df.limit(5).collect(), df.schema)

    scorecard.build(*frames(spark, SF, "tender_weekly", "on_time_view", "loading_view", "fill_view"), stage=stage)
    for name in ("loading_facts", "fill_facts"):
        assert "isnotnull(concat" not in seen[name]


def test_stops_meet_the_loads_before_the_lanes_repeat_them(spark):
    """Ten lanes a load: the stops are looked up per load, in the columns and rows of a plain join."""
    day = F.to_date(F.lit("1998-05-05"))
    loads = spark.range(20).select(
        F.col("id").cast("string").alias("load_id"),
        day.alias("actual_goods_issue_date"),
        F.lit("A").alias("origin_zone_ship_from_code"),
        F.lit("B").alias("dest_ship_from_code"),
        F.when(F.col("id") > 4, (F.col("id") % 3).cast("string")).alias("final_stop_postal_code"),
    )
    lanes = spark.range(10).select(
        F.col("id").alias("accept_cnt"),
        day.alias("week_begin_date"),
        F.lit("A").alias("origin_zone_ship_from_code"),
        F.lit("B").alias("dest_ship_from_code"),
    )
    stops = spark.createDataFrame([("0", "x"), ("0", "y"), ("1", "z"), (None, "n")], "postal_code string, stop_name string")
    for repeat, rows in ((False, 200), (True, 250)):
        found = tender.shipments(loads, lanes, stops, repeat_stops=repeat)
        joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in line]
        assert "Join Inner" in joins[0] and any("LeftOuter" in j for j in joins[1:])
        assert found.count() == rows
        lead = "final_stop_postal_code,concat_week_year" if repeat else "concat_week_year"
        assert ",".join(found.columns).startswith(lead) and found.columns[-2:] == ["stop_name", "last_update_utc_tmstp"]
        assert found.where("final_stop_postal_code IS NULL AND stop_name IS NOT NULL").count() == 0


def test_a_partitioned_target_has_few_files(spark, tmp_path):
    tune(spark)
    rows = spark.range(0, 4000, 1, 16).select((F.col("id") % 20).cast("string").alias("week"), "id")
    path = publish(rows, str(tmp_path / "t"), ["week"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 20
    assert spark.read.parquet(path).count() == 4000


def dealt_out_with(df, column):
    """Number of exchanges whose rows have this column."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return len([x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text) if re.search(rf"\b{column}#", x)])


def test_orders_are_dealt_out_once_with_all_their_columns(spark):
    built = q.build_on_time(spark, SF, lookups=written(spark))
    assert dealt_out_with(built, "frt_type_desc") == 1


def test_items_of_the_load_rollup_are_dealt_out_once_with_all_their_columns(spark, no_broadcast):
    hub = written(spark)(q.build_fill_hub(spark, SF), "hub")
    built = fill_load.build(hub, frame(spark, SF, "unit_costs"))
    assert dealt_out_with(built, "ship_cond_desc") == 1


def test_rollup_beside_facts_is_the_rollup_joined_with_them(spark):
    rows = [(k, s, t, n) for i, (k, s) in enumerate([("a", "x"), ("a", None), ("a", ""), ("b", "x"), (None, "x"), (None, None)]) for t, n in (("p", i), ("q", 2 * i), ("q", 2 * i))]
    df = spark.createDataFrame(rows, "k string, s string, t string, n int")
    facts = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("c", "x", 3), (None, "x", 4)], "k string, s string, f int")
    spec = RollupSpec(["k", "s"], attributes=["t"], sums=["n"])
    plain = wide_rollup(df, spec).alias("l")
    for how in ("left", "inner"):
        met = (F.col("l.k") == F.col("r.k")) & F.col("l.s").eqNullSafe(F.col("r.s"))
        wanted = plain.join(facts.alias("r"), met, how).select("l.*", "f")
        got = rollup_beside(df, spec, facts, ["k"], ["s"], how)
        assert got.columns == wanted.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_bucketed_items_are_dealt_out_once_with_all_their_columns(spark, no_broadcast):
    seen = {}

    class Looking(Bucketed):
        def __call__(self, df, name):
            with _joined_as_dealt(spark):
                seen[name] = dealt_out_with(self.dealt(df, name), "ship_cond_desc")
            return df

    stage = Looking(spark, {name: ["load_id"] for name in q.BY_LOAD}, 5)
    fill_hub.by_load(*frames(spark, SF, *q.BY_LOAD_SOURCES), stage=stage)
    assert seen["items"] == 1
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"

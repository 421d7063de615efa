"""Physical plans, grains and skewed data."""

import pytest
from pyspark.sql import functions as F

from haulgrain.operators import dedupe, match, rollup
from haulgrain.plans import fill_hub, on_time, scorecard, tender
from haulgrain.session import tune
from haulgrain.testbed import queries as q
from haulgrain.testbed.frames import frame, frames, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_joins_are_anti_joins(spark):
    assert "LeftAnti" in plan(q.QUERIES["exclude_children"](spark, SF))


def test_latest_periods_run_no_window_over_facts(spark):
    items = table(spark, SF, "lineitem")
    text = plan(dedupe.latest_n_periods(items, F.year("l_shipdate"), 2))
    assert "TakeOrderedAndProject" in text and "Window" not in text
    assert "SinglePartition" not in text.split("TakeOrdered")[0]


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    events = table(spark, SF, "events")
    text = plan(dedupe.latest_per_key(events, ["user_id"], ["ts"], ["event_id"]))
    assert "Partial" in text and "WindowGroupLimit" in text
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_aggregates_are_combined_before_the_shuffle(spark):
    items = table(spark, SF, "lineitem")
    total = rollup.max_then_sum(items, ["l_orderkey"], ["l_linenumber"], ["l_quantity"])
    assert plan(total).count("partial_") >= 2


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(q.QUERIES["keep_min_stage"](spark, SF))
    assert "l_extendedprice" not in text
    filtered = plan(q.QUERIES["filter_category"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in filtered


def test_no_plan_has_a_cross_join(spark):
    for name in ("mart_on_time", "mart_scorecard", "mart_tender_shipments", "mart_loading"):
        text = plan(q.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


# --- grains ---------------------------------------------------------------------------------


def test_on_time_is_unique_on_its_keys(spark):
    result = q.build_on_time(spark, SF).cache()
    assert result.count() == result.select(*on_time.KEYS).distinct().count()
    assert result.filter("load_id IS NULL OR parent_loc_code = ''").count() == 0
    result.unpersist()


def test_hub_keeps_one_row_per_item_and_reconciles_with_the_rollup(spark):
    hub = q.build_fill_hub(spark, SF).cache()
    items = fill_hub.normalize_items(frame(spark, SF, "delivery_items"))
    first = dedupe.keep_min_stage(items, "load_id", "trans_stage_num")
    expected = first.distinct()
    assert expected.filter("load_gbu_id IS NULL").count() > 0
    assert hub.count() == expected.count()
    rolled = q.QUERIES["mart_fill_load"](spark, SF)
    a = hub.agg(F.sum("net_weight_qty"), F.sum("total_vf_optny_amt").cast("double")).collect()[0]
    b = rolled.agg(F.sum("net_weight_qty"), F.sum("total_vf_optny_amt")).collect()[0]
    assert tuple(a) == pytest.approx(tuple(b))
    keys = rolled.select("load_id", "load_gbu_id", "gbu_code", "gbu_desc")
    assert keys.count() == keys.distinct().count()
    hub.unpersist()


def test_scorecard_emits_every_exact_fact_once(spark):
    tender_rows, view = frames(spark, SF, "tender_weekly", "on_time_view")
    facts = scorecard.on_time_facts(view)
    matched = match.fallback_match(
        facts,
        scorecard.tender_facts(tender_rows),
        scorecard.EXACT,
        scorecard.COARSE,
        regroup=scorecard.regroup_to_lane,
    )
    rest = facts.join(scorecard.tender_facts(tender_rows), scorecard.EXACT, "left_anti")
    assert matched.filter("match_tier = 1").count() == facts.count() - rest.count()


def test_formula_overrides_reach_the_result(spark):
    built = q.build_on_time(spark, SF, formulas={"gbu_code": "'MINE'", "lot_delay_code": "'D'"})
    assert [tuple(r) for r in built.select("gbu_code", "lot_delay_code").distinct().collect()] == [
        ("MINE", "D")
    ]


def test_null_safe_keys_and_week_only_join(spark):
    strict = q.build_on_time(spark, SF).filter("cust_po_num IS NULL AND load_lvl_on_time_pct IS NOT NULL")
    loose = q.build_on_time(spark, SF, null_safe_keys=True)
    assert strict.count() == 0
    assert loose.filter("cust_po_num IS NULL AND load_lvl_on_time_pct IS NOT NULL").count() > 0
    costs, summary, locations = frames(spark, SF, "load_costs", "tender_summary", "locations")
    lanes = tender.lanes(summary)
    by_lane = tender.shipments(costs, lanes, locations).count()
    assert tender.shipments(costs, lanes, locations, match_on=()).count() > by_lane


# --- one key holds a third of the rows ------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000)
    return spark.range(300_000, numPartitions=8).select(
        hot.alias("k"), (F.col("id") % 97).alias("stage"), (F.col("id") % 11).cast("double").alias("q"), "id"
    )


def test_hot_group_totals_use_several_tasks(spark, skewed):
    out = rollup.attach_group_total(skewed, ["k"], ["q"], salts=8, salt_by=["id"])
    assert out.count() == 300_000
    hot = out.filter("k = -1").agg(F.min("sum_q"), F.max("sum_q")).collect()[0]
    assert hot[0] == hot[1] == skewed.filter("k = -1").agg(F.sum("q")).collect()[0][0]


def test_hot_key_sends_few_rows_to_the_rank(spark, skewed):
    latest = dedupe.latest_per_key(skewed, ["k"], ["stage"], ["id"])
    assert latest.count() == skewed.select("k").distinct().count()
    row = latest.filter("k = -1").collect()[0]
    best = skewed.filter("k = -1").agg(F.max(F.struct("stage", "id"))).collect()[0][0]
    assert (row.stage, row.id) == (best.stage, best.id)


# Thresholds as small as the test data, so that adaptive execution meets them.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
}


@pytest.fixture
def small_scale(spark):
    tune(spark)
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    for k, v in SMALL_SCALE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_of_a_lookup_is_split(spark, skewed, small_scale):
    dim = spark.range(-1, 1000).select(F.col("id").alias("code"), (F.col("id") * 2).alias("v"))
    joined = match.lookup(skewed, dim, {"k": "code"}, ["v"])
    got = joined.agg(F.count("v"), F.sum(F.col("v") - 2 * F.col("k")))
    assert tuple(got.collect()[0]) == (300_000, 0)
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_hot_key_of_an_anti_join_is_split(spark, skewed, small_scale):
    children = skewed.filter("k > 5").select(F.col("k").alias("child"))
    rest = dedupe.drop_linked_children(skewed, "k", children, "child")
    assert len(rest.collect()) == skewed.filter("k <= 5").count()
    assert "SortMergeJoin(skew=true)" in plan(rest)


def test_hot_key_of_a_stage_cut_is_split(spark, skewed, small_scale):
    first = dedupe.keep_min_stage(skewed, "k", "q")
    hot = [r for r in first.collect() if r.k == -1]
    assert {r.q for r in hot} == {0.0}
    assert len(hot) == skewed.filter("k = -1 AND q = 0").count()


def test_hot_group_is_split_by_salts_alone(spark, skewed, small_scale):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = rollup.attach_group_total(skewed, ["k"], ["q"], salts=16, salt_by=["id"])
        tasks = out.filter("k = -1").select(F.spark_partition_id().alias("p")).distinct()
        assert tasks.count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- passes over the facts --------------------------------------------------------------------


def scans(df, table_name):
    return plan(df).count(f"/{table_name}.parquet")


def test_staged_scorecard_reads_its_facts_once(spark):
    """After the staged match no plan of the result reads the on-time facts, and tender rows only once more."""
    read = []

    def stage(df, name):
        if name == "fallback_matched":
            read.append((scans(df, "lineitem"), plan(df)))
            return spark.createDataFrame(df.limit(5).collect(), df.schema)
        return df

    sources = frames(spark, SF, "tender_weekly", "on_time_view", "loading_view", "fill_view")
    built = scorecard.build(*sources, stage=stage)
    assert [n for n, _ in read] == [2]  # on-time facts and tender rows
    assert "LeftAnti" not in read[0][1]
    assert scans(built, "lineitem") == 3  # tender rows, loading and fill facts


def test_lane_counts_reconcile(spark):
    sources = frames(spark, SF, "tender_weekly", "on_time_view")
    facts = scorecard.on_time_facts(sources[1])
    rest = facts.join(scorecard.tender_facts(sources[0]), scorecard.EXACT, "left_anti")
    total = F.sum("shpmt_cnt")
    assert scorecard.regroup_to_lane(rest).agg(total).first() == rest.agg(total).first()
    assert scorecard.regroup_to_lane(rest, "max").agg(total).first()[0] < rest.agg(total).first()[0]


def test_staged_on_time_reads_the_events_once(spark):
    read = []

    def stage(df, name):
        read.append(scans(df, "lineitem"))
        return spark.createDataFrame(df.limit(5).collect(), df.schema)

    built = q.build_on_time(spark, SF, stage=stage)
    assert read == [1] and scans(built, "lineitem") == 1  # the freight statistics


def test_hub_joins_the_cut_items_once_on_the_load(spark):
    """The rows handed on as ``prepared`` meet per-load results in a single join."""
    shuffled = []

    def stage(df, name):
        shuffled.append(name)
        return spark.createDataFrame(df.limit(5).collect(), df.schema)

    sources = frames(spark, SF, *q.HUB_SOURCES)
    built = fill_hub.build(*sources, stage=stage)
    assert shuffled == ["items", "costs", "loads", "prepared", "valued"]
    assert built.columns


def test_hub_options_for_null_keys_and_trucks(spark):
    sources = frames(spark, SF, *q.HUB_SOURCES)
    kept = fill_hub.build(*sources)
    dropped = fill_hub.build(*sources, keep_null_keys=False)
    assert kept.filter("load_gbu_id IS NULL").count() > 0
    assert dropped.filter("load_gbu_id IS NULL").count() == 0
    assert fill_hub.build(*sources, one_truck=False).count() >= kept.count()


@pytest.mark.parametrize("build", [on_time.build, fill_hub.build, scorecard.build])
def test_unknown_formulas_are_refused(spark, build):
    names = {on_time.build: 6, fill_hub.build: 12, scorecard.build: 4}
    with pytest.raises(ValueError, match="unknown formulas"):
        build(*[table(spark, SF, "nation")] * names[build], formulas={"no_such_column": "1"})


def test_largest_order_leaves_smaller_orders_of_listed_customers_without_a_percentage(spark):
    built = q.build_on_time(spark, SF, largest_order_only=True)
    listed = built.filter("customer_desc IN ('BUILDING', 'MACHINERY') AND load_lvl_on_time_pct IS NULL")
    known = " AND ".join(f"{k} IS NOT NULL" for k in on_time.KEYS)
    rows = listed.filter(known)
    assert rows.count() > 0 and rows.filter("actual_on_time_pct IS NOT NULL").count() == 0

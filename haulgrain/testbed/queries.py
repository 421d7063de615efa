"""Queries over the test tables, one per operator and plan: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import jobs
from ..functions import keys as k
from ..functions import periods as p
from ..functions import rules as r
from ..functions import formulas as fx
from ..functions.formulas import apply_formulas
from ..operators import dedupe, match, reshape, rollup
from ..operators.figures import Figures, fan_out
from ..operators.skew import join_totals
from ..operators.stage import Bucketed, buckets_for, shared_folder, written
from ..plans import fill_hub, fill_load, loading, on_time, scorecard, tender
from ..session import tune
from ..sources.catalog import SourceCatalog, read_source
from ..sources.sink import conform, overwrite_table
from ..sources.versions import publish, read_current, read_newest
from .frames import FRAMES, frame, frames, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

OVERRIDE_CUSTOMERS = ["BUILDING", "MACHINERY"]


def query(fn: Query) -> Query:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = tuned
    return fn


def _money(c: str) -> Column:
    """Amounts are summed as decimals, so that the result does not depend on the order."""
    return F.col(c).cast("decimal(18,2)")


# --- keys and periods -----------------------------------------------------------------------


@query
def key_strip_zeros(spark, sf):
    raw = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        k.normalize_key(raw).alias("all_zeros"),
        k.normalize_key(raw, keep_zero=True).alias("all_but_one"),
        k.normalize_key(raw, mode="one").alias("one_zero"),
    )


@query
def key_tail_pad(spark, sf):
    ten = k.padded_key("o_orderkey", 10)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        ten.alias("ten_digits"),
        k.tail_key(ten, 9).alias("last_nine"),
        k.padded_key("o_orderkey", 3).alias("not_cut"),
    )


def _lanes(spark, sf) -> DataFrame:
    """Line items with origin and destination nation."""
    nation = table(spark, sf, "nation")
    origin = table(spark, sf, "supplier").join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin")),
        "s_nationkey",
    )
    dest = table(spark, sf, "customer").join(
        nation.select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("n_name").alias("dest"),
            F.col("n_regionkey").alias("dest_region"),
        ),
        "c_nationkey",
    )
    # the order comes last: its join leaves the items dealt out by it, as a grouping by order needs them
    orders = match.bridge(
        table(spark, sf, "orders"),
        [(dest.select("c_custkey", "dest", "dest_region"), {"o_custkey": "c_custkey"})],
    )
    return match.bridge(
        table(spark, sf, "lineitem"),
        [
            (origin.select("s_suppkey", "origin"), {"l_suppkey": "s_suppkey"}),
            (orders, {"l_orderkey": "o_orderkey"}),
        ],
    )


@query
def lane_key(spark, sf):
    lanes = _lanes(spark, sf).withColumn("lane", k.composite_key("origin", "dest"))
    return lanes.groupBy("lane").agg(
        F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity")
    )


def _orders_per_week(spark, sf, year_mode, style):
    orders = table(spark, sf, "orders")
    week = p.year_week_key("o_orderdate", style=style, year_mode=year_mode)
    return orders.groupBy(week.alias("week")).agg(F.count(F.lit(1)).alias("orders"))


@query
def year_week_iso(spark, sf):
    return _orders_per_week(spark, sf, "iso", "yyyyww")


@query
def year_week_calendar(spark, sf):
    return _orders_per_week(spark, sf, "calendar", "ww/yyyy")


@query
def parse_date_time(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "dd/MM/yyyy").alias("d"),
        F.date_format("ts", "HH:mm:ss").alias("t"),
        F.date_format("ts", "dd.MM.yyyy").alias("dotted"),
    )
    broken = F.when(F.col("d").startswith("13"), F.lit("99/99/2020")).otherwise(F.col("d"))
    return events.select(
        "event_id",
        F.date_format(p.parse_date_time("d", "t"), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        F.date_format(p.parse_date_time(broken, "t"), "yyyy-MM-dd HH:mm:ss").alias("bad_is_null"),
        F.date_format(p.parse_dmy("dotted"), "yyyy-MM-dd").alias("by_position"),
    )


@query
def latest_n_weeks(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("week", p.year_week_key("l_shipdate"))
    recent = dedupe.latest_n_periods(items, "week", 13)
    return recent.groupBy("week", "l_suppkey").agg(
        F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity")
    )


# --- filters --------------------------------------------------------------------------------


@query
def filter_category(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "P", ""))
    building = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return orders.join(building, orders["o_custkey"] == building["c_custkey"], "inner").select(
        "o_orderkey", "o_orderstatus", "c_name"
    )


@query
def filter_nonblank_sentinel(spark, sf):
    """Event texts with blanks, one-character values, the text NULL, real NULLs and a sentinel."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", "")
        .when(kind == "click", "x")
        .when(kind == "error", "NULL")
        .when(kind == "signup", F.lit(None).cast("string"))
        .otherwise(kind)
    )
    stamp = F.when(F.col("value") < 5, p.EVENT_STAMP_SENTINEL).otherwise(
        F.date_format("ts", p.EVENT_STAMP_FORMAT)
    )
    events = table(spark, sf, "events").select(
        "event_id", "event_type", text.alias("label"), stamp.alias("stamp")
    )
    events = events.filter(r.not_sentinel("stamp", p.EVENT_STAMP_SENTINEL))
    return events.select(
        "event_id",
        "event_type",
        "stamp",
        F.when(r.non_blank("label"), 1).otherwise(0).alias("has_text"),
        F.when(r.not_text_null("label"), 1).otherwise(0).alias("not_null_text"),
    ).filter("has_text = 1 OR not_null_text = 1")


@query
def filter_measurable(spark, sf):
    rows = frame(spark, sf, "on_time_events")
    dates = ["schedule_date", "tender_date", "first_dlvry_appt_date"]
    kept = rows.filter(r.measurable("sd_doc_item_overall_process_status_val", dates))
    return kept.groupBy("load_id").agg(F.count(F.lit(1)).alias("measurable_rows"))


# --- choosing rows --------------------------------------------------------------------------


@query
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedupe.latest_per_key(events, ["user_id", "event_type"], ["ts"], ["event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


@query
def keep_min_stage(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dedupe.keep_min_stage(items, "l_orderkey", "l_linenumber")


@query
def final_stage_attr(spark, sf):
    items = table(spark, sf, "lineitem")
    return dedupe.final_stage_attr(items, "l_orderkey", "l_linenumber", ["l_suppkey", "l_quantity"])


@query
def exclude_children(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return dedupe.drop_linked_children(orders, "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


@query
def dedupe_on_keys(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey", "l_extendedprice"
    )
    return dedupe.dedupe_on_keys(items, ["l_orderkey", "l_linenumber"])


@query
def first_event_attrs(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return dedupe.first_event(events, ["user_id", "event_type"], "day", ["event_id", "value"])


@query
def independent_max_vs_argmax(spark, sf):
    """Highest stage, supplier and quantity of each order, apart and from one row."""
    items = table(spark, sf, "lineitem")
    apart = items.groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("max_stage"),
        F.max("l_suppkey").alias("max_supplier"),
        F.max("l_quantity").alias("max_quantity"),
    )
    together = dedupe.last_event_attr(
        items, ["l_orderkey"], ["l_linenumber"], ["l_suppkey", "l_quantity"]
    ).select(
        "l_orderkey",
        F.col("l_suppkey").alias("last_supplier"),
        F.col("l_quantity").alias("last_quantity"),
    )
    return apart.join(together, "l_orderkey")


# --- aggregates -----------------------------------------------------------------------------


@query
def wide_rollup(spark, sf):
    """Items per order: attributes by maximum, sums, a mean, a minimum and counts."""
    items = _lanes(spark, sf).withColumn("price", _money("l_extendedprice"))
    spec = rollup.RollupSpec(
        ["l_orderkey"],
        attributes=["o_orderpriority", "o_orderstatus", "origin", "dest", "l_returnflag"],
        minima={"first_stage": "l_linenumber"},
        sums={"quantity": "l_quantity", "price": "price"},
        means={"mean_quantity": "l_quantity"},
        distinct_counts={"suppliers": "l_suppkey"},
        row_count="items",
    )
    return rollup.wide_rollup(items, spec).withColumn("price", F.col("price").cast("double"))


@query
def wide_rollup_coherent(spark, sf):
    spec = rollup.RollupSpec(
        ["l_orderkey"],
        attributes=["l_linenumber", "l_returnflag", "l_suppkey"],
        sums={"quantity": "l_quantity"},
    )
    return rollup.wide_rollup(table(spark, sf, "lineitem"), spec, coherent=True)


@query
def distinct_then_sum(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", _money("l_extendedprice").alias("price")
    )
    sums = rollup.distinct_then_sum(items, ["l_orderkey"], ["l_quantity", "price"])
    return sums.withColumn("price", F.col("price").cast("double"))


@query
def distinct_value_sum(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("stage", F.col("l_linenumber").cast("double"))
    return rollup.distinct_value_sum(items, ["l_suppkey"], ["l_quantity", "stage", "l_partkey"])


@query
def distinct_text_sum(spark, sf):
    stats = frame(spark, sf, "freight_stats")
    stats = stats.withColumn("load_id", k.normalize_key("shpmt_id", mode="one"))
    return rollup.distinct_text_sum(stats, ["load_id"], "su_per_load_qty", "units")


@query
def max_then_sum(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("price", _money("l_extendedprice"))
    sums = rollup.max_then_sum(
        items,
        ["l_orderkey"],
        ["l_orderkey", "l_linenumber"],
        {"quantity": "l_quantity", "price": "price"},
    )
    return sums.withColumn("price", F.col("price").cast("double"))


@query
def presence_flag(spark, sf):
    """Orders with a returned item, and the presence of the key itself."""
    items = table(spark, sf, "lineitem")
    flags = rollup.presence_flag(items, "l_orderkey", F.col("l_returnflag") == "R", "returned")
    return flags.withColumn("present", r.presence("l_orderkey"))


@query
def ratio_pct(spark, sf):
    """Share of finished orders that came on time per customer, NULL without a finished one."""
    rows = frame(spark, sf, "on_time_events")
    rows = rows.select(
        "ship_to_party_code",
        F.when(F.col("failure_bucket_name") == "On Time", F.col("load_id")).alias("on_time"),
        F.when(F.col("trnsp_stage_num") == "7", F.col("load_id")).alias("seventh"),
    )
    return rollup.ratio_of_counts(rows, ["ship_to_party_code"], "on_time", "seventh", "pct")


@query
def group_total_attach(spark, sf):
    """Total size of its brand next to every part; the group of NULL brands has no total."""
    brand = F.when(F.col("p_size") > 2, F.col("p_brand"))
    parts = table(spark, sf, "part").select("p_partkey", brand.alias("brand"), "p_size")
    masked = rollup.attach_group_total(
        parts, ["brand"], {"brand_size": "p_size"}, salts=8, salt_by=["p_partkey"]
    )
    return rollup.attach_group_total(
        masked, ["brand"], {"brand_size_with_null": "p_size"}, mask_null=False
    )


@query
def hierarchy_flatten(spark, sf):
    costs = frame(spark, sf, "load_costs")
    levels = [c for c in costs.columns if c.startswith("customer_lvl")]
    return rollup.flatten_hierarchy(costs, "ship_to_party_id", levels)


@query
def cost_by_unit(spark, sf):
    units = fill_load.cost_per_unit(frame(spark, sf, "unit_costs"))
    return units.withColumn("tfs_total_cost_amt", F.col("tfs_total_cost_amt").cast("double"))


# --- joins ----------------------------------------------------------------------------------


@query
def lookup_left(spark, sf):
    """Supplier attributes and business unit per item; units have several rows per origin."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    items = match.lookup(
        items, table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"}, {"carrier": "s_name"}
    )
    items = items.withColumn("origin_id", F.col("l_suppkey").cast("string"))
    return match.lookup(items, frame(spark, sf, "origin_units"), ["origin_id"], {"unit": "gbu_code"})


@query
def bridge_inner(spark, sf):
    chained = match.bridge(
        table(spark, sf, "orders"),
        [
            (table(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"}),
            (table(spark, sf, "part"), {"l_partkey": "p_partkey"}),
        ],
    )
    return chained.groupBy("o_orderkey", "p_brand").agg(F.sum("l_quantity").alias("quantity"))


@query
def period_join(spark, sf):
    """Items with the totals of their lane in their week."""
    items = _lanes(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        "l_quantity",
        p.year_week_key("l_shipdate").alias("week"),
        k.composite_key("origin", "dest").alias("lane"),
    )
    lanes = items.groupBy("week", "lane").agg(F.sum("l_quantity").alias("lane_quantity"))
    return join_totals(items, lanes, ["week", "lane"], "inner")


def _fallback(spark, sf, keep_duplicates):
    """Customers matched to suppliers of their nation, or else to the totals of their region."""
    nation = table(spark, sf, "nation")
    facts = table(spark, sf, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("nation"), F.col("n_regionkey").alias("area"))
    ref = (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("s_acctbal") > 8000, F.col("n_name")).otherwise("none").alias("nation"),
            F.when(F.col("s_acctbal") > 8000, F.col("n_regionkey")).otherwise(-1).alias("area"),
            F.col("s_name").alias("supplier"),
        )
    )

    def regroup(rest: DataFrame) -> DataFrame:
        return rest.groupBy("nation", "area").agg(F.max("c_custkey").alias("c_custkey"))

    matched = match.fallback_match(
        facts, ref, ["nation"], ["area"], keep_duplicates=keep_duplicates, regroup=regroup, spread=64
    )
    return matched.select("c_custkey", "nation", "area", "supplier", "match_tier")


@query
def fallback_match(spark, sf):
    return _fallback(spark, sf, False)


@query
def fallback_match_with_duplicates(spark, sf):
    return _fallback(spark, sf, True)


# --- rules and reshaping --------------------------------------------------------------------


@query
def profile_dispatch(spark, sf):
    return on_time.promise_kept(frame(spark, sf, "on_time_events"))


@query
def entity_override(spark, sf):
    """Balance of customers, replaced by the customer key for the listed segments."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.col("c_custkey").cast("double").alias("number")
    )
    by_list = match.override_for(
        customers, "c_mktsegment", OVERRIDE_CUSTOMERS, "by_list", "number", "c_acctbal"
    )
    segment = F.when(F.col("c_mktsegment").startswith("B"), F.col("c_mktsegment")).otherwise("none")
    listed = table(spark, sf, "customer").select(segment.alias("c_mktsegment"))
    return match.override_for(by_list, "c_mktsegment", listed, "by_table", "number", "c_acctbal")


@query
def clamp_floor(spark, sf):
    balance = F.when(F.col("c_nationkey") != 5, F.col("c_acctbal"))
    customers = table(spark, sf, "customer").select("c_custkey", balance.alias("balance"))
    return customers.select(
        "c_custkey",
        r.clamp_floor("balance").alias("not_negative"),
        r.clamp_floor(F.col("balance").try_cast("decimal(38,6)")).cast("double").alias("as_decimal"),
        F.lit(fill_hub.OPERATING_SPACE).alias("operating_space"),
    )


@query
def unpivot_measures(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        F.when(F.col("l_returnflag") != "N", F.col("l_tax")).alias("l_tax"),
    )
    return reshape.unpivot_measures(items, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def conform_output(spark, sf):
    """Orders in a declared target schema: other order, other types, bad values NULL."""
    orders = table(spark, sf, "orders")
    priority = F.split(F.col("o_orderpriority"), "-")
    text = orders.withColumns(
        {
            "priority_no": F.when(
                F.col("o_orderstatus") == "P", F.col("o_orderpriority")
            ).otherwise(priority[0]),
            "load_id": F.col("o_orderkey").cast("string"),
        }
    )
    schema = "o_orderstatus STRING, load_id BIGINT, priority_no INT, o_totalprice DOUBLE"
    return conform(text, schema)


@query
def overwrite_read_back(spark, sf):
    """Orders overwritten twice in the shared folder and read back through the catalog."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    overwrite_table(conform(orders, "o_custkey BIGINT"), path)
    overwrite_table(conform(orders, "o_orderstatus STRING, o_orderkey STRING, o_custkey INT"), path)
    catalog = SourceCatalog({"on_time_events": path}, {"on_time_events": {"o_orderkey": "load_id"}})
    return read_source(spark, "on_time_events", catalog, refresh=True)


@query
def overwrite_survives_failure(spark, sf):
    """Orders replaced by rows of their own target, then by a write that fails half-way: the second content stays."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    catalog = SourceCatalog({"on_time_events": path})
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    overwrite_table(orders, path)
    own = read_source(spark, "on_time_events", catalog)
    overwrite_table(own.where("o_orderstatus <> 'P'").withColumn("o_custkey", F.col("o_custkey") + 1), path)
    bad = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("stops here"))).otherwise(F.col("o_custkey"))
    with contextlib.suppress(Exception):
        overwrite_table(read_source(spark, "on_time_events", catalog).withColumn("o_custkey", bad), path)
    return read_source(spark, "on_time_events", catalog)


@query
def formula_graph(spark, sf):
    """Formulas that use later ones, an override that does, and one that replaces the column it reads."""
    defaults = {
        "net": "gross - rebate",
        "gross": "l_extendedprice + 1",
        "rebate": "gross * l_discount",
        "label": "concat('net ', l_returnflag)",
        "l_returnflag": "lower(l_returnflag)",
    }
    overrides = {"label": "concat('net ', l_returnflag, ' ', CASE WHEN net > 50000 THEN 'high' ELSE 'low' END)"}
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag")
    out = apply_formulas(rows, defaults, overrides).select("l_orderkey", "l_linenumber", "l_returnflag", "label", "net")
    return out.withColumn("net", F.round("net", 6))


# --- parts of the fill plan -----------------------------------------------------------------


@query
def fill_truck_releases(spark, sf):
    return fill_hub.truck_releases(frame(spark, sf, "truck_report"))


@query
def fill_order_loads(spark, sf):
    return fill_hub.order_loads(frame(spark, sf, "order_linkage"))


@query
def fill_truck_chain(spark, sf):
    return fill_hub.trucks(*frames(spark, sf, "order_linkage", "truck_report", "vehicles"))


@query
def fill_shipped_totals(spark, sf):
    return fill_hub.shipped_totals(fill_hub.normalize_items(frame(spark, sf, "delivery_items")))


@query
def fill_cost_per_load(spark, sf):
    return fill_hub.cost_per_load(frame(spark, sf, "load_costs"))


@query
def fill_awarded_volume(spark, sf):
    return fill_hub.awarded_volume(frame(spark, sf, "load_costs"))


@query
def fill_freight_per_load(spark, sf):
    return fill_hub.freight_per_load(frame(spark, sf, "freight_stats"))


@query
def fill_load_priority(spark, sf):
    return fill_hub.load_priority(frame(spark, sf, "on_time_events"))


@query
def fill_ship_to_hierarchy(spark, sf):
    sources = ["load_costs", "customers", "trade_channels", "customer_flags"]
    return fill_hub.ship_to_hierarchy(*frames(spark, sf, *sources))


# --- plans ----------------------------------------------------------------------------------


def build_on_time(spark, sf, **options) -> DataFrame:
    sources = [
        "on_time_events",
        "origin_units",
        "destination_channels",
        "ship_to_flags",
        "on_time_reasons",
        "freight_stats",
    ]
    options = {"override_customers": OVERRIDE_CUSTOMERS} | options
    result = on_time.build(*frames(spark, sf, *sources), **options)
    return result.withColumn("distance_per_load_num_qty", F.col("distance_per_load_num_qty").cast("double"))


@query
def mart_on_time(spark, sf):
    return build_on_time(spark, sf, stage=written(spark, "on_time_rows"), lookups=written(spark))


@query
def mart_on_time_largest_order(spark, sf):
    """Promise result for the largest order of a load only, last ship-to as a real arg-max."""
    return build_on_time(
        spark,
        sf,
        largest_order_only=True,
        last_ship_to="argmax",
        stage=written(spark, "on_time_rows"),
        lookups=written(spark),
    )


@query
def mart_interplant(spark, sf):
    stage, lookups = written(spark, "on_time_rows"), written(spark)
    return on_time.inter_plant(build_on_time(spark, sf, stage=stage, lookups=lookups))


@query
def mart_loading(spark, sf):
    return loading.build(frame(spark, sf, "on_time_events")).drop("last_update_utc_tmstp")


@query
def mart_tender_lanes(spark, sf):
    lanes = tender.lanes(frame(spark, sf, "tender_summary"))
    day = F.date_format("week_begin_date", "yyyy-MM-dd").alias("week_begin_date")
    return lanes.drop("last_update_utc_tmstp").select(
        day, *(c for c in lanes.columns if c not in ("week_begin_date", "last_update_utc_tmstp"))
    )


def _tender_shipments(spark, sf, **options):
    costs, summary, locations = frames(spark, sf, "load_costs", "tender_summary", "locations")
    lanes = written(spark)(tender.lanes(summary), "lanes")
    return tender.shipments(costs, lanes, locations, **options)


def _with_day_texts(shipments: DataFrame) -> DataFrame:
    days = ("actual_goods_issue_date", "week_begin_date")
    return shipments.drop("last_update_utc_tmstp").withColumns({d: F.col(d).cast("string") for d in days})


@query
def mart_tender_shipments(spark, sf):
    return _with_day_texts(_tender_shipments(spark, sf))


@query
def mart_tender_shipments_repeated(spark, sf):
    """Every stop of a postal code repeats the shipment."""
    return _with_day_texts(_tender_shipments(spark, sf, repeat_stops=True))


@query
def mart_tender_shipments_by_week(spark, sf):
    """Shipments with all lanes of their week, counted per load."""
    costs, summary, locations = frames(spark, sf, "load_costs", "tender_summary", "locations")
    rows = tender.shipments_of_week(costs, written(spark)(tender.lanes(summary), "lanes"), locations)
    return rows.groupBy("concat_week_year", "load_id").agg(
        F.sum("lane_cnt").alias("rows"), F.sum("lane_accept_cnt").alias("accepted")
    )


@query
def tender_lanes_newest_folders(spark, sf):
    """Lanes of all weeks in a target partitioned by week; the 13 newest folders are read back."""
    path = f"{shared_folder(spark)}/lanes-{uuid.uuid4().hex}"
    publish(tender.lanes(frame(spark, sf, "tender_summary"), weeks=None).drop("last_update_utc_tmstp"), path, [tender.WEEK])
    lanes = read_newest(spark, path, tender.WEEK, tender.WEEKS_KEPT)
    day = F.date_format("week_begin_date", "yyyy-MM-dd").alias("week_begin_date")
    return lanes.select(day, *(c for c in lanes.columns if c != "week_begin_date"))


@query
def tender_shipments_pruned(spark, sf):
    """Shipments from loads and lanes partitioned by week: only folders of the newest weeks are read."""
    own = f"{shared_folder(spark)}/weeks-{uuid.uuid4().hex}"
    costs, summary, locations = frames(spark, sf, "load_costs", "tender_summary", "locations")
    publish(tender.lanes(summary, weeks=None), f"{own}/lanes", [tender.WEEK])
    publish(tender.weekly_loads(costs), f"{own}/loads", [tender.WEEK])
    lanes = read_newest(spark, f"{own}/lanes", tender.WEEK, tender.WEEKS_KEPT)
    loads = read_current(spark, f"{own}/loads")
    return _with_day_texts(tender.shipments(loads, lanes, locations, weeks=tender.WEEKS_KEPT))


HUB_SOURCES = [
    "delivery_items",
    "on_time_events",
    "order_linkage",
    "truck_report",
    "vehicles",
    "load_costs",
    "freight_stats",
    "customers",
    "trade_channels",
    "customer_flags",
    "value_categories",
    "origin_names",
]

HUB_PLAIN = [
    *fill_hub.ITEM_KEYS,
    "order_num",
    "carr_id",
    "ordered_shipped_flag",
    "truck_type_code",
    "min_trans_stage_flag",
    "shipped_load_cnt",
    "palletsshipped",
    "pallet_shipped_qty",
    "primary_carr_flag",
    "true_fa_flag",
    "origin_freight_code",
    "subsector_sales_cnt",
    "combined_gbu_code",
    "shipped_net_weight_qty",
    "shipped_gross_vol_qty",
    "plan_gross_weight_qty",
    "plan_net_vol_qty",
    "step_factor",
    "su_per_load_cnt",
    "load_builder_prty_val",
    "avg_average_awarded_weekly_volume",
    "customer_lvl3_desc",
    "trade_chanl_desc",
    "sambc_flag",
    "categ_name",
    "final_ship_to_party_id",
    "low_density_site_val",
    "origin_site_name",
    "tac_freight_type_code",
    "check_density",
    "sum_pallet_spot_qty",
    "hopade_amt",
    "max_orders_incrmtl_amt",
    "glb_segment_impact_cat_ld_amt",
    "drf_last_truck_amt",
    "max_orders_non_drp_amt",
    "sum_max_orders_incrmtl_amt",
    "sum_max_orders_non_drp_amt",
    "sum_hopade_amt",
    "sum_drf_last_truck_amt",
    "weight_avg_qty",
    "gbu_code",
    "gbu_desc",
    "ship_to_party_desc",
    "net_weight_qty",
    "gross_weight_qty",
    "net_vol_qty",
    "gross_vol_qty",
    "oblb_gross_weight_plan_qty",
    "oblb_gross_weight_shipped_qty",
    "oblb_net_weight_plan_qty",
    "oblb_gross_vol_plan_qty",
    "oblb_gross_vol_shipped_qty",
    "oblb_net_vol_plan_qty",
    "max_weight_qty",
    "max_vol_trans_mgmt_sys_qty",
    "max_pallet_tms_trans_type_qty",
    "floor_position_qty",
    "pallet_qty",
    "theortc_pallet_qty",
    "actual_cost_amt",
    "shpmt_start_date",
    "fiscal_year_num",
    "fiscal_year_perd_num",
    "pallet_num_qty",
    "pallet_spot_qty",
    "total_gross_weight_qty",
    "total_gross_vol_qty",
    "shipped_net_vol_qty",
    "shipped_gross_weight_qty",
    "plan_gross_vol_qty",
    "plan_net_weight_qty",
    "actual_carr_trans_cost_amt",
    "linehaul_cost_amt",
    "fuel_cost_amt",
    "fabric_subsector_step_cnt",
    "hair_subsector_step_cnt",
    "other_subsector_cnt",
    "origin_zone_ship_from_code",
    "origin_loc_id",
    "origin_zone_code",
    "dest_ship_from_code",
    "dest_zone_code",
    "dest_loc_code",
    "tms_service_code",
    "freight_auction_flag",
    "actual_carr_total_trans_cost_usd_amt",
    "max_freight_cost_charge_code",
    "customer_lvl1_code",
    "customer_lvl1_desc",
    "customer_lvl3_code",
    "customer_lvl5_code",
    "customer_lvl5_desc",
    "customer_lvl12_code",
    "customer_lvl12_desc",
    "trade_chanl_id",
    "max_net_weight_order_qty",
    "transport_num",
    "linkage_item_num",
    "linkage_kind_code",
    "leo_tour_id",
    "release_dttm",
    "truck_vehicle_type_code",
    "vehicle_true_max_vol_qty",
    "vehicle_true_max_weight_qty",
]
HUB_ROUNDED = [
    "avg_award_weekly_vol_qty",
    "weight_vol_plan_qty",
    "density_rate",
    "load_material_weight_qty",
    "load_material_vol_qty",
    "load_density_rate",
    "pallet_load_qty",
    "pallet_impact_amt",
    "opertng_space_impact_amt",
    "net_vol_fill_rate",
    "net_density_order_qty",
    "calc_std_weight_qty",
    "cut_impact_rate",
    "prod_density_gap_impact_pct",
    "hopade_amt_dec",
    "total_vf_optny_amt",
]


def _rounded(*names: str) -> list[Column]:
    return [F.round(F.col(c).cast("double"), 6).alias(c) for c in names]


def build_fill_hub(spark, sf) -> DataFrame:
    """Fill result of the test tables; frames several steps read are written to the shared folder."""
    stage = written(spark, "items", "loads", "prepared")
    return fill_hub.build(*frames(spark, sf, *HUB_SOURCES), stage=stage, lookups=written(spark))


@query
def mart_fill_hub(spark, sf):
    return build_fill_hub(spark, sf).select(*HUB_PLAIN, *_rounded(*HUB_ROUNDED))


BY_LOAD_SOURCES = ["delivery_items", "on_time_events", "order_linkage", "truck_report", "vehicles", "load_costs", "freight_stats"]
BY_LOAD = ("items", "costs", "freight", "priorities")


def bucketed_loads(spark, sf, buckets: int | None = None) -> DataFrame:
    buckets = buckets or buckets_for(table(spark, sf, "lineitem").count())  # counted in the file footers
    stage = Bucketed(spark, {name: ["load_id"] for name in BY_LOAD}, buckets)
    return fill_hub.load_facts(*fill_hub.by_load(*frames(spark, sf, *BY_LOAD_SOURCES), stage=stage))


@query
def fill_loads_bucketed(spark, sf):
    """All facts of a load from sources bucketed by it: one shuffle while they are written, none after."""
    facts = bucketed_loads(spark, sf)
    return facts.select(
        "load_id",
        "shipped_load_cnt",
        "min_trans_stage_num",
        "avg_palletsshipped",
        "sum_material_weight_qty",
        "sum_material_vol_qty",
        *(f"{kind}_{way}_{what}_qty" for kind in ("shipped", "plan") for way in ("net", "gross") for what in ("weight", "vol")),
        "actual_carr_total_trans_cost_usd_amt",
        "tms_service_code",
        "step_factor",
        "su_per_load_cnt",
        "max_freight_cost_charge_code",
        "load_builder_prty_val",
        "final_ship_to_party_id",
    )


@query
def stage_figures(spark, sf):
    """Rows, NULL keys and fan-out of the frames of the fill plan, counted while they are written."""
    figures = Figures({name: ["load_id", "load_gbu_id"] for name in BY_LOAD})
    sources = frames(spark, sf, *BY_LOAD_SOURCES)
    sources[0] = figures.watch(sources[0], "delivery_items")
    fill_hub.by_load(*sources, stage=figures.stage(written(spark, *BY_LOAD)))
    counted = figures.frame(spark)
    fan = fan_out(counted, "delivery_items", "items").select(F.lit("items").alias("stage"), F.lit("fan_out").alias("figure"), F.col("fan_out").cast("bigint").alias("value"))
    return counted.union(fan)


# every column of the hub under its name, and those that only the load rollup has
FILL_LOAD_PLAIN = [*HUB_PLAIN, *fx.FILL_BUCKETS, "tfs_su_per_load_qty", "tfs_step_factor"]
FILL_LOAD_ROUNDED = [*HUB_ROUNDED, *fx.FILL_SHARES, "tfs_total_cost_amt"]


@query
def mart_fill_load(spark, sf):
    stage = written(spark, "first_stage_items")
    result = fill_load.build(build_fill_hub(spark, sf), frame(spark, sf, "unit_costs"), stage=stage)
    return result.select(*FILL_LOAD_PLAIN, *_rounded(*FILL_LOAD_ROUNDED))


def build_scorecard(spark, sf, **options) -> DataFrame:
    sources = ["tender_weekly", "on_time_view", "loading_view", "fill_view"]
    stage = written(spark, "tender_facts", "fallback_matched", "loading_facts", "fill_facts")
    return scorecard.build(*frames(spark, sf, *sources), stage=stage, **options)


@query
def mart_scorecard(spark, sf):
    return build_scorecard(spark, sf)


@query
def mart_scorecard_with_duplicates(spark, sf):
    """Unmatched facts in both tiers, highest origin per lane, single-digit fill weeks unpadded."""
    return build_scorecard(spark, sf, keep_duplicates=True, lane_counts="max", pad_week=False)


# --- sources, sinks and jobs ------------------------------------------------------------------


def _catalog(spark, sf, sources, outputs, columns=None) -> SourceCatalog:
    """Catalog of the named sources, written as Parquet, and of new tables for the outputs."""
    own = uuid.uuid4().hex
    folder = f"{shared_folder(spark)}/sources-{own}"
    for name, df in zip(sources, frames(spark, sf, *sources)):
        df.write.parquet(f"{folder}/{name}")
    tables = {name: f"{folder}/{name}" for name in sources}
    return SourceCatalog(tables | {name: f"{name}_{own}" for name in outputs}, columns or {})


@query
def sources_by_name(spark, sf):
    """Every source under other column names, read back by its logical name: rows and filled values."""
    folder = f"{shared_folder(spark)}/sources-{uuid.uuid4().hex}"
    tables, columns, counts = {}, {}, []
    for name, df in zip(FRAMES, frames(spark, sf, *FRAMES)):
        tables[name], columns[name] = f"{folder}/{name}", {f"SRC_{c}": c for c in df.columns}
        df.withColumnsRenamed({c: f"src_{c}" for c in df.columns}).write.parquet(tables[name])
    catalog = SourceCatalog(tables, columns)
    for name, wanted in columns.items():
        df = read_source(spark, name, catalog)
        filled = sum((F.count(c) for c in wanted.values()), F.lit(0).cast("bigint"))
        counts.append(df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"), filled.alias("filled")))
    return reshape.union_all(counts).select("source", "rows", "filled")


@query
def job_loading(spark, sf):
    """The loading job into a table that exists, with fewer columns, other types and a renamed key."""
    catalog = _catalog(spark, sf, ["on_time_events"], ["loading"], {"loading": {"load_number": "load_id"}})
    columns = "change_type_code STRING, load_number STRING, ship_year BIGINT, lot_otd_cnt DOUBLE"
    spark.sql(f"CREATE TABLE {catalog.physical_name('loading')} ({columns}) USING parquet")
    jobs.load_loading(spark, catalog)
    return read_source(spark, "loading", catalog, refresh=True)


@query
def job_tenders(spark, sf):
    """Both targets of the tender job; the shipments are read back."""
    outputs = ["tender_lanes", "tender_shipments"]
    catalog = _catalog(spark, sf, ["tender_summary", "load_costs", "locations"], outputs)
    jobs.load_tenders(spark, catalog, shipment_options={"repeat_stops": True})
    return _with_day_texts(read_source(spark, "tender_shipments", catalog, refresh=True))


@query
def job_interplant(spark, sf):
    """The on-time job and, from its target, the inter-plant job."""
    sources = ["on_time_events", "origin_units", "destination_channels", "ship_to_flags", "on_time_reasons", "freight_stats"]
    catalog = _catalog(spark, sf, sources, ["on_time", "inter_plant"])
    jobs.load_on_time(spark, catalog, override_customers=OVERRIDE_CUSTOMERS)
    jobs.load_inter_plant(spark, catalog)
    rows = read_source(spark, "inter_plant", catalog, refresh=True)
    return rows.withColumn("distance_per_load_num_qty", F.col("distance_per_load_num_qty").cast("double"))


@query
def job_fill_load(spark, sf):
    """The item-level fill job and, from its target, the load-level one."""
    catalog = _catalog(spark, sf, [*HUB_SOURCES, "unit_costs"], ["fill_hub", "fill_load"])
    jobs.load_fill_hub(spark, catalog)
    jobs.load_fill_load(spark, catalog)
    result = read_source(spark, "fill_load", catalog, refresh=True)
    return result.select(*FILL_LOAD_PLAIN, *_rounded(*FILL_LOAD_ROUNDED))


@query
def job_scorecard(spark, sf):
    catalog = _catalog(spark, sf, ["tender_weekly", "on_time_view", "loading_view", "fill_view"], ["scorecard"])
    jobs.load_scorecard(spark, catalog)
    return read_source(spark, "scorecard", catalog, refresh=True)

"""Customer shipments on time: one row per order, load, ship-to and reason.

The prepared events go to ``stage`` as ``on_time_rows``, because four column-pruned aggregates read
them (order key, load, load x stage x event, load x profile), each combined before its shuffle.  Only
their results are joined; the events themselves meet two lookups, which Spark broadcasts while they
are small and joins by shuffling beyond that.  All results of a load, its promises among them, are
gathered into one row and repeated for each ship-to of the load, with the flag of the ship-to.  Load and
ship-to are keys of an order, so the wide events are dealt out once by both: they meet these rows and
are rolled up to orders where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import (
    FIRST_EVENT,
    ON_TIME_LOAD,
    ON_TIME_RESULT,
    ON_TIME_ROW,
    apply_formulas,
    check_names,
)
from ..functions.keys import composite_key, normalize_key
from ..functions.periods import parse_date_time
from ..functions.rules import dispatch_by_code, measurable, on_time_flag, safe_ratio
from ..operators.dedupe import first_event, last_event_attr
from ..operators.match import lookup, override_for
from ..operators.rollup import RollupSpec, rollup_beside
from ..operators.skew import join_totals
from ..operators.stage import Stage, no_stage

# The columns that identify a row of the result.
KEYS = [
    "order_num",
    "load_id",
    "cust_po_num",
    "ship_to_party_code",
    "ship_to_party_desc",
    "failure_bucket_name",
    "failure_bucket_updated_name",
    "on_time_src_code",
    "dest_sold_to_name",
    "lot_delay_code",
]

ON_TIME = "On Time"
INTER_PLANT = "INTERPLANT"

# Profile codes and the delivery moment each one promises.
PROFILE_PROMISES = {
    ("APFD", "RDDAPF", "APF"): "first_dlvry_appt",
    ("APLD", "RDDAPL", "APL"): "last_dlvry_appt",
    ("RDD",): "request_dlvry_to",
    ("ORDD", "OTIF"): "orig_request_dlvry_to",
}

# Unloading kinds a load is labelled with.
UNLOADING_KINDS = ["Drop", "Live", ""]

# Event columns that have another name in the result.
RESULT_NAMES = {
    "ship_point_at_point_of_dprtr_code": "origin_code",
    "ship_point_desc": "origin_zone_ship_from_code",
    "ship_cond_desc": "transit_mode_name",
    "actual_ship_datetm": "actual_shpmt_start_datetm",
    "true_frt_type_desc": "freight_type_val",
    "sd_doc_item_overall_process_status_val": "overall_status_val",
    "actual_service_tms_code": "service_tms_code",
    "actual_shpmt_end_date": "actual_arrival_date",
    "origin_zone_code": "parent_loc_code",
}

# Event columns that only feed load-level results or other plans.
NOT_IN_RESULT = [
    "trnsp_stage_num",
    "event_datetm",
    "change_type_code",
    "child_shpmt_num",
    "actual_dlvry_tmstp",
    "first_appt_dlvry_tmstp",
    "drop_live_ind_desc",
    "lot_delay_reason_code",
    "lot_delay_reason_code_desc",
    "load_builder_prty_val",
]


def prepare(events: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Event rows with a numeric stage, the row formulas, the lane label and the row's status."""
    rows = events.withColumn("trnsp_stage_num", F.col("trnsp_stage_num").try_cast("int"))
    rows = apply_formulas(rows, ON_TIME_ROW, formulas)
    where_to = composite_key("dest_city_name", "dest_state_code", "dest_postal_code", sep=",")
    dates = ["schedule_date", "tender_date", "first_dlvry_appt_date"]
    return rows.withColumns(
        {
            "lane_name": composite_key("origin_zone_code", where_to, sep=" to "),
            "_on_time": F.col("failure_bucket_updated_name") == ON_TIME,
            "_measurable": measurable("sd_doc_item_overall_process_status_val", dates),
        }
    )


def load_facts(rows: DataFrame, last_ship_to: str = "max") -> DataFrame:
    """Per load: on-time and measurable presence, unloading kind, last ship-to.

    ``last_ship_to="max"`` takes the highest ship-to code and name of the load, each on its own;
    ``"argmax"`` takes both from the row with the highest stage and event stamp.
    """
    unloading = F.col("drop_live_ind_desc").isin(UNLOADING_KINDS)
    aggregates = [
        F.max(F.when(F.col("_on_time"), 1)).alias("load_on_time"),
        F.max(F.when(F.col("_measurable"), 1)).alias("measrbl_shpmt_cnt"),
        F.max(F.when(unloading, F.col("drop_live_ind_desc"))).alias("drop_live_ind_desc"),
    ]
    if last_ship_to == "max":
        for c in ("ship_to_party_code", "ship_to_party_desc"):
            aggregates.append(F.max(c).alias(f"max_{c}"))
        return rows.groupBy("load_id").agg(*aggregates)
    last = last_event_attr(
        rows.filter(F.col("load_id").isNotNull()),
        ["load_id"],
        ["trnsp_stage_num", "event_datetm"],
        ["ship_to_party_code", "ship_to_party_desc"],
    )
    last = last.select(
        "load_id",
        F.col("ship_to_party_code").alias("max_ship_to_party_code"),
        F.col("ship_to_party_desc").alias("max_ship_to_party_desc"),
    )
    return rows.groupBy("load_id").agg(*aggregates).join(last, "load_id", "left")


def first_delivery_ratio(rows: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Per load: on-time count of the first events of its stages over its highest stage."""
    stamps = ["actual_dlvry_tmstp", "first_appt_dlvry_tmstp"]
    first = first_event(rows, ["load_id", "trnsp_stage_num"], "event_datetm", stamps)
    counted = first.withColumn("_kept", F.expr({**FIRST_EVENT, **(formulas or {})}["first_event_on_time"]))
    per_load = counted.groupBy("load_id").agg(
        F.max("_kept").alias("_kept"), F.max("trnsp_stage_num").alias("_stages")
    )
    return per_load.select("load_id", safe_ratio("_kept", "_stages").alias("cdot_ontime_cnt"))


def promise_kept(rows: DataFrame) -> DataFrame:
    """Per load and profile: was the latest arrival within the moment the profile promises."""
    moments = {
        "first_dlvry_appt": ("first_dlvry_appt_date", "first_dlvry_appt_datetm"),
        "last_dlvry_appt": ("last_dlvry_appt_date", "last_dlvry_appt_datetm"),
        "request_dlvry_to": ("request_dlvry_to_date", "request_dlvry_to_datetm"),
        "orig_request_dlvry_to": ("orig_request_dlvry_to_date", "orig_request_dlvry_to_datetm"),
        "arrival": ("actual_shpmt_end_date", "actual_arrival_datetm"),
    }
    latest = rows.groupBy("load_id", "profl_method_code").agg(
        *(F.max(parse_date_time(d, t)).alias(name) for name, (d, t) in moments.items()),
        F.max("order_num").alias("largest_order_num"),
    )
    promised = dispatch_by_code("profl_method_code", PROFILE_PROMISES)
    return latest.select(
        "load_id",
        "profl_method_code",
        "largest_order_num",
        on_time_flag(promised, "arrival").alias("load_lvl_on_time_pct"),
    )


def promises_of_loads(rows: DataFrame) -> DataFrame:
    """Per load: a map from profile to ``promise_kept``, which is as long as the load has profiles."""
    kept = promise_kept(rows).where("load_id IS NOT NULL AND profl_method_code IS NOT NULL")
    result = F.struct("load_lvl_on_time_pct", "largest_order_num")
    entries = F.collect_list(F.struct("profl_method_code", result))
    return kept.groupBy("load_id").agg(F.map_from_entries(entries).alias("_promises"))


def distance_per_load(freight_stats: DataFrame) -> DataFrame:
    load = normalize_key("shpmt_id").alias("load_id")
    distance = F.col("distance_per_load_qty").try_cast("decimal(30,8)")
    stats = freight_stats.select(load, distance.alias("distance_per_load_num_qty"))
    return stats.groupBy("load_id").agg(
        F.max("distance_per_load_num_qty").alias("distance_per_load_num_qty")
    )


def build(
    events: DataFrame,
    origin_units: DataFrame,
    destination_channels: DataFrame,
    ship_to_flags: DataFrame,
    on_time_reasons: DataFrame,
    freight_stats: DataFrame,
    *,
    override_customers: Sequence[str] | DataFrame = (),
    formulas: Mapping[str, str] | None = None,
    last_ship_to: str = "max",
    largest_order_only: bool = False,
    null_safe_keys: bool = False,
    stage: Stage = no_stage,
    lookups: Stage = no_stage,
) -> DataFrame:
    """On-time result, unique on ``KEYS``.

    ``override_customers`` are measured by the promise of their load's profile, all others by the
    on-time percentage.  ``largest_order_only=True`` gives the load's promise result only to its
    order with the highest number; the other orders of a listed customer then have no percentage.
    Unless ``null_safe_keys``, an order with a NULL key column gets no promise result and counts as
    no listed customer.  An order with several profiles takes the highest profile text.  A
    ``lookups`` stage that writes spares the wide rows a shuffle for each lookup that is small.
    """
    check_names(formulas, ON_TIME_ROW, ON_TIME_RESULT, ON_TIME_LOAD, FIRST_EVENT)
    rows = stage(prepare(events, formulas), "on_time_rows")

    loads = load_facts(rows, last_ship_to)
    loads = loads.join(first_delivery_ratio(rows, formulas), "load_id", "left")
    loads = loads.join(distance_per_load(freight_stats), "load_id", "left")
    loads = loads.join(promises_of_loads(rows), "load_id", "left")
    stops = _stops(rows, loads, ship_to_flags, lookups)
    joined = _orders(rows, stops, origin_units, on_time_reasons, lookups)
    joined = joined.withColumn("_promise", F.col("_promises")[F.col("profl_method_code")]).drop("_promises")

    has_load, is_measurable = F.col("load_on_time") == 1, F.col("measrbl_shpmt_cnt") == 1
    iot_pct = F.when(is_measurable, F.when(has_load, 100.0).otherwise(0.0))
    joined = joined.withColumns(
        {
            "shpmt_cnt": F.lit(1),
            "shpmt_on_time_cnt": F.when(F.col("failure_bucket_updated_name") == ON_TIME, 1),
            "iot_on_time_pct": iot_pct,
            "iot_on_time2_pct": iot_pct,
        }
    )
    joined = apply_formulas(joined, ON_TIME_LOAD, formulas).drop("load_on_time")

    joined = lookup(
        joined,
        destination_channels,
        {"dest_sold_to_name": "dest_sold_to_name"},
        {"lookup_customer_name": "customer_name", "lookup_channel_name": "channel_name"},
        stage=lookups,
    )
    joined = joined.withColumn("ship_to_flag", F.col("_ship_to_flag")).drop("_ship_to_flag")
    joined = apply_formulas(joined, ON_TIME_RESULT, formulas)

    kept = _promise_of_orders(joined, largest_order_only, null_safe_keys)
    return override_for(
        kept,
        "_override_customer",
        override_customers,
        "actual_on_time_pct",
        "load_lvl_on_time_pct",
        "on_time_pct",
    ).drop("_override_customer", "unit_code", "lookup_customer_name", "lookup_channel_name")


def _with_origin(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("load_id").isNotNull() & (F.col("origin_zone_code") != ""))


def _stops(rows: DataFrame, loads: DataFrame, ship_to_flags: DataFrame, lookups: Stage = no_stage) -> DataFrame:
    """Per load and ship-to: all results of the load and the flag of the ship-to."""
    stops = _with_origin(rows).select("load_id", "ship_to_party_code").distinct()
    stops = lookup(stops, ship_to_flags, {"ship_to_party_code": "ship_to_num"}, {"_ship_to_flag": "ship_to_flag"}, stage=lookups)
    return join_totals(stops, loads, ["load_id"])


def _orders(
    rows: DataFrame, stops: DataFrame, origin_units: DataFrame, on_time_reasons: DataFrame, lookups: Stage = no_stage
) -> DataFrame:
    """Rows with a load and an origin, rolled up to ``KEYS``, with the columns of ``stops``; every other column is an attribute."""
    kept = lookup(
        _with_origin(rows),
        origin_units,
        {"ship_point_code": "origin_id", "origin_zone_code": "parent_loc_code"},
        {"unit_code": "gbu_code"},
        stage=lookups,
    )
    kept = lookup(
        kept,
        on_time_reasons,
        {"on_time_src_desc": "definition_name"},
        {"aot_bucket_val": "cause_desc"},
        stage=lookups,
    )
    helpers = [c for c in kept.columns if c.startswith("_")]
    renamed = {new: old for old, new in RESULT_NAMES.items() if old in kept.columns}
    spec = RollupSpec(KEYS, attributes=renamed).with_remaining_attributes(
        kept, exclude=[*NOT_IN_RESULT, *helpers]
    )
    return rollup_beside(kept, spec, stops, ["load_id"], ["ship_to_party_code"], "inner")


def _promise_of_orders(orders: DataFrame, largest_order_only: bool, null_safe_keys: bool) -> DataFrame:
    """The promise result of the order's load and profile, as far as its keys are known."""
    known = F.lit(True)
    if not null_safe_keys:
        for key in KEYS:
            known = known & F.col(key).isNotNull()
    judged = known
    if largest_order_only:
        judged = known & (F.col("order_num") == F.col("_promise.largest_order_num"))
    return orders.withColumns(
        {
            "load_lvl_on_time_pct": F.when(judged, F.col("_promise.load_lvl_on_time_pct")),
            "_override_customer": F.when(known, F.col("customer_desc")),
        }
    ).drop("_promise")


def inter_plant(on_time: DataFrame, freight_type: str = INTER_PLANT) -> DataFrame:
    """The deliveries between plants among the on-time result."""
    return on_time.filter(F.col("freight_type_val") == freight_type)

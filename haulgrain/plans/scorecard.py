"""Weekly network scorecard: tender, on-time, loading and fill facts per lane, carrier and week."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import SCORECARD_TENDER, apply_formulas, check_names
from ..functions.keys import composite_key, normalize_key
from ..functions.periods import parse_dmy, year_week_key
from ..functions.rules import not_text_null
from ..operators.match import fallback_match
from ..operators.rollup import RollupSpec, wide_rollup
from ..operators.skew import join_totals
from ..operators.stage import Stage, no_stage

WEEK = "week_year_val"

# The column lists down to FILL_MEANS name columns of the source and target tables.
EXACT = [WEEK, "forward_agent_id", "service_tms_code", "origin_code", "dest_ship_from_code"]
COARSE = [
    WEEK,
    "forward_agent_id",
    "service_tms_code",
    "origin_zone_ship_from_code",
    "dest_ship_from_code",
]
ORIGIN = "monster_origin_code"
ATTACH = [ORIGIN, "dest_ship_from_code", "forward_agent_id", "service_tms_code", WEEK]

COUNTS = ["shpmt_cnt", "shpmt_on_time_cnt", "measrbl_shpmt_cnt"]
NAMES = [
    "ship_to_party_desc",
    "dest_sold_to_name",
    "carr_desc",
    "actual_ship_date",
    "freight_type_val",
    "cdot_ontime_cnt",
    "parent_carr_name",
]

LOADING_SUMS = {
    "lot_otd_count": "lot_otd_cnt",
    "lot_tat_late_counter_val": "lot_tat_late_counter_val",
    "lot_customer_failure_cnt": "lot_cust_failure_cnt",
    "shipper_failure_cnt": "shipper_failure_cnt",
    "carr_failure_cnt": "carr_failure_cnt",
    "others_failure_cnt": "others_failure_cnt",
}

# Quantities that are both summed and averaged.
FILL_QUANTITIES = [
    "plan_gross_weight_qty",
    "plan_net_weight_qty",
    "shipped_gross_weight_qty",
    "shipped_net_weight_qty",
    "plan_gross_vol_qty",
    "plan_net_vol_qty",
    "shipped_gross_vol_qty",
    "shipped_net_vol_qty",
    "max_weight_qty",
    "max_vol_trans_mgmt_sys_qty",
]
FILL_AMOUNTS = [
    "su_per_load_cnt",
    "cut_impact_rate",
    "drf_last_truck_amt",
    "glb_segment_impact_cat_ld_amt",
    "hopade_amt",
    "max_orders_incrmtl_amt",
    "max_orders_non_drp_amt",
    "total_vf_optny_amt",
]
FILL_MEANS = ["floor_position_qty", "max_pallet_tms_trans_type_qty"]


def tender_facts(tender_weekly: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Weekly tender rows under the scorecard's key names, with lane and ten-digit carrier keys."""
    renamed = tender_weekly.withColumnsRenamed(
        {
            "calendar_year_week_tac": WEEK,
            "carrier_id": "forward_agent_id",
            "tms_service_code": "service_tms_code",
            "origin_location_id": "origin_code",
        }
    ).drop("carr_desc")
    named = apply_formulas(renamed, SCORECARD_TENDER, formulas)
    return named.withColumn("lane_key", composite_key("origin_zone_ship_from_code", "dest_ship_from_code"))


def on_time_facts(on_time_view: DataFrame) -> DataFrame:
    """On-time facts per origin, lane, ship-to, carrier, service and week."""
    rows = on_time_view.withColumnsRenamed({"ship_week_num": WEEK, "carr_num": "forward_agent_id"})
    spec = RollupSpec(
        keys=[
            "parent_loc_code",
            "dest_ship_from_code",
            "ship_to_party_code",
            "forward_agent_id",
            "service_tms_code",
            "origin_code",
            "origin_zone_ship_from_code",
            WEEK,
        ],
        attributes=NAMES,
        sums=COUNTS,
    )
    rolled = wide_rollup(rows, spec).drop("ship_to_party_code", "origin_zone_ship_from_code")
    return rolled.withColumn(ORIGIN, F.col("origin_code"))


def regroup_to_lane(unmatched: DataFrame, counts: str = "sum") -> DataFrame:
    """Facts without an exact tender match, brought to the lane grain.

    ``counts="sum"`` adds up the counts of the lane's origins, so that no shipment is lost.
    ``"max"`` sums them per origin and takes the highest origin, as the source jobs do.
    """
    lane = ["parent_loc_code", "dest_ship_from_code", "forward_agent_id", "service_tms_code", WEEK]
    if counts == "sum":
        lanes = wide_rollup(unmatched, RollupSpec(lane, attributes=[*NAMES, ORIGIN], sums=COUNTS))
        return lanes.withColumn("origin_zone_ship_from_code", F.col("parent_loc_code"))
    if counts != "max":
        raise ValueError(f"counts must be sum or max, not {counts!r}")
    origin_spec = RollupSpec(
        EXACT, attributes=[*NAMES, "parent_loc_code", ORIGIN], sums=COUNTS
    )
    per_origin = wide_rollup(unmatched, origin_spec)
    lanes = wide_rollup(per_origin, RollupSpec(lane, attributes=[*NAMES, *COUNTS, ORIGIN]))
    return lanes.withColumn("origin_zone_ship_from_code", F.col("parent_loc_code"))


def loading_facts(loading_view: DataFrame) -> DataFrame:
    """Loading counters per origin, destination, carrier, service and week."""
    rows = loading_view.withColumnsRenamed(
        {
            "ship_week_num": WEEK,
            "ship_point_code": ORIGIN,
            "actual_service_tms_code": "service_tms_code",
            "carr_num": "forward_agent_id",
        }
    )
    return wide_rollup(rows, RollupSpec(ATTACH, attributes=["tolrnc_sot_val"], sums=LOADING_SUMS))


def fill_facts(fill_view: DataFrame, pad_week: bool = True, year_mode: str = "calendar") -> DataFrame:
    """Fill quantities per origin, destination, carrier, service and week of the start date.

    ``pad_week=False`` leaves weeks 1-9 with one digit, which then do not meet padded keys.
    """
    day = parse_dmy("shpmt_start_date")
    rows = fill_view.withColumnsRenamed(
        {"ship_point_code": ORIGIN, "tms_service_code": "service_tms_code"}
    ).withColumns(
        {
            "forward_agent_id": normalize_key("carr_id"),
            WEEK: year_week_key(day, "ww/yyyy", year_mode, pad=pad_week),
        }
    )
    spec = RollupSpec(
        ATTACH,
        sums=[*FILL_QUANTITIES, *FILL_AMOUNTS],
        means={f"avg_{q}": q for q in FILL_QUANTITIES} | {m: m for m in FILL_MEANS},
    )
    return wide_rollup(rows, spec)


def build(
    tender_weekly: DataFrame,
    on_time_view: DataFrame,
    loading_view: DataFrame,
    fill_view: DataFrame,
    *,
    keep_duplicates: bool = False,
    lane_counts: str = "sum",
    pad_week: bool = True,
    year_mode: str = "calendar",
    formulas: Mapping[str, str] | None = None,
    stage: Stage = no_stage,
) -> DataFrame:
    """Scorecard rows with the tier their tender data was matched in.

    On-time facts meet the tender rows of their exact origin; those without any are regrouped to
    the lane and meet the tender rows of the zone.  ``keep_duplicates=True`` also keeps the
    unmatched facts in their ungrouped form; ``lane_counts`` is explained at ``regroup_to_lane``.
    A ``stage`` that writes ``fallback_matched`` lets the on-time facts be read once.  One that writes
    ``loading_facts`` and ``fill_facts`` spares their sources a filter: Spark else looks for NULL keys
    in every source row, and computes the week from the date text there once more.
    """
    check_names(formulas, SCORECARD_TENDER)
    tender = stage(tender_facts(tender_weekly, formulas), "tender_facts")
    matched = fallback_match(
        on_time_facts(on_time_view),
        tender,
        EXACT,
        COARSE,
        keep_duplicates=keep_duplicates,
        regroup=lambda rest: regroup_to_lane(rest, lane_counts),
        stage=stage,
    )
    known = matched.filter(not_text_null(ORIGIN))
    with_loading = join_totals(known, stage(loading_facts(loading_view), "loading_facts"), ATTACH)
    fill = stage(fill_facts(fill_view, pad_week, year_mode), "fill_facts")
    return (
        join_totals(with_loading, fill, ATTACH)
        .withColumnsRenamed({"lane": "lane_name"})
        .drop("lane_key")
    )

"""Carrier tenders: lanes of the latest weeks, and the shipments of those weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_key
from ..functions.periods import year_week_key
from ..operators.dedupe import latest_n_periods
from ..operators.match import lookup
from ..operators.skew import join_totals

from .columns import CUSTOMER_LEVELS, SUBSECTOR_COUNTS

WEEKS_KEPT = 13

# Columns that are not part of the lane grain.
NOT_IN_LANES = [
    "actual_carr_trans_cost_amt",
    "linehaul_cost_amt",
    "incrmtl_freight_auction_cost_amt",
    "cnc_carr_mix_cost_amt",
    "unsource_cost_amt",
    "fuel_cost_amt",
    "acsrl_cost_amt",
    "forward_agent_id",
    "service_tms_code",
    "sold_to_party_id",
    "ship_cond_val",
    "primary_carr_flag",
    "month_type_val",
    "cal_year_num",
    "month_date",
    "week_num",
    "dest_postal_code",
]

# Costs and zone columns that are not part of the shipment grain.
NOT_IN_SHIPMENTS = [
    "actual_carr_trans_cost_amt",
    "linehaul_cost_amt",
    "incrmtl_freight_auction_cost_amt",
    "cnc_carr_mix_cost_amt",
    "unsource_cost_amt",
    "fuel_cost_amt",
    "acsrl_cost_amt",
    "origin_zone_code",
    "daily_award_qty",
    *SUBSECTOR_COUNTS,
    *CUSTOMER_LEVELS,
]


WEEK = "concat_week_year"
FINAL_STOP = "final_stop_postal_code"
NOT_IN_STOPS = ["origin_zone_ship_from_code", "loc_id", "loc_name"]


def lanes(
    tender_summary: DataFrame, *, weeks: int | None = WEEKS_KEPT, year_mode: str = "calendar"
) -> DataFrame:
    """Tender lanes of the latest weeks, without cost columns and duplicates.

    The week filter is applied before the rows are deduplicated, so only the kept weeks are
    shuffled.  ``weeks=None`` gives the lanes of all weeks, for a target partitioned by ``WEEK``.
    """
    rows = tender_summary.drop(*NOT_IN_LANES).withColumnRenamed(
        "region_code", "state_province_code"
    )
    keyed = rows.withColumn(
        "concat_week_year", year_week_key("week_begin_date", year_mode=year_mode)
    )
    recent = (keyed if weeks is None else latest_n_periods(keyed, WEEK, weeks)).distinct()
    return recent.withColumns(
        {
            "calendar_week_num": F.weekofyear("week_begin_date"),
            "calendar_year_num": F.year("week_begin_date"),
            "last_update_utc_tmstp": F.current_timestamp(),
        }
    )


def shipments(
    load_costs: DataFrame,
    tender_lanes: DataFrame,
    locations: DataFrame,
    *,
    match_on: Sequence[str] = ("origin_zone_ship_from_code", "dest_ship_from_code"),
    year_mode: str = "calendar",
    repeat_stops: bool = False,
    weeks: int | None = None,
) -> DataFrame:
    """Loads of the weeks in ``tender_lanes`` with their lane rows and final stop.

    ``load_costs`` may already be the result of ``weekly_loads``, read from a target partitioned by
    week.  ``weeks`` says that the lanes hold at most so many: the loads are then first cut to these
    weeks by a broadcast of that many keys, which for such a target prunes the folders of all other
    weeks at run time.

    Loads and lanes meet on the week and on ``match_on``.  ``match_on=()`` meets on the week only,
    which repeats every load for each lane of its week.  Loads are first cut down to the span of the
    lanes' weeks, which Spark does before the joins that the loads are made of, and to the weeks and
    lanes in question, then deduplicated, then joined with the stops and at last with the lanes.  Columns both sides have beyond the join
    keys come out twice, the lane's with the prefix ``lane_``.  Of several stops with one postal
    code the highest value of each column is taken; ``repeat_stops=True`` repeats the shipment for
    each of them instead.
    """
    loads = load_costs if WEEK in load_costs.columns else weekly_loads(load_costs, year_mode=year_mode)
    lane_rows = tender_lanes.drop(
        "concat_week_year", "calendar_week_num", "calendar_year_num", "last_update_utc_tmstp"
    ).distinct()
    lane_rows = lane_rows.withColumn(
        "concat_week_year", year_week_key("week_begin_date", year_mode=year_mode)
    )
    if weeks is not None:
        recent = tender_lanes.select(F.col(WEEK).alias("_week")).distinct().limit(weeks)
        loads = loads.join(F.broadcast(recent), loads[WEEK] == recent["_week"], "left_semi")
    keys = ["concat_week_year", *match_on]
    shared = [c for c in lane_rows.columns if c in loads.columns and c not in keys]
    lane_rows = lane_rows.withColumnsRenamed({c: f"lane_{c}" for c in shared})
    first, last = (lane_rows.agg(f("concat_week_year")).scalar() for f in (F.min, F.max))
    loads = loads.filter((F.col(WEEK) >= first) & (F.col(WEEK) <= last))
    in_scope = join_totals(loads, lane_rows.select(*keys).distinct(), keys, "left_semi").distinct()
    columns = in_scope.join(lane_rows, keys, "inner").columns
    if FINAL_STOP in in_scope.columns and not {*locations.columns} & {*lane_rows.columns} - {*NOT_IN_STOPS}:
        # the stops meet the loads before the lanes multiply them
        found = _with_stops(in_scope, locations, repeat_stops)
        new = [c for c in found.columns if c not in in_scope.columns]
        columns = [FINAL_STOP, *(c for c in columns if c != FINAL_STOP)] if repeat_stops else columns
        found = found.join(lane_rows, keys, "inner").select(*columns, *new)
    else:
        found = _with_stops(in_scope.join(lane_rows, keys, "inner"), locations, repeat_stops)
    return found.withColumn("last_update_utc_tmstp", F.current_timestamp())


def shipments_of_week(
    load_costs: DataFrame,
    tender_lanes: DataFrame,
    locations: DataFrame,
    *,
    year_mode: str = "calendar",
    repeat_stops: bool = False,
) -> DataFrame:
    """Loads of the weeks in ``tender_lanes`` with the number and accepted tenders of those lanes.

    What ``shipments(match_on=())`` gives when it is counted per load, without its loads x lanes
    rows: the lanes are folded to one row per week before they are joined.
    """
    week = year_week_key("week_begin_date", year_mode=year_mode)
    rows = tender_lanes.drop(
        "concat_week_year", "calendar_week_num", "calendar_year_num", "last_update_utc_tmstp"
    ).distinct()
    weeks = rows.groupBy(week.alias("concat_week_year")).agg(
        F.count(F.lit(1)).alias("lane_cnt"), F.sum("accept_cnt").alias("lane_accept_cnt")
    )
    loads = join_totals(weekly_loads(load_costs, year_mode=year_mode).distinct(), weeks, ["concat_week_year"], "inner")
    return _with_stops(loads, locations, repeat_stops)


def weekly_loads(load_costs: DataFrame, *, year_mode: str = "calendar") -> DataFrame:
    """Loads with their week, without costs; what a target partitioned by ``WEEK`` holds."""
    loads = load_costs.withColumn("load_id", normalize_key("load_id", mode="one"))
    return loads.drop(*NOT_IN_SHIPMENTS).withColumn(
        "concat_week_year", year_week_key("actual_goods_issue_date", year_mode=year_mode)
    )


def _with_stops(loads: DataFrame, locations: DataFrame, repeat_stops: bool) -> DataFrame:
    stops = locations.drop(*NOT_IN_STOPS)
    if repeat_stops:
        stops = stops.withColumnRenamed("postal_code", FINAL_STOP).distinct()
        return loads.join(stops, FINAL_STOP, "left")
    names = [c for c in stops.columns if c != "postal_code"]
    return lookup(loads, stops, {FINAL_STOP: "postal_code"}, names)

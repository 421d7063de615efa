"""Vehicle fill at delivery-item grain.

Everything that belongs to a load (shipped and planned totals, statistics, costs, cost steps,
priority) is aggregated from narrow projections and gathered into one frame with a row per load.
The items are joined with it once, which also cuts them to the first stage of their load; what
follows is computed from the cut rows, and joined on the load once more.  Frames that several steps
read are handed to ``stage``: ``items`` (with their trucks), ``costs`` (and for buckets ``freight`` and ``priorities``), ``loads`` (all
load facts), ``prepared`` (cut items with all load facts) and ``valued`` (items with their impacts).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import formulas as fx
from ..functions.formulas import apply_formulas, check_names
from ..functions.keys import normalize_key, tail_key
from ..functions.rules import clamp_floor
from ..operators.dedupe import final_stage_attr, latest_per_key
from ..operators.match import bridge, lookup
from ..operators.rollup import (
    RollupSpec,
    attach_group_total,
    distinct_then_sum,
    flatten_hierarchy,
    max_then_sum,
    wide_rollup,
)
from ..operators.skew import join_apart, join_totals
from ..operators.stage import Bucketed, Stage, no_stage
from .columns import CUSTOMER_LEVELS, SUBSECTOR_COUNTS

# Keys of an item.
ITEM_KEYS = [
    "load_id",
    "load_gbu_id",
    "material_doc_num",
    "ship_to_party_id",
    "tdcval_code",
    "dlvry_item_num",
    "vfr_freight_type_code",
    "ship_cond_desc",
    "trans_stage_num",
    "dlvry_id",
]

# Share of operating space, volume a load may hold, decimal type of the amounts.
OPERATING_SPACE = 0.11
LOAD_MAX_VOLUME = 3533.0
AMOUNT_TYPE = "decimal(38,6)"

# A lane below this weight per volume is a low-density one (a parameter of ours).
LOW_DENSITY = 0.5

LOAD_DIGITS = 9  # characters at the end of a transport number that make up the load number

# History columns of the order linkage, which are not carried on.
LINKAGE_HISTORY = ["load_tmstp", "load_from_file_name", "last_update_utc_tmstp"]

# Costs of a load.
COSTS = [
    "actual_carr_trans_cost_amt",
    "linehaul_cost_amt",
    "incrmtl_freight_auction_cost_amt",
    "cnc_carr_mix_cost_amt",
    "unsource_cost_amt",
    "fuel_cost_amt",
    "acsrl_cost_amt",
]


# Formula groups and single names that the plan reads.
FORMULAS = [
    fx.FILL_ITEM,
    fx.FILL_PREPARED,
    fx.FILL_JOINED,
    fx.FILL_ORDER,
    fx.FILL_LANE,
    fx.FILL_VALUED,
    fx.FILL_IMPACT,
    fx.FILL_FINAL,
    fx.FILL_PRIORITY,
    fx.FILL_UNITS,
    "subsector_sales_cnt",
    "vehicle_true_max_vol_qty",
    "pallet_load_qty",
    "net_density_order_qty",
]


# --- trucks ---------------------------------------------------------------------------------


def truck_releases(truck_report: DataFrame) -> DataFrame:
    """Truck totals per order, tour and release; of each order the latest release."""
    measures = ["pallet_num_qty", "pallet_spot_qty", "total_gross_weight_qty", "total_gross_vol_qty"]
    attributes = [
        "release_date",
        "release_datetm",
        "truck_type_code",
        "truck_ship_to_num",
        "truck_ship_to_desc",
        "truck_sold_to_num",
        "truck_sold_to_desc",
        "truck_ship_point_code",
    ]
    rows = truck_report.withColumns(
        {m: F.col(m).try_cast("double") for m in measures}
        | {"release_dttm": F.concat("release_date", "release_datetm")}
    )
    present = [a for a in attributes if a in rows.columns]
    spec = RollupSpec(
        ["follow_on_doc_num", "leo_tour_id", "release_dttm"], attributes=present, sums=measures
    )
    return latest_per_key(wide_rollup(rows, spec), ["follow_on_doc_num"], ["release_dttm"])


def order_loads(order_linkage: DataFrame) -> DataFrame:
    """Latest linkage row per order and transport with its other columns.

    The tail of the transport number is the load.
    """
    latest = latest_per_key(order_linkage, ["sap_order_num", "transport_num"], ["load_tmstp"])
    return latest.drop(*LINKAGE_HISTORY).withColumns(
        {
            "order_num": F.col("sap_order_num"),
            "load_id": tail_key("transport_num", LOAD_DIGITS),
            "doc_flow_order_num": F.col("sap_order_num"),
            "doc_flow_load_id": F.col("transport_num"),
        }
    ).drop("sap_order_num")


def trucks(
    order_linkage: DataFrame,
    truck_report: DataFrame,
    vehicles: DataFrame,
    formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Order to truck to vehicle, per load and order."""
    volume = (formulas or {}).get("vehicle_true_max_vol_qty", fx.VEHICLE_VOLUME)
    fleet = vehicles.withColumnsRenamed({"vehicle_type_code": "truck_vehicle_type_code"}).withColumns(
        {
            "vehicle_type2_code": F.col("truck_vehicle_type_code"),
            "vehicle_true_max_weight_qty": F.col("total_weight_qty"),
            "vehicle_true_max_vol_qty": F.expr(volume),
        }
    )
    released = truck_releases(truck_report)
    chained = bridge(
        order_loads(order_linkage),
        [
            (released, {"order_num": "follow_on_doc_num"}),
            (fleet, {"truck_type_code": "vehicle_trans_medium_code"}),
        ],
    )
    return chained.withColumns(
        {
            "follow_on_doc_num": F.col("order_num"),
            "vehicle_trans_medium_code": F.col("truck_type_code"),
        }
    )


# --- items and load facts -------------------------------------------------------------------


def normalize_items(items: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Items with load and material numbers freed of leading zeros and their business unit."""
    rows = items.withColumn("material_doc_num", normalize_key("material_doc_num"))
    return apply_formulas(rows, fx.FILL_ITEM, formulas)


def shipped_totals(items: DataFrame) -> DataFrame:
    """Shipped quantities per load: the highest of each item and material, summed."""
    kinds = ["net_vol_qty", "net_weight_qty", "gross_vol_qty", "gross_weight_qty"]
    return max_then_sum(
        items,
        ["load_id"],
        ["load_id", "dlvry_item_num", "material_doc_num"],
        {f"shipped_{k}": k for k in kinds},
    )


def planned_totals(prepared_items: DataFrame) -> DataFrame:
    """Planned quantities per load: the highest of each delivery, summed."""
    return max_then_sum(
        prepared_items,
        ["load_id"],
        ["load_id", "dlvry_id"],
        {
            "plan_gross_weight_qty": "filled_gross_weight_plan_qty",
            "plan_gross_vol_qty": "filled_gross_vol_plan_qty",
            "plan_net_weight_qty": "oblb_net_weight_plan_qty",
            "plan_net_vol_qty": "oblb_net_vol_plan_qty",
        },
    )


def load_statistics(prepared_items: DataFrame) -> DataFrame:
    """Sums, first stage and number of the distinct item rows of each load."""
    columns = [
        "load_id",
        "load_gbu_id",
        "tdcval_code",
        "material_doc_num",
        "dlvry_item_num",
        "floor_position_qty",
        "palletsshipped",
        "net_vol_qty",
        "net_weight_qty",
        "gross_weight_qty",
        "gross_vol_qty",
        "trans_stage_num",
    ]
    spec = RollupSpec(
        ["load_id"],
        attributes={"avg_palletsshipped": "palletsshipped"},
        minima={"min_trans_stage_num": "trans_stage_num"},
        sums={
            "sum_material_weight_qty": "net_weight_qty",
            "sum_material_vol_qty": "net_vol_qty",
            "sum_gross_material_weight_qty": "gross_weight_qty",
            "sum_gross_material_vol_qty": "gross_vol_qty",
        },
        row_count="shipped_load_cnt",
    )
    return wide_rollup(prepared_items.select(*columns).distinct(), spec)


def _costs(load_costs: DataFrame) -> DataFrame:
    return load_costs.withColumn("load_id", normalize_key("load_id", mode="one")).withColumnsRenamed(
        {"forward_agent_id": "carr_id", "service_tms_code": "tms_service_code"}
    )


def cost_per_load(load_costs: DataFrame) -> DataFrame:
    """Costs, subsector counts and lane attributes per load, with the mean awarded volume."""
    return _cost_per_load(_costs(load_costs))


def _cost_per_load(rows: DataFrame) -> DataFrame:
    # fixed values: lane columns of the cost rows
    lane = [
        "origin_zone_ship_from_code",
        "origin_loc_id",
        "origin_zone_code",
        "dest_ship_from_code",
        "dest_zone_code",
        "tms_service_code",
        "freight_auction_flag",
    ]
    attributes = {c: c for c in [*COSTS, *SUBSECTOR_COUNTS, *lane] if c in rows.columns}
    attributes |= {"dest_loc_code": "ship_to_party_id", "tac_freight_type_code": "freight_type_code"}
    spec = RollupSpec(["load_id"], attributes=attributes, means=["avg_award_weekly_vol_qty"])
    return wide_rollup(rows, spec).withColumn(
        "actual_carr_total_trans_cost_usd_amt", F.col("actual_carr_trans_cost_amt")
    )


def awarded_volume(load_costs: DataFrame) -> DataFrame:
    """Highest awarded volume per load, carrier and service."""
    return _awarded_volume(_costs(load_costs))


def _awarded_volume(rows: DataFrame) -> DataFrame:
    spec = RollupSpec(
        ["load_id", "carr_id", "tms_service_code"],
        attributes={"avg_average_awarded_weekly_volume": "avg_award_weekly_vol_qty"},
    )
    return wide_rollup(rows, spec)


def freight_per_load(freight_stats: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Step factor, charge code and statistical units per load."""
    return _freight_per_load(_freight(freight_stats), formulas)


def _freight(freight_stats: DataFrame) -> DataFrame:
    rows = freight_stats.withColumn("load_id", normalize_key("shpmt_id", mode="one"))
    return rows.select("load_id", "step_per_load_rate", "freight_cost_charge_code", "su_per_load_qty")


def _freight_per_load(rows: DataFrame, formulas: Mapping[str, str] | None) -> DataFrame:
    steps = rows.groupBy("load_id").agg(
        F.max("step_per_load_rate").alias("step_factor"),
        F.max("freight_cost_charge_code").alias("max_freight_cost_charge_code"),
    )
    texts = apply_formulas(rows.select("load_id", "su_per_load_qty").distinct(), fx.FILL_UNITS, formulas)
    units = texts.groupBy("load_id").agg(F.sum("su_per_load_cnt").alias("su_per_load_cnt"))
    return steps.join(units, "load_id", "left")


def load_priority(events: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Load builder priority per load, where it is positive."""
    return _load_priority(_priorities(events, formulas))


def _priorities(events: DataFrame, formulas: Mapping[str, str] | None) -> DataFrame:
    rows = apply_formulas(events.select("load_id", "load_builder_prty_val"), fx.FILL_PRIORITY, formulas)
    return rows.filter("load_builder_prty_val > 0")


def _load_priority(rows: DataFrame) -> DataFrame:
    return rows.groupBy("load_id").agg(F.max("load_builder_prty_val").alias("load_builder_prty_val"))


def ship_to_hierarchy(
    load_costs: DataFrame,
    customers: DataFrame,
    trade_channels: DataFrame,
    customer_flags: DataFrame,
    coherent: bool = False,
) -> DataFrame:
    """One row per ship-to: customer levels, trade channel and flag."""
    levels = [c for c in CUSTOMER_LEVELS if c in load_costs.columns]
    flat = flatten_hierarchy(load_costs, "ship_to_party_id", levels, coherent)
    channel = customers.distinct().join(trade_channels.distinct(), "trade_chanl_id", "inner")
    names = [c for c in channel.columns if c != "cust_id"]
    flat = lookup(flat, channel, {"customer_lvl12_code": "cust_id"}, names)
    return lookup(flat, customer_flags, ["customer_lvl3_desc"], ["sambc_flag"])


def by_load(
    delivery_items: DataFrame,
    events: DataFrame,
    order_linkage: DataFrame,
    truck_report: DataFrame,
    vehicles: DataFrame,
    load_costs: DataFrame,
    freight_stats: DataFrame,
    *,
    formulas: Mapping[str, str] | None = None,
    one_truck: bool = True,
    stage: Stage = no_stage,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Items with their trucks, costs, freight statistics and priorities, all with a load key."""
    rows = normalize_items(delivery_items, formulas)
    chain = trucks(order_linkage, truck_report, vehicles, formulas)
    if isinstance(stage, Bucketed) and stage.keys.get("items") == ["load_id"]:
        # items and trucks meet in the buckets, so that the wide items are dealt out once
        rows, chain = stage.dealt(rows, "items"), stage.dealt(chain, "items")
    if one_truck:
        chain = latest_per_key(chain, ["load_id", "order_num"], ["release_dttm"])
    items = _with_trucks(rows, chain, formulas, one_truck)
    return (
        stage(items, "items"),
        stage(_costs(load_costs), "costs"),
        stage(_freight(freight_stats), "freight"),
        stage(_priorities(events, formulas), "priorities"),
    )


def load_facts(
    items: DataFrame,
    costs: DataFrame,
    freight: DataFrame,
    priorities: DataFrame,
    formulas: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per load of the items with all that is known about it; takes the frames of ``by_load``.

    Every step is an aggregate or a join on the load, so over frames bucketed by it (``Bucketed``)
    the whole chain runs without an exchange.
    """
    loads = load_statistics(items)
    for frame in (
        shipped_totals(items),
        planned_totals(items),
        _cost_per_load(costs),
        _freight_per_load(freight, formulas),
        _load_priority(priorities),
        final_stage_attr(
            items, "load_id", "trans_stage_num", ["ship_to_party_id", "ship_to_party_desc"]
        ),
    ):
        loads = loads.join(frame, "load_id", "left")
    return loads


# --- the plan -------------------------------------------------------------------------------


def build(
    delivery_items: DataFrame,
    events: DataFrame,
    order_linkage: DataFrame,
    truck_report: DataFrame,
    vehicles: DataFrame,
    load_costs: DataFrame,
    freight_stats: DataFrame,
    customers: DataFrame,
    trade_channels: DataFrame,
    customer_flags: DataFrame,
    value_categories: DataFrame,
    origin_names: DataFrame,
    *,
    formulas: Mapping[str, str] | None = None,
    low_density: float = LOW_DENSITY,
    operating_space: float = OPERATING_SPACE,
    load_max_volume: float = LOAD_MAX_VOLUME,
    coherent_hierarchy: bool = False,
    keep_null_keys: bool = True,
    one_truck: bool = True,
    unit_salts: int = 16,
    stage: Stage = no_stage,
    lookups: Stage = no_stage,
) -> DataFrame:
    """Items at the first stage of their load, one row per distinct source row.

    An item with a NULL in one of ``ITEM_KEYS`` other than its load and stage is kept;
    ``keep_null_keys=False`` drops it, as a join on these keys does.  ``one_truck=False`` repeats an
    item for every truck of its load and order instead of taking the latest release.  ``unit_salts``
    spreads the few, large business units when their totals are attached.  A ``lookups`` stage that
    writes spares the items a shuffle for each lookup, lane and unit total, as far as these are small; the lanes
    and totals are then computed from what ``stage`` wrote as ``prepared``, which it has to write.
    """
    check_names(formulas, *FORMULAS)
    items, costs, freight, priorities = by_load(
        delivery_items,
        events,
        order_linkage,
        truck_report,
        vehicles,
        load_costs,
        freight_stats,
        formulas=formulas,
        one_truck=one_truck,
        stage=stage if isinstance(stage, Bucketed) else _several_read(stage),
    )
    loads = stage(load_facts(items, costs, freight, priorities, formulas), "loads")
    if isinstance(stage, Bucketed) and stage.together("items", "loads"):
        joined = items.join(loads, "load_id", "inner")
    else:
        joined = join_totals(items, loads, ["load_id"], "inner", keep_salt=True)
    joined = joined.filter("trans_stage_num = min_trans_stage_num")
    if not keep_null_keys:
        joined = joined.dropna(subset=ITEM_KEYS)
    # Duplicates only matter here: every aggregate above is indifferent to them.
    # The salt of the join follows from the load and stays until here, so rows are already dealt out.
    joined = joined.distinct().drop("_salt")
    awarded = _awarded_volume(costs)
    joined = join_totals(joined, awarded, ["load_id", "carr_id", "tms_service_code"])
    hierarchy = ship_to_hierarchy(
        costs, customers, trade_channels, customer_flags, coherent_hierarchy
    )
    joined = join_totals(joined, hierarchy, ["ship_to_party_id"])
    joined = lookup(joined, value_categories, ["tdcval_code"], {"categ_name": "category"}, stage=lookups)
    prepared = stage(_joined_formulas(joined, formulas), "prepared")

    shares = pallets_per_load(prepared, formulas).join(load_averages(prepared, formulas), "load_id")
    valued = join_totals(prepared, shares, ["load_id"])
    lanes = lookups(lane_density(prepared, formulas, low_density), "lanes")
    valued = join_totals(valued, lanes, ["origin_zone_ship_from_code", "dest_ship_from_code"])
    valued = apply_formulas(valued, fx.FILL_VALUED, formulas, operating_space=operating_space)
    valued = lookup(
        valued,
        origin_names,
        {"origin_zone_ship_from_code": "origin_sf_dict"},
        {"origin_site_name": "site_name"},
        stage=lookups,
    )
    valued = stage(_impacts(valued, formulas, load_max_volume), "valued")

    amounts = ["max_orders_incrmtl_amt", "max_orders_non_drp_amt", "hopade_amt", "drf_last_truck_amt"]
    total = attach_group_total(
        valued,
        ["load_gbu_id"],
        amounts,
        salts=unit_salts,
        salt_by=["load_id", "dlvry_id", "dlvry_item_num"],
        stage=lookups,
    )
    final = apply_formulas(total, fx.FILL_FINAL, formulas)
    return final.withColumn("last_update_utc_tmstp", F.current_timestamp())


def _several_read(stage: Stage) -> Stage:
    """Freight statistics and priorities only feed the load facts, so they are left in the plan."""
    return lambda df, name: df if name in ("freight", "priorities") else stage(df, name)


def _with_trucks(
    items: DataFrame, chain: DataFrame, formulas: Mapping[str, str] | None, one_truck: bool
) -> DataFrame:
    keys = ["load_id", "order_num"]
    rows = join_totals(items, chain, keys) if one_truck else join_apart(items, chain, keys, "left")
    return apply_formulas(rows, fx.FILL_PREPARED, formulas)


def _joined_formulas(joined: DataFrame, formulas: Mapping[str, str] | None) -> DataFrame:
    steps = [f"COALESCE(try_cast({c} AS DOUBLE), 0D)" for c in SUBSECTOR_COUNTS if c in joined.columns]
    group = fx.FILL_JOINED | {"subsector_sales_cnt": " + ".join(steps) or "0D"} | fx.FILL_ORDER
    return apply_formulas(joined, group, formulas)


def lane_density(
    prepared: DataFrame, formulas: Mapping[str, str] | None = None, low_density: float = LOW_DENSITY
) -> DataFrame:
    """Density per lane, over the distinct quantity tuples of its loads."""
    lane = ["origin_zone_ship_from_code", "dest_ship_from_code"]
    measures = [
        "filled_gross_weight_plan_qty",
        "filled_gross_vol_plan_qty",
        "oblb_gross_weight_shipped_qty",
        "oblb_gross_vol_shipped_qty",
        "shipped_gross_weight_qty",
        "shipped_gross_vol_qty",
    ]
    rows = prepared.filter(F.col(lane[0]).isNotNull())
    sums = distinct_then_sum(rows, lane, measures, grain=["load_id", "origin_freight_code"])
    named = apply_formulas(sums, fx.FILL_LANE, formulas, low_density=low_density)
    return named.select(*lane, *fx.FILL_LANE)


def pallets_per_load(prepared: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    text = (formulas or {}).get("pallet_load_qty", fx.PALLETS_PER_LOAD)
    shares = prepared.select("load_id", "pallet_shipped_qty", "shipped_load_cnt").distinct()
    return shares.groupBy("load_id").agg(F.sum(F.expr(text)).alias("pallet_load_qty"))


def load_averages(prepared: DataFrame, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Means of the order quantities per load, over distinct tuples, and their density."""
    means = {
        "avg_max_weight_net_order": "max_net_weight_order_qty",
        "avg_net_vol_fill_rate": "net_vol_fill_rate",
        "avg_net_weight_order_qty": "net_weight_order_qty",
        "avg_net_vol_order_qty": "net_vol_order_qty",
    }
    tuples = prepared.select("load_id", *means.values(), "pallet_spot_qty").distinct()
    spec = RollupSpec(["load_id"], means=means, sums={"sum_pallet_spot_qty": "pallet_spot_qty"})
    text = (formulas or {}).get("net_density_order_qty", fx.NET_DENSITY_PER_LOAD)
    return wide_rollup(tuples, spec).withColumn("net_density_order_qty", F.expr(text))


def _impacts(rows: DataFrame, formulas: Mapping[str, str] | None, max_volume: float) -> DataFrame:
    """Impact columns; decimal copies of three of them, and no negative values in six columns."""
    rows = apply_formulas(rows, fx.FILL_IMPACT, formulas, load_max_volume=max_volume)
    copies = {
        f"{c}_dec": clamp_floor(F.col(c).try_cast(AMOUNT_TYPE)).cast(AMOUNT_TYPE)
        for c in ("hopade_amt", "drf_last_truck_amt", "max_orders_non_drp_amt")
    }
    clamped = {
        c: clamp_floor(c)
        for c in ("glb_segment_impact_cat_ld_amt", "max_orders_incrmtl_amt", "cut_impact_rate")
    }
    return rows.withColumns(copies | clamped)

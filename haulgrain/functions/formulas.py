"""Named formulas of the plans, as Spark SQL text.

A formula is the definition of one output column.  The ones here are this library's own: simple,
documented readings of what the column name says.  A deployment that has its own definitions
passes them to a plan as ``formulas={"column": "SQL text"}``; they replace the default of the same
name and may use every column present at that stage and every other formula of its group.

All divisions go through ``try_divide`` and all casts through ``try_cast``, so bad input gives
NULL also under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of the on-time event fact.
ON_TIME_ROW = {
    "dest_sold_to_name": "COALESCE(customer_desc, ship_to_party_desc)",
    "lot_delay_code": "COALESCE(lot_delay_reason_code, '')",
    "lot_delay_code_desc": "COALESCE(lot_delay_reason_code_desc, '')",
    "otd_cnt": "CASE WHEN length(lot_delay_reason_code) > 0 THEN 0 ELSE 1 END",
    "tat_late_counter_val": "CASE WHEN length(lot_delay_reason_code) > 0 THEN 1 ELSE 0 END",
    "lot_delay_bucket_val": "COALESCE(NULLIF(lot_delay_reason_code_desc, ''), 'No delay')",
    "parent_carr_name": "split_part(carr_desc, '#', 1)",
    "freight_auction_flag": "CASE WHEN actual_service_tms_code IS NULL THEN 'Y' ELSE 'N' END",
    "primary_carr_flag": "CASE WHEN carr_num IS NOT NULL THEN 'Y' ELSE 'N' END",
    "exception_flag": "CASE WHEN change_type_code IS NULL THEN 'Y' ELSE 'N' END",
}

# Rows of the on-time result, after the rollup to its ten-column key.
ON_TIME_RESULT = {
    "on_time_pct": "try_divide(COALESCE(shpmt_on_time_cnt, 0) * 100D, measrbl_shpmt_cnt)",
    "lot_rate": "try_divide(otd_cnt * 1D, otd_cnt + tat_late_counter_val)",
    "lot_flag": "CASE WHEN tat_late_counter_val > 0 THEN 'N' ELSE 'Y' END",
    "gbu_code": "COALESCE(unit_code, 'OTHER')",
    "customer_name": "COALESCE(lookup_customer_name, dest_sold_to_name)",
    "channel_name": "COALESCE(lookup_channel_name, 'OTHER')",
}

# First events per load and stage.
FIRST_EVENT = {
    "first_event_on_time": "CASE WHEN actual_dlvry_tmstp <= first_appt_dlvry_tmstp THEN 1 "
    "WHEN actual_dlvry_tmstp > first_appt_dlvry_tmstp THEN 0 END",
}

# Loads of the on-time result, for the inter-plant columns.
ON_TIME_LOAD = {
    "iot_shpmt_on_time_load_id": "CASE WHEN load_on_time = 1 THEN try_cast(load_id AS BIGINT) END",
    "iot_measrbl_shpmt_load_id": "CASE WHEN measrbl_shpmt_cnt = 1 THEN try_cast(load_id AS BIGINT) END",
}

# Tender rows of the scorecard.
SCORECARD_TENDER = {
    "long_forward_agent_id": "CASE WHEN length(forward_agent_id) >= 10 THEN forward_agent_id "
    "ELSE lpad(forward_agent_id, 10, '0') END",
}

LOADING = {
    "ship_month": "month(event_date)",
    "ship_year": "year(event_date)",
    "ship_3lettermonth": "date_format(event_date, 'MMM')",
    "lot_otd_cnt": "CASE WHEN load_end_date <= ready_date THEN 1 ELSE 0 END",
    "lot_tat_late_counter_val": "CASE WHEN load_end_date > ready_date THEN 1 ELSE 0 END",
    "country_to_desc": "COALESCE(country_to_code, 'UNKNOWN')",
}

# Events of the fill plan.
FILL_PRIORITY = {
    "load_builder_prty_val": "try_cast(load_builder_prty_val AS INT)",
}

# Freight statistics of the fill plan; the text is the distinct one.
FILL_UNITS = {
    "su_per_load_cnt": "try_cast(su_per_load_qty AS DOUBLE)",
}

FILL_ITEM = {
    "load_id": "trim(LEADING '0' FROM load_id)",
    "gi_month_num": "month(try_cast(actual_goods_issue_date AS DATE))",
    "load_gbu_id": "gbu_code",
}

# Vehicles.
VEHICLE_VOLUME = (
    "vehicle_inner_length_val * vehicle_inner_width_val * vehicle_inner_height_val"
)

# Items with the truck data of their order.
FILL_PREPARED = {
    "filled_gross_weight_plan_qty": "COALESCE(oblb_gross_weight_plan_qty, total_gross_weight_qty)",
    "filled_gross_vol_plan_qty": "COALESCE(oblb_gross_vol_plan_qty, total_gross_vol_qty)",
    "ordered_shipped_flag": "CASE WHEN follow_on_doc_num IS NULL THEN 'S' ELSE 'O' END",
    "palletsshipped": "COALESCE(pallet_num_qty, floor_position_qty)",
}

# Items with everything known about their load.
FILL_JOINED = {
    "min_trans_stage_flag": "CASE WHEN trans_stage_num = min_trans_stage_num THEN 'Y' ELSE 'N' END",
    "weight_vol_plan_qty": "try_divide(filled_gross_weight_plan_qty, filled_gross_vol_plan_qty)",
    "weight_vol_ship_qty": "try_divide(shipped_gross_weight_qty, shipped_gross_vol_qty)",
    "origin_freight_code": "concat(origin_zone_ship_from_code, '-', vfr_freight_type_code)",
    "primary_carr_flag": "CASE WHEN avg_average_awarded_weekly_volume > 0 THEN 'Y' ELSE 'N' END",
    "pallet_shipped_qty": "avg_palletsshipped",
    "true_fa_flag": "CASE WHEN freight_auction_flag = 'Y' THEN 'Y' ELSE 'N' END",
    "density_rate": "weight_vol_ship_qty",
    "load_material_weight_qty": "try_divide(net_weight_qty, sum_material_weight_qty)",
    "load_material_vol_qty": "try_divide(net_vol_qty, sum_material_vol_qty)",
    "combined_gbu_code": "COALESCE(load_gbu_id, 'OTHER')",
    "custom_vehicle_fill_rate_id": "concat(load_id, '-', COALESCE(load_gbu_id, 'OTHER'))",
}

# Order quantities of an item; their means per load are taken over distinct tuples.
FILL_ORDER = {
    "net_vol_order_qty": "plan_net_vol_qty",
    "net_weight_order_qty": "plan_net_weight_qty",
    "net_vol_fill_rate": "try_divide(shipped_net_vol_qty, max_vol_trans_mgmt_sys_qty)",
    "max_net_weight_order_qty": "greatest(plan_net_weight_qty, shipped_net_weight_qty)",
}

# Lanes.
FILL_LANE = {
    "load_density_rate": "try_divide(shipped_gross_weight_qty, shipped_gross_vol_qty)",
    "low_density_site_val": "CASE WHEN try_divide(shipped_gross_weight_qty, shipped_gross_vol_qty)"
    " < {low_density} THEN 'Low' ELSE 'Normal' END",
}

PALLETS_PER_LOAD = "try_divide(pallet_shipped_qty, shipped_load_cnt)"

# Items after the load and lane results were attached.
FILL_VALUED = {
    "total_load_cost_amt": "COALESCE(actual_carr_total_trans_cost_usd_amt, actual_cost_amt)",
    "check_density": "CASE WHEN density_rate < load_density_rate THEN 1 ELSE 0 END",
    "pallet_impact_pct": "1D - try_divide(pallet_shipped_qty, max_pallet_tms_trans_type_qty)",
    "pallet_impact_amt": "pallet_impact_pct * total_load_cost_amt",
    "opertng_space_impact_amt": "{operating_space} * total_load_cost_amt",
    "opertng_space_pct": "{operating_space}",
}

NET_DENSITY_PER_LOAD = "try_divide(avg_net_weight_order_qty, avg_net_vol_order_qty)"

# Items with the averages of their load: capacity gaps and their value.
FILL_IMPACT = {
    "cases_impact_amt": "(1D - net_vol_fill_rate) * total_load_cost_amt",
    "for_max_net_vol_cal": "try_divide(max_net_weight_order_qty, net_density_order_qty)",
    "max_net_vol_qty": "greatest(plan_net_vol_qty, shipped_net_vol_qty)",
    "combined_load_max_weight_qty": "CAST(max_weight_qty AS DOUBLE)",
    "combined_load_max_vol_qty_old": "CAST(max_vol_trans_mgmt_sys_qty AS DOUBLE)",
    "combined_load_max_vol_qty": "{load_max_volume}",
    "calc_std_weight_qty": "net_density_order_qty * combined_load_max_vol_qty",
    "hopade_amt": "combined_load_max_weight_qty - shipped_gross_weight_qty",
    "max_orders_incrmtl_amt": "plan_net_weight_qty - shipped_net_weight_qty",
    "glb_segment_impact_cat_ld_amt": "plan_net_vol_qty - shipped_net_vol_qty",
    "drf_last_truck_amt": "max_vol_trans_mgmt_sys_qty - shipped_gross_vol_qty",
    "cut_impact_rate": "1D - try_divide(shipped_gross_weight_qty, plan_gross_weight_qty)",
    "max_orders_non_drp_amt": "max_net_weight_order_qty - net_weight_order_qty",
    "prod_density_gap_impact_pct": "try_divide(load_density_rate - density_rate, load_density_rate)",
    "prod_density_gap_impact_amt": "prod_density_gap_impact_pct * total_load_cost_amt",
}

# Last stage of the item grain.
FILL_FINAL = {
    "total_vf_optny_amt": "COALESCE(max_orders_incrmtl_amt, 0) + COALESCE(hopade_amt_dec, 0)"
    " + COALESCE(drf_last_truck_amt_dec, 0) + COALESCE(max_orders_non_drp_amt_dec, 0)",
    "weight_avg_qty": "oblb_gross_weight_plan_qty",
    "load_oblb_gross_weight_plan_qty": "oblb_gross_weight_plan_qty",
    "load_oblb_gross_vol_plan_qty": "oblb_gross_vol_plan_qty",
    "tac_freight_type_code": "COALESCE(tac_freight_type_code, vfr_freight_type_code)",
    "recvng_live_drop_code": "COALESCE(recvng_live_drop_code, 'Live')",
    "pre_load_type_code": "COALESCE(pre_load_type_code, 'None')",
}

# Plan and shipped quantities of an item as the load rollup reads them.
FILL_BUCKETS = {
    f"{c}_load": f"COALESCE({c}, 0)"
    for c in (
        "oblb_gross_weight_plan_qty",
        "oblb_gross_weight_shipped_qty",
        "oblb_net_weight_plan_qty",
        "oblb_gross_vol_plan_qty",
        "oblb_gross_vol_shipped_qty",
        "oblb_net_vol_plan_qty",
    )
}

# A load total spread over its business units by their share of material weight or volume.
FILL_SHARES = {
    "agg_gross_weight_qty": "total_gross_weight_qty * load_material_weight_qty",
    "agg_gross_vol_qty": "total_gross_vol_qty * load_material_vol_qty",
    "agg_net_weight_qty": "unit_plan_net_weight_qty * load_material_weight_qty",
    "agg_net_vol_qty": "unit_plan_net_vol_qty * load_material_vol_qty",
}

UNIT_COST_GBU = "unit_code"


def check_names(overrides: Mapping[str, str] | None, *groups: Mapping[str, str] | str) -> None:
    """Refuse overrides that none of a plan's formula groups or single names knows."""
    known = {n for g in groups for n in ([g] if isinstance(g, str) else g)}
    unknown = sorted(set(overrides or ()) - known)
    if unknown:
        raise ValueError(f"unknown formulas: {unknown}; known are {sorted(known)}")


def references(text: str) -> set[str]:
    """Names of the columns that a formula reads, in lower case, as Spark's own parser sees them.

    Words in quotes, functions, types and variables of lambda functions are no columns; of a field
    like ``a.b`` the first part counts.
    """
    parser = SparkSession.active()._jsparkSession.sessionState().sqlParser()
    parsed = parser.parseExpression(text)
    leaves = [(leaf.getClass().getSimpleName(), leaf) for leaf in _items(parsed.collectLeaves())]
    if any(kind == _IN_LAMBDA for kind, _ in leaves):
        return _outside(parsed, frozenset())
    return {_name(leaf) for kind, leaf in leaves if kind == "UnresolvedAttribute"}


_IN_LAMBDA = "UnresolvedNamedLambdaVariable"


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _name(leaf) -> str:
    return leaf.nameParts().head().lower()


def _outside(node, variables: frozenset[str]) -> set[str]:
    """Names in an expression that no lambda around them declares; inside lambdas the parser marks all names alike."""
    kind = node.getClass().getSimpleName()
    if kind in ("UnresolvedAttribute", _IN_LAMBDA):
        return {_name(node)} - variables
    if kind == "LambdaFunction":
        return _outside(node.function(), variables | {_name(x) for x in _items(node.arguments())})
    return set().union(*(_outside(child, variables) for child in _items(node.children())))


def layers(formulas: Mapping[str, str]) -> list[list[str]]:
    """Formula names in steps: a formula reads formulas of earlier steps only.

    A name that is also a formula of the group means that formula's value, wherever it is listed; a
    formula that reads its own name means the column it replaces.  Formulas that read one another in
    a circle are an error that names them.
    """
    by_name = {name.lower(): name for name in formulas}
    reads = {name: {by_name[r] for r in references(text) if r in by_name} - {name} for name, text in formulas.items()}
    done: set[str] = set()
    steps = []
    while len(done) < len(reads):
        ready = [name for name in reads if name not in done and reads[name] <= done]
        if not ready:
            raise ValueError(f"formulas in a circle: {' -> '.join(_circle(reads, done))}")
        steps.append(ready)
        done.update(ready)
    return steps


def _circle(reads: Mapping[str, set[str]], done: set[str]) -> list[str]:
    """One circle among the formulas that are not done: from any of them, always to one that it reads."""
    name = next(n for n in reads if n not in done)
    path: list[str] = []
    while name not in path:
        path.append(name)
        name = min(reads[name] - done)
    return [*path[path.index(name) :], name]


def apply_formulas(
    df: DataFrame,
    defaults: Mapping[str, str],
    overrides: Mapping[str, str] | None = None,
    only: Iterable[str] | None = None,
    **parameters: float,
) -> DataFrame:
    """Add the columns of a formula group; a formula may use any other of the group (``layers``).

    Each step of formulas that don't read one another is one projection.
    """
    overrides = overrides or {}
    texts = {name: overrides.get(name, defaults[name]) for name in only or defaults}
    if parameters:
        texts = {n: t.format(**{k: f"{v!r}D" for k, v in parameters.items()}) for n, t in texts.items()}
    for step in layers(texts):
        df = df.withColumns({name: F.expr(texts[name]) for name in step})
    return df

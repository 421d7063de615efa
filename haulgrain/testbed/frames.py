"""Freight source tables derived from the supplied order tables.

Each frame is one SELECT in the common subset of Spark SQL and DuckDB, with the table names in
braces: Spark reads it through ``spark.sql`` with frames as arguments, the oracle inlines it as a
common table expression.  Every frame is derived from whole tables: rows that are to meet nothing
keep their place and get a key that no other frame has.

Stand-ins: an order is a load, a line item an event or delivery item, the supplier's nation the
origin, the customer's nation the destination, the supplier the carrier, the part's brand the
business unit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

def _items(*with_tables: str) -> str:
    """Line items joined with the tables a frame needs: order, customer, supplier, part."""
    joins = {
        "order": "JOIN {orders} o ON l.l_orderkey = o.o_orderkey",
        "customer": """JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} cn ON c.c_nationkey = cn.n_nationkey
JOIN {region} cr ON cn.n_regionkey = cr.r_regionkey""",
        "supplier": """JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} sn ON s.s_nationkey = sn.n_nationkey
JOIN {region} sr ON sn.n_regionkey = sr.r_regionkey""",
        "part": "JOIN {part} p ON l.l_partkey = p.p_partkey",
    }
    return "\n".join(["FROM {lineitem} l", *(joins[t] for t in with_tables)])


def _two(number: str) -> str:
    return f"lpad(cast({number} AS STRING), 2, '0')"


def _dmy(day: str) -> str:
    return f"{_two(f'day({day})')} || '/' || {_two(f'month({day})')} || '/' || cast(year({day}) AS STRING)"


def _ymd(day: str) -> str:
    return f"cast(year({day}) AS STRING) || {_two(f'month({day})')} || {_two(f'day({day})')}"


def _week(day: str) -> str:
    return f"{_two(f'weekofyear({day})')} || '/' || cast(year({day}) AS STRING)"


_LOAD = "cast(300000000 + l.l_orderkey AS STRING)"
_ORDER = "cast(l.l_orderkey AS STRING) || '-' || l.l_returnflag"

ON_TIME_EVENTS = f"""
SELECT
  {_LOAD} AS load_id,
  CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' AND l.l_linenumber = 7
       THEN '0' || cast(300000000 + l.l_partkey AS STRING) ELSE '' END AS child_shpmt_num,
  cast(l.l_linenumber AS STRING) AS trnsp_stage_num,
  CASE WHEN l.l_quantity = 50 THEN '99991231235959'
       ELSE {_ymd('l.l_shipdate')} || {_two('l.l_linenumber')} || '3000' END AS event_datetm,
  CASE l.l_returnflag WHEN 'A' THEN 'PICKCI' WHEN 'R' THEN 'PICKCO' ELSE 'DLVRY' END
    AS change_type_code,
  CASE WHEN l.l_discount >= 0.05 THEN 'R' || cast(l.l_linenumber AS STRING) ELSE '' END
    AS lot_delay_reason_code,
  CASE WHEN l.l_discount >= 0.05 THEN 'Reason ' || cast(l.l_linenumber AS STRING)
       WHEN l.l_discount >= 0.03 THEN 'x' ELSE '' END AS lot_delay_reason_code_desc,
  {_dmy('l.l_shipdate')} AS actual_load_end_date,
  CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE {_dmy('o.o_orderdate')} END AS final_lrdt_date,
  {_ORDER} AS order_num,
  CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'PO' || cast(o.o_custkey AS STRING) END
    AS cust_po_num,
  cast(c.c_custkey AS STRING) AS ship_to_party_code,
  c.c_name AS ship_to_party_desc,
  CASE WHEN l.l_shipdate <= o.o_orderdate THEN 'On Time' WHEN l.l_tax > 0.04 THEN 'Customer'
       ELSE 'Carrier' END AS failure_bucket_name,
  CASE WHEN l.l_shipdate <= o.o_orderdate OR l.l_tax = 0 THEN 'On Time'
       WHEN l.l_tax > 0.04 THEN 'Customer' ELSE 'Carrier' END AS failure_bucket_updated_name,
  substr(o.o_orderpriority, 1, 1) AS on_time_src_code,
  o.o_orderpriority AS on_time_src_desc,
  CASE WHEN l.l_linenumber = 4 THEN 'NULL' ELSE {_dmy('o.o_orderdate')} END
    AS first_dlvry_appt_date,
  '08:00:00' AS first_dlvry_appt_datetm,
  {_dmy('o.o_orderdate')} AS last_dlvry_appt_date,
  '18:00:00' AS last_dlvry_appt_datetm,
  CASE WHEN o.o_orderstatus <> 'P' THEN {_dmy('o.o_orderdate')} END AS request_dlvry_to_date,
  '12:00:00' AS request_dlvry_to_datetm,
  CASE WHEN l.l_linenumber = 7 THEN '99/99/2020' ELSE {_dmy('o.o_orderdate')} END
    AS orig_request_dlvry_to_date,
  '13:00:00' AS orig_request_dlvry_to_datetm,
  {_dmy('l.l_shipdate')} AS actual_shpmt_end_date,
  {_two('8 + l.l_linenumber')} || ':15:00' AS actual_arrival_datetm,
  l.l_shipdate AS actual_dlvry_tmstp,
  o.o_orderdate AS first_appt_dlvry_tmstp,
  CASE WHEN l.l_returnflag = 'N' THEN 'ORDD' WHEN o.o_orderpriority = '1-URGENT' THEN 'APFD'
       WHEN o.o_orderpriority = '2-HIGH' THEN 'RDDAPL' WHEN o.o_orderpriority = '3-MEDIUM' THEN 'RDD'
       WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'OTIF' ELSE 'NONE' END AS profl_method_code,
  CASE WHEN o.o_orderstatus = 'F' THEN '7' ELSE '3' END AS sd_doc_item_overall_process_status_val,
  CASE WHEN l.l_linenumber = 6 THEN 'NULL' ELSE {_dmy('o.o_orderdate')} END AS schedule_date,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE {_dmy('o.o_orderdate')} END AS tender_date,
  CASE WHEN l.l_returnflag = 'A' THEN 'Drop' WHEN l.l_returnflag = 'R' THEN 'Live'
       WHEN l.l_linestatus = 'F' THEN '' ELSE 'Other' END AS drop_live_ind_desc,
  CASE WHEN s.s_acctbal < 0 THEN '' ELSE sn.n_name END AS origin_zone_code,
  cn.n_name AS dest_city_name,
  cr.r_name AS dest_state_code,
  cast(cn.n_nationkey AS STRING) AS dest_postal_code,
  cast(s.s_suppkey AS STRING) AS ship_point_code,
  cast(s.s_suppkey AS STRING) AS ship_point_at_point_of_dprtr_code,
  sn.n_name AS ship_point_desc,
  cast(s.s_suppkey AS STRING) AS carr_num,
  s.s_name AS carr_desc,
  l.l_returnflag AS actual_service_tms_code,
  cn.n_name AS dest_ship_from_code,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'INTERPLANT' ELSE 'CUSTOMER' END AS true_frt_type_desc,
  {_week('l.l_shipdate')} AS ship_week_num,
  c.c_mktsegment AS customer_desc,
  cr.r_name AS country_to_code,
  'Z' || cast(cn.n_nationkey AS STRING) AS dest_zone_code,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Plant' ELSE 'Trade' END AS frt_type_desc,
  cast(l.l_linenumber - 2 AS STRING) AS load_builder_prty_val
{_items('order', 'customer', 'supplier')}
"""

ORIGIN_UNITS = """
SELECT CASE WHEN s_acctbal > 1000 THEN cast(s_suppkey AS STRING) ELSE 'none' END AS origin_id,
       n_name AS parent_loc_code, 'U' || cast(n_regionkey AS STRING) AS gbu_code
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT CASE WHEN s_acctbal > 2000 THEN cast(s_suppkey AS STRING) ELSE 'none' END,
       n_name, 'A' || cast(n_regionkey AS STRING)
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

DESTINATION_CHANNELS = """
SELECT DISTINCT CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment ELSE 'none' END
         AS dest_sold_to_name,
       'Group ' || c_mktsegment AS customer_name,
       'Channel ' || substr(c_mktsegment, 1, 1) || cast(c_nationkey AS STRING) AS channel_name
FROM {customer}
"""

SHIP_TO_FLAGS = """
SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN cast(c_custkey AS STRING) ELSE 'none' END
         AS ship_to_num,
       CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS ship_to_flag
FROM {customer}
"""

ON_TIME_REASONS = """
SELECT DISTINCT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'none' END
         AS definition_name,
       'Cause ' || o_orderpriority AS cause_desc
FROM {orders}
"""

FREIGHT_STATS = f"""
SELECT '0' || {_LOAD} AS shpmt_id,
  cast(p.p_size AS STRING) AS distance_per_load_qty,
  cast(l.l_linenumber AS DOUBLE) AS step_per_load_rate,
  l.l_returnflag AS freight_cost_charge_code,
  CASE WHEN l.l_linenumber = 7 THEN 'abc'
       WHEN l.l_linenumber = 1 THEN cast(cast(l.l_quantity AS BIGINT) AS STRING) || '.0'
       ELSE cast(cast(l.l_quantity AS BIGINT) AS STRING) END AS su_per_load_qty
FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey
"""

DELIVERY_ITEMS = f"""
SELECT '0' || {_LOAD} AS load_id,
  CASE WHEN p.p_size = 50 THEN NULL ELSE p.p_brand END AS gbu_code,
  'Unit ' || p.p_brand AS gbu_desc,
  cast(l.l_suppkey AS STRING) AS carr_id,
  {_ORDER} AS order_num,
  cast(l.l_orderkey AS STRING) || '/' || cast(l.l_linenumber AS STRING) AS dlvry_id,
  cast(l.l_linenumber AS STRING) AS dlvry_item_num,
  lpad(cast(l.l_partkey AS STRING), 18, '0') AS material_doc_num,
  p.p_type AS tdcval_code,
  CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 2 END AS trans_stage_num,
  CASE WHEN l.l_linestatus = 'O' THEN 'DC' || cast(sn.n_nationkey AS STRING)
       ELSE cast(c.c_custkey AS STRING) END AS ship_to_party_id,
  c.c_name AS ship_to_party_desc,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'INTERPLANT' ELSE 'CUSTOMER' END
    AS vfr_freight_type_code,
  l.l_returnflag AS ship_cond_desc,
  l.l_quantity AS net_weight_qty,
  l.l_quantity + l.l_linenumber AS gross_weight_qty,
  cast(p.p_size AS DOUBLE) AS net_vol_qty,
  cast(p.p_size + l.l_linenumber AS DOUBLE) AS gross_vol_qty,
  CASE WHEN l.l_returnflag = 'A' THEN NULL ELSE l.l_quantity + 5 END AS oblb_gross_weight_plan_qty,
  l.l_quantity + 2 AS oblb_gross_weight_shipped_qty,
  l.l_quantity + 3 AS oblb_net_weight_plan_qty,
  CASE WHEN l.l_returnflag = 'A' THEN NULL ELSE cast(p.p_size + 5 AS DOUBLE) END
    AS oblb_gross_vol_plan_qty,
  cast(p.p_size + 2 AS DOUBLE) AS oblb_gross_vol_shipped_qty,
  cast(p.p_size + 3 AS DOUBLE) AS oblb_net_vol_plan_qty,
  cast(100 AS DOUBLE) AS max_weight_qty,
  cast(120 AS DOUBLE) AS max_vol_trans_mgmt_sys_qty,
  cast(26 AS DOUBLE) AS max_pallet_tms_trans_type_qty,
  cast(l.l_linenumber * 2 AS DOUBLE) AS floor_position_qty,
  cast(l.l_linenumber + 1 AS DOUBLE) AS pallet_qty,
  cast(l.l_linenumber + 2 AS DOUBLE) AS theortc_pallet_qty,
  l.l_extendedprice AS actual_cost_amt,
  cast(l.l_shipdate AS DATE) AS actual_goods_issue_date,
  {_dmy('l.l_shipdate')} AS shpmt_start_date,
  cast(year(l.l_shipdate) AS STRING) AS fiscal_year_num,
  cast(month(l.l_shipdate) AS STRING) AS fiscal_year_perd_num,
  CASE WHEN l.l_returnflag = 'R' THEN 'Drop' END AS recvng_live_drop_code,
  CASE WHEN l.l_returnflag = 'N' THEN 'Pre' END AS pre_load_type_code
{_items('order', 'customer', 'supplier', 'part')}
"""

TRUCK_REPORT = f"""
SELECT CASE WHEN l.l_linestatus = 'O' THEN {_ORDER} ELSE 'none-' || {_ORDER} END
    AS follow_on_doc_num,
  cast(l.l_suppkey AS STRING) AS leo_tour_id,
  {_ymd('l.l_shipdate')} AS release_date,
  {_two('l.l_linenumber')} || '0000' AS release_datetm,
  'T' || cast(sn.n_regionkey AS STRING) AS truck_type_code,
  cast(l.l_linenumber AS STRING) AS pallet_num_qty,
  CASE WHEN l.l_linenumber = 7 THEN 'abc' ELSE cast(l.l_linenumber + 1 AS STRING) END
    AS pallet_spot_qty,
  cast(cast(l.l_quantity AS BIGINT) AS STRING) AS total_gross_weight_qty,
  cast(p.p_size AS STRING) AS total_gross_vol_qty
{_items('supplier', 'part')}
"""

VEHICLES = """
SELECT CASE WHEN r_name <> 'ASIA' THEN 'T' || cast(r_regionkey AS STRING) ELSE 'none' END
    AS vehicle_trans_medium_code,
  r_name AS vehicle_type_code,
  cast(1000 + r_regionkey AS DOUBLE) AS total_weight_qty,
  cast(10 + r_regionkey AS DOUBLE) AS vehicle_inner_length_val,
  cast(2 AS DOUBLE) AS vehicle_inner_width_val,
  cast(3 AS DOUBLE) AS vehicle_inner_height_val
FROM {region}
"""

ORDER_LINKAGE = f"""
SELECT {_ORDER} AS sap_order_num,
  '0' || {_LOAD} AS transport_num,
  cast(l.l_linenumber AS STRING) AS linkage_item_num,
  CASE WHEN l.l_discount > 0.05 THEN 'A' ELSE 'B' END AS linkage_kind_code,
  l.l_shipdate AS load_tmstp,
  'file ' || cast(l.l_linenumber AS STRING) AS load_from_file_name
FROM {{lineitem}} l
"""

LOAD_COSTS = f"""
SELECT '0' || {_LOAD} AS load_id,
  cast(l.l_suppkey AS STRING) AS forward_agent_id,
  l.l_returnflag AS service_tms_code,
  cast(c.c_custkey AS STRING) AS ship_to_party_id,
  cr.r_name AS customer_lvl1_code, cr.r_name AS customer_lvl1_desc,
  c.c_mktsegment AS customer_lvl3_code, c.c_mktsegment AS customer_lvl3_desc,
  cn.n_name AS customer_lvl5_code, cn.n_name AS customer_lvl5_desc,
  cast(c.c_custkey AS STRING) AS customer_lvl12_code, c.c_name AS customer_lvl12_desc,
  l.l_extendedprice AS actual_carr_trans_cost_amt,
  l.l_extendedprice AS linehaul_cost_amt,
  l.l_tax AS fuel_cost_amt,
  cast(l.l_linenumber AS DOUBLE) AS fabric_subsector_step_cnt,
  l.l_quantity AS hair_subsector_step_cnt,
  cast(1 AS DOUBLE) AS other_subsector_cnt,
  CASE WHEN s.s_acctbal < 0 THEN NULL ELSE sn.n_name END AS origin_zone_ship_from_code,
  cast(s.s_suppkey AS STRING) AS origin_loc_id,
  sr.r_name AS origin_zone_code,
  cn.n_name AS dest_ship_from_code,
  cr.r_name AS dest_zone_code,
  l.l_quantity AS avg_award_weekly_vol_qty,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderpriority END AS freight_type_code,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS freight_auction_flag,
  cast(l.l_shipdate AS DATE) AS actual_goods_issue_date,
  cast(c.c_nationkey AS STRING) AS final_stop_postal_code
{_items('order', 'customer', 'supplier')}
"""

UNIT_COSTS = f"""
SELECT '00' || {_LOAD} AS load_id,
  p.p_brand AS unit_code,
  l.l_quantity AS su_per_load_qty,
  cast(l.l_extendedprice AS DECIMAL(18, 2)) AS total_cost_amt,
  cast(l.l_linenumber AS DOUBLE) AS step_factor
FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey
"""

CUSTOMERS = """
SELECT cast(c_custkey AS STRING) AS cust_id, 'T' || cast(c_nationkey AS STRING) AS trade_chanl_id
FROM {customer}
"""

TRADE_CHANNELS = """
SELECT CASE WHEN n_regionkey <> 2 THEN 'T' || cast(n_nationkey AS STRING) ELSE 'none' END
    AS trade_chanl_id,
  'Channel ' || n_name AS trade_chanl_desc
FROM {nation}
"""

CUSTOMER_FLAGS = """
SELECT DISTINCT c_mktsegment AS customer_lvl3_desc,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey > 9 THEN 'Y' ELSE 'N' END AS sambc_flag
FROM {customer}
"""

VALUE_CATEGORIES = """
SELECT DISTINCT CASE WHEN p_type <> 'SMALL' THEN p_type ELSE 'none' END AS tdcval_code,
  'Category ' || substr(p_type, 1, 1) AS category
FROM {part}
"""

ORIGIN_NAMES = """
SELECT CASE WHEN n_regionkey <> 3 THEN n_name ELSE 'none' END AS origin_sf_dict,
  'Site ' || n_name AS site_name
FROM {nation}
"""

TENDER_SUMMARY = """
SELECT cast(l.l_shipdate AS DATE) AS week_begin_date,
  sr.r_name AS region_code,
  CASE WHEN s.s_acctbal < 0 THEN NULL ELSE sn.n_name END AS origin_zone_ship_from_code,
  cn.n_name AS dest_ship_from_code,
  c.c_mktsegment AS customer_desc,
  l.l_linenumber AS accept_cnt,
  l.l_extendedprice AS linehaul_cost_amt,
  cast(l.l_suppkey AS STRING) AS forward_agent_id,
  l.l_returnflag AS service_tms_code
""" + _items("order", "customer", "supplier")

LOCATIONS = """
SELECT cast(n_nationkey AS STRING) AS loc_id, n_name AS loc_name,
  CASE WHEN n_regionkey <> 1 THEN cast(n_nationkey - n_nationkey % 2 AS STRING) ELSE 'none' END
    AS postal_code,
  n_name AS origin_zone_ship_from_code, 'Stop ' || n_name AS stop_name
FROM {nation}
"""

# Scorecard inputs: carriers by supplier region, services by return flag.
_CARRIER = "cast(150 + sr.r_regionkey AS STRING)"
_ORIGIN = "CASE sn.n_nationkey WHEN 3 THEN 'NULL' ELSE 'O' || cast(sn.n_nationkey AS STRING) END"

TENDER_WEEKLY = f"""
SELECT {_week('l.l_shipdate')} AS calendar_year_week_tac,
  CASE WHEN l.l_linestatus = 'O' THEN {_CARRIER} ELSE '9' || {_CARRIER} END AS carrier_id,
  l.l_returnflag AS tms_service_code,
  {_ORIGIN} AS origin_location_id,
  sr.r_name AS origin_zone_ship_from_code,
  cr.r_name AS dest_ship_from_code,
  max(sn.n_name || ' to ' || cr.r_name) AS lane,
  cast(count(*) AS BIGINT) AS total_cnt,
  cast(sum(CASE WHEN l.l_tax > 0.02 THEN 1 ELSE 0 END) AS BIGINT) AS accept_cnt,
  max(l.l_extendedprice) AS linehaul_cost_amt
{_items('order', 'customer', 'supplier')}
GROUP BY 1, 2, 3, 4, 5, 6
"""

ON_TIME_VIEW = f"""
SELECT sr.r_name AS parent_loc_code,
  cr.r_name AS dest_ship_from_code,
  cn.n_name AS ship_to_party_code,
  'Ship-to ' || cn.n_name AS ship_to_party_desc,
  {_CARRIER} AS carr_num,
  'Carrier ' || sr.r_name AS carr_desc,
  'Group ' || sr.r_name AS parent_carr_name,
  l.l_returnflag AS service_tms_code,
  {_ORIGIN} AS origin_code,
  sn.n_name AS origin_zone_ship_from_code,
  {_week('l.l_shipdate')} AS ship_week_num,
  c.c_mktsegment AS dest_sold_to_name,
  {_ymd('l.l_shipdate')} AS actual_ship_date,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'INTERPLANT' ELSE 'CUSTOMER' END AS freight_type_val,
  cast(CASE WHEN l.l_tax > 0.04 THEN 1 ELSE 0 END AS DOUBLE) AS cdot_ontime_cnt,
  cast(1 AS BIGINT) AS shpmt_cnt,
  cast(CASE WHEN l.l_shipdate <= o.o_orderdate THEN 1 ELSE 0 END AS BIGINT) AS shpmt_on_time_cnt,
  cast(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS measrbl_shpmt_cnt
{_items('order', 'customer', 'supplier')}
"""

LOADING_VIEW = f"""
SELECT CASE WHEN o.o_orderstatus <> 'P' THEN {_CARRIER} ELSE 'none' END AS carr_num,
  cr.r_name AS dest_ship_from_code,
  {_ORIGIN} AS ship_point_code,
  l.l_returnflag AS actual_service_tms_code,
  {_week('l.l_shipdate')} AS ship_week_num,
  cast(1 AS BIGINT) AS lot_otd_cnt,
  cast(CASE WHEN l.l_shipdate > o.o_orderdate THEN 1 ELSE 0 END AS BIGINT) AS lot_tat_late_counter_val,
  cast(CASE WHEN l.l_tax = 0.01 THEN 1 ELSE 0 END AS BIGINT) AS lot_cust_failure_cnt,
  cast(CASE WHEN l.l_tax = 0.02 THEN 1 ELSE 0 END AS BIGINT) AS shipper_failure_cnt,
  cast(CASE WHEN l.l_tax = 0.03 THEN 1 ELSE 0 END AS BIGINT) AS carr_failure_cnt,
  cast(CASE WHEN l.l_tax = 0.04 THEN 1 ELSE 0 END AS BIGINT) AS others_failure_cnt,
  l.l_linenumber AS tolrnc_sot_val
{_items('order', 'customer', 'supplier')}
"""

FILL_VIEW = f"""
SELECT {_ORIGIN} AS ship_point_code,
  cr.r_name AS dest_ship_from_code,
  CASE WHEN o.o_orderstatus = 'F' THEN '000' ELSE '0007' END || {_CARRIER} AS carr_id,
  l.l_returnflag AS tms_service_code,
  {_dmy('l.l_shipdate')} AS shpmt_start_date,
  l.l_quantity AS plan_gross_weight_qty, l.l_quantity + 1 AS plan_net_weight_qty,
  l.l_quantity + 2 AS shipped_gross_weight_qty, l.l_quantity + 3 AS shipped_net_weight_qty,
  cast(p.p_size AS DOUBLE) AS plan_gross_vol_qty, cast(p.p_size + 1 AS DOUBLE) AS plan_net_vol_qty,
  cast(p.p_size + 2 AS DOUBLE) AS shipped_gross_vol_qty,
  cast(p.p_size + 3 AS DOUBLE) AS shipped_net_vol_qty,
  cast(100 AS DOUBLE) AS max_weight_qty, cast(120 AS DOUBLE) AS max_vol_trans_mgmt_sys_qty,
  cast(l.l_linenumber AS DOUBLE) AS floor_position_qty,
  cast(26 AS DOUBLE) AS max_pallet_tms_trans_type_qty,
  l.l_quantity + 4 AS su_per_load_cnt,
  l.l_quantity + 5 AS cut_impact_rate, l.l_quantity + 6 AS drf_last_truck_amt,
  l.l_quantity + 7 AS glb_segment_impact_cat_ld_amt, l.l_quantity + 8 AS hopade_amt,
  l.l_quantity + 9 AS max_orders_incrmtl_amt, l.l_quantity + 10 AS max_orders_non_drp_amt,
  l.l_quantity + 11 AS total_vf_optny_amt
{_items('order', 'customer', 'supplier', 'part')}
"""

FRAMES = {
    "on_time_events": ON_TIME_EVENTS,
    "origin_units": ORIGIN_UNITS,
    "destination_channels": DESTINATION_CHANNELS,
    "ship_to_flags": SHIP_TO_FLAGS,
    "on_time_reasons": ON_TIME_REASONS,
    "freight_stats": FREIGHT_STATS,
    "delivery_items": DELIVERY_ITEMS,
    "truck_report": TRUCK_REPORT,
    "vehicles": VEHICLES,
    "order_linkage": ORDER_LINKAGE,
    "load_costs": LOAD_COSTS,
    "unit_costs": UNIT_COSTS,
    "customers": CUSTOMERS,
    "trade_channels": TRADE_CHANNELS,
    "customer_flags": CUSTOMER_FLAGS,
    "value_categories": VALUE_CATEGORIES,
    "origin_names": ORIGIN_NAMES,
    "tender_summary": TENDER_SUMMARY,
    "locations": LOCATIONS,
    "tender_weekly": TENDER_WEEKLY,
    "on_time_view": ON_TIME_VIEW,
    "loading_view": LOADING_VIEW,
    "fill_view": FILL_VIEW,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Freight sources on top of the test tables; each table is opened once."""
    opened: dict[str, DataFrame] = {}
    out = []
    for name in names:
        sql = FRAMES[name]
        used = [t for t in TABLES if "{" + t + "}" in sql]
        for t in used:
            if t not in opened:
                opened[t] = table(spark, sf_dir, t)
        out.append(spark.sql(sql, **{t: opened[t] for t in used}))
    return out


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return frames(spark, sf_dir, name)[0]


def cte(*names: str) -> str:
    """The same sources as common table expressions for the oracle."""
    plain = {t: t for t in TABLES}
    return ",\n".join(f"{n} AS ({FRAMES[n].format(**plain)})" for n in names)

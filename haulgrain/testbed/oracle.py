"""DuckDB SQL for each query, written independently of the operators.

Only the mapping of the test tables to freight sources (``frames.cte``) is shared.
"""

from __future__ import annotations

from .frames import FRAMES, cte

ORACLE: dict[str, str] = {}

# --- keys and periods -----------------------------------------------------------------------

ORACLE["key_strip_zeros"] = """
WITH padded AS (SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 10, '0') AS t FROM orders)
SELECT o_orderkey, ltrim(t, '0') AS all_zeros,
  CASE WHEN ltrim(t, '0') = '' THEN '0' ELSE ltrim(t, '0') END AS all_but_one,
  regexp_replace(t, '^0', '') AS one_zero
FROM padded
"""

ORACLE["key_tail_pad"] = """
SELECT o_orderkey,
  CASE WHEN length(o_orderkey::VARCHAR) >= 10 THEN o_orderkey::VARCHAR
       ELSE lpad(o_orderkey::VARCHAR, 10, '0') END AS ten_digits,
  right(lpad(o_orderkey::VARCHAR, 10, '0'), 9) AS last_nine,
  CASE WHEN length(o_orderkey::VARCHAR) >= 3 THEN o_orderkey::VARCHAR
       ELSE lpad(o_orderkey::VARCHAR, 3, '0') END AS not_cut
FROM orders
"""

_LANES = """
lanes AS (
  SELECT l.*, sn.n_name AS origin, cn.n_name AS dest, cn.n_regionkey AS dest_region,
    o.o_orderpriority, o.o_orderstatus
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey)
"""

ORACLE["lane_key"] = f"""
WITH {_LANES}
SELECT origin || '-' || dest AS lane, count(*) AS items, sum(l_quantity) AS quantity
FROM lanes GROUP BY 1
"""

ORACLE["year_week_iso"] = """
SELECT isoyear(o_orderdate)::VARCHAR || lpad(weekofyear(o_orderdate)::VARCHAR, 2, '0') AS week,
  count(*) AS orders
FROM orders GROUP BY 1
"""

ORACLE["year_week_calendar"] = """
SELECT lpad(weekofyear(o_orderdate)::VARCHAR, 2, '0') || '/' || year(o_orderdate)::VARCHAR AS week,
  count(*) AS orders
FROM orders GROUP BY 1
"""

ORACLE["parse_date_time"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
  CASE WHEN day(ts) <> 13 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS bad_is_null,
  strftime(ts, '%Y-%m-%d') AS by_position
FROM events
"""

ORACLE["latest_n_weeks"] = """
WITH weeks AS (
  SELECT *, isoyear(l_shipdate)::VARCHAR || lpad(weekofyear(l_shipdate)::VARCHAR, 2, '0') AS week
  FROM lineitem),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY week DESC) AS rk FROM weeks)
SELECT week, l_suppkey, count(*) AS items, sum(l_quantity) AS quantity
FROM ranked WHERE rk < 14 GROUP BY 1, 2
"""

# --- filters --------------------------------------------------------------------------------

ORACLE["filter_category"] = """
SELECT o_orderkey, o_orderstatus, c_name FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' AND (o_orderstatus = 'F' OR o_orderstatus = 'P' OR o_orderstatus = '')
"""

ORACLE["filter_nonblank_sentinel"] = """
WITH labelled AS (
  SELECT event_id, event_type,
    CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'x' WHEN 'error' THEN 'NULL'
      WHEN 'signup' THEN NULL ELSE event_type END AS label,
    CASE WHEN value < 5 THEN '99991231235959' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS stamp
  FROM events),
flagged AS (
  SELECT event_id, event_type, stamp,
    CASE WHEN length(coalesce(label, '')) > 1 THEN 1 ELSE 0 END AS has_text,
    CASE WHEN label <> 'NULL' THEN 1 ELSE 0 END AS not_null_text
  FROM labelled WHERE stamp <> '99991231235959')
SELECT * FROM flagged WHERE has_text = 1 OR not_null_text = 1
"""

ORACLE["filter_measurable"] = f"""
WITH {cte('on_time_events')}
SELECT load_id, count(*) AS measurable_rows FROM on_time_events
WHERE sd_doc_item_overall_process_status_val = '7' AND schedule_date <> 'NULL'
  AND tender_date <> 'NULL' AND first_dlvry_appt_date <> 'NULL'
GROUP BY 1
"""

# --- choosing rows --------------------------------------------------------------------------

ORACLE["latest_per_key"] = """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLE["keep_min_stage"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY l_linenumber = min(l_linenumber) OVER (PARTITION BY l_orderkey)
"""

ORACLE["final_stage_attr"] = """
SELECT l_orderkey, l_suppkey AS final_l_suppkey, l_quantity AS final_l_quantity FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC) = 1
"""

ORACLE["exclude_children"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
"""

ORACLE["dedupe_on_keys"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_quantity DESC, l_suppkey DESC, l_partkey DESC, l_extendedprice DESC) = 1
"""

ORACLE["first_event_attrs"] = """
WITH days AS (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events),
firsts AS (SELECT user_id, event_type, min(day) AS first_day FROM days GROUP BY 1, 2)
SELECT f.user_id, f.event_type, f.first_day, max(d.event_id) AS event_id, max(d.value) AS value
FROM firsts f JOIN days d
  ON f.user_id = d.user_id AND f.event_type = d.event_type AND f.first_day = d.day
GROUP BY 1, 2, 3
"""

ORACLE["independent_max_vs_argmax"] = """
WITH apart AS (
  SELECT l_orderkey, max(l_linenumber) AS max_stage, max(l_suppkey) AS max_supplier,
    max(l_quantity) AS max_quantity FROM lineitem GROUP BY 1),
together AS (
  SELECT l_orderkey, l_suppkey AS last_supplier, l_quantity AS last_quantity FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC) = 1)
SELECT * FROM apart JOIN together USING (l_orderkey)
"""

# --- aggregates -----------------------------------------------------------------------------

ORACLE["wide_rollup"] = f"""
WITH {_LANES}
SELECT l_orderkey, max(o_orderpriority) AS o_orderpriority, max(o_orderstatus) AS o_orderstatus,
  max(origin) AS origin, max(dest) AS dest, max(l_returnflag) AS l_returnflag,
  min(l_linenumber) AS first_stage, sum(l_quantity) AS quantity,
  sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price,
  sum(l_quantity) / count(l_quantity) AS mean_quantity,
  count(DISTINCT l_suppkey) AS suppliers, count(*) AS items
FROM lanes GROUP BY 1
"""

ORACLE["wide_rollup_coherent"] = """
WITH best AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_returnflag DESC, l_suppkey DESC) = 1)
SELECT b.*, s.quantity FROM best b
JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) s USING (l_orderkey)
"""

ORACLE["distinct_then_sum"] = """
SELECT l_orderkey, sum(l_quantity) AS l_quantity, sum(price)::DOUBLE AS price FROM (
  SELECT DISTINCT l_orderkey, l_quantity, l_extendedprice::DECIMAL(18,2) AS price FROM lineitem)
GROUP BY 1
"""

ORACLE["distinct_value_sum"] = """
SELECT l_suppkey, sum(DISTINCT l_quantity) AS l_quantity,
  sum(DISTINCT l_linenumber::DOUBLE) AS stage, sum(DISTINCT l_partkey)::BIGINT AS l_partkey
FROM lineitem GROUP BY 1
"""

_UNITS_PER_LOAD = """
units AS (
  SELECT load_id, sum(try_cast(t AS DOUBLE)) AS units FROM (
    SELECT DISTINCT regexp_replace(shpmt_id, '^0', '') AS load_id, su_per_load_qty AS t
    FROM freight_stats) GROUP BY 1)
"""

ORACLE["distinct_text_sum"] = f"""
WITH {cte('freight_stats')}, {_UNITS_PER_LOAD}
SELECT load_id, units FROM units
"""

ORACLE["max_then_sum"] = """
SELECT l_orderkey, sum(q) AS quantity, sum(p)::DOUBLE AS price FROM (
  SELECT l_orderkey, l_linenumber, max(l_quantity) AS q, max(l_extendedprice::DECIMAL(18,2)) AS p
  FROM lineitem GROUP BY 1, 2)
GROUP BY 1
"""

ORACLE["presence_flag"] = """
SELECT k.l_orderkey, CASE WHEN EXISTS (
    SELECT 1 FROM lineitem r WHERE r.l_orderkey = k.l_orderkey AND r.l_returnflag = 'R')
  THEN 1 END::INTEGER AS returned, count(DISTINCT k.l_orderkey) AS present
FROM lineitem k GROUP BY k.l_orderkey
"""

ORACLE["ratio_pct"] = f"""
WITH {cte('on_time_events')},
marked AS (
  SELECT ship_to_party_code,
    CASE WHEN failure_bucket_name = 'On Time' THEN load_id END AS on_time,
    CASE WHEN trnsp_stage_num = '7' THEN load_id END AS seventh
  FROM on_time_events)
SELECT ship_to_party_code,
  count(DISTINCT on_time)::DOUBLE / nullif(count(DISTINCT seventh), 0) * 100 AS pct,
  count(on_time)::DOUBLE / nullif(count(seventh), 0) * 100 AS pct_rows
FROM marked GROUP BY 1
"""

ORACLE["group_total_attach"] = """
WITH parts AS (SELECT p_partkey, CASE WHEN p_size > 2 THEN p_brand END AS brand, p_size FROM part)
SELECT p_partkey, brand, p_size,
  CASE WHEN brand IS NOT NULL THEN sum(p_size) OVER (PARTITION BY brand) END::BIGINT AS brand_size,
  (sum(p_size) OVER (PARTITION BY brand))::BIGINT AS brand_size_with_null
FROM parts
"""

ORACLE["hierarchy_flatten"] = f"""
WITH {cte('load_costs')}
SELECT ship_to_party_id, max(customer_lvl1_code) AS customer_lvl1_code,
  max(customer_lvl1_desc) AS customer_lvl1_desc, max(customer_lvl3_code) AS customer_lvl3_code,
  max(customer_lvl3_desc) AS customer_lvl3_desc, max(customer_lvl5_code) AS customer_lvl5_code,
  max(customer_lvl5_desc) AS customer_lvl5_desc, max(customer_lvl12_code) AS customer_lvl12_code,
  max(customer_lvl12_desc) AS customer_lvl12_desc
FROM load_costs GROUP BY 1
"""

_UNIT_COSTS = """
cost_of_unit AS (
  SELECT ltrim(load_id, '0') AS load_id, unit_code AS load_gbu_id,
    sum(su_per_load_qty) AS tfs_su_per_load_qty, sum(total_cost_amt)::DOUBLE AS tfs_total_cost_amt,
    sum(step_factor) AS tfs_step_factor
  FROM unit_costs GROUP BY 1, 2)
"""

ORACLE["cost_by_unit"] = f"WITH {cte('unit_costs')}, {_UNIT_COSTS} SELECT * FROM cost_of_unit"

# --- joins ----------------------------------------------------------------------------------

ORACLE["lookup_left"] = f"""
WITH {cte('origin_units')},
units AS (SELECT origin_id, max(gbu_code) AS unit FROM origin_units GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, s_name AS carrier,
  l_suppkey::VARCHAR AS origin_id, unit
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN units ON units.origin_id = l_suppkey::VARCHAR
"""

ORACLE["bridge_inner"] = """
SELECT o_orderkey, p_brand, sum(l_quantity) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2
"""

ORACLE["period_join"] = f"""
WITH {_LANES},
items AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity,
    isoyear(l_shipdate)::VARCHAR || lpad(weekofyear(l_shipdate)::VARCHAR, 2, '0') AS week,
    origin || '-' || dest AS lane
  FROM lanes),
totals AS (
  SELECT week, lane, sum(l_quantity) AS lane_quantity FROM items GROUP BY 1, 2)
SELECT i.*, lane_quantity FROM items i JOIN totals USING (week, lane)
"""

_FALLBACK = """
facts AS (
  SELECT c_custkey, n_name AS nation, n_regionkey AS area
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
ref AS (
  SELECT CASE WHEN s_acctbal > 8000 THEN n_name ELSE 'none' END AS nation,
    CASE WHEN s_acctbal > 8000 THEN n_regionkey ELSE -1 END AS area, s_name AS supplier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
rest AS (
  SELECT nation, area, max(c_custkey) AS c_custkey FROM facts f
  WHERE NOT EXISTS (SELECT 1 FROM ref WHERE ref.nation = f.nation) GROUP BY 1, 2),
coarse AS (
  SELECT c_custkey, rest.nation, rest.area, supplier,
    CASE WHEN supplier IS NULL THEN 0 ELSE 2 END AS match_tier
  FROM rest LEFT JOIN ref ON rest.area = ref.area)
"""

ORACLE["fallback_match"] = f"""
WITH {_FALLBACK}
SELECT c_custkey, f.nation, f.area, supplier, 1 AS match_tier FROM facts f JOIN ref USING (nation)
UNION ALL SELECT * FROM coarse
"""

ORACLE["fallback_match_with_duplicates"] = f"""
WITH {_FALLBACK}
SELECT c_custkey, f.nation, f.area, supplier,
  CASE WHEN supplier IS NULL THEN 0 ELSE 1 END AS match_tier
FROM facts f LEFT JOIN ref ON f.nation = ref.nation
UNION ALL SELECT * FROM coarse
"""

# --- rules and reshaping --------------------------------------------------------------------

_PROMISE = """
moments AS (
  SELECT load_id, profl_method_code, order_num,
    try_strptime(first_dlvry_appt_date || ' ' || first_dlvry_appt_datetm, '%d/%m/%Y %H:%M:%S') AS fa,
    try_strptime(last_dlvry_appt_date || ' ' || last_dlvry_appt_datetm, '%d/%m/%Y %H:%M:%S') AS la,
    try_strptime(request_dlvry_to_date || ' ' || request_dlvry_to_datetm, '%d/%m/%Y %H:%M:%S') AS rq,
    try_strptime(orig_request_dlvry_to_date || ' ' || orig_request_dlvry_to_datetm,
      '%d/%m/%Y %H:%M:%S') AS og,
    try_strptime(actual_shpmt_end_date || ' ' || actual_arrival_datetm, '%d/%m/%Y %H:%M:%S') AS arr
  FROM on_time_events),
latest AS (
  SELECT load_id, profl_method_code, max(order_num) AS largest_order_num, max(arr) AS arr,
    CASE WHEN profl_method_code IN ('APFD', 'RDDAPF', 'APF') THEN max(fa)
      WHEN profl_method_code IN ('APLD', 'RDDAPL', 'APL') THEN max(la)
      WHEN profl_method_code = 'RDD' THEN max(rq)
      WHEN profl_method_code IN ('ORDD', 'OTIF') THEN max(og) END AS promised
  FROM moments GROUP BY 1, 2),
promise AS (
  SELECT load_id, profl_method_code, largest_order_num,
    CASE WHEN promised IS NULL OR arr IS NULL THEN NULL WHEN promised >= arr THEN 1 ELSE 0 END
      AS load_lvl_on_time_pct
  FROM latest)
"""

ORACLE["profile_dispatch"] = f"WITH {cte('on_time_events')}, {_PROMISE} SELECT * FROM promise"

ORACLE["entity_override"] = """
SELECT c_custkey, c_mktsegment, c_acctbal, c_custkey::DOUBLE AS number,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey::DOUBLE ELSE c_acctbal END
    AS by_list,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey::DOUBLE ELSE c_acctbal END AS by_table
FROM customer
"""

ORACLE["clamp_floor"] = """
WITH b AS (SELECT c_custkey, CASE WHEN c_nationkey <> 5 THEN c_acctbal END AS balance FROM customer)
SELECT c_custkey, CASE WHEN balance < 0 THEN 0 ELSE balance END AS not_negative,
  CASE WHEN balance < 0 THEN 0 ELSE balance END AS as_decimal, 0.11::DOUBLE AS operating_space
FROM b
"""

ORACLE["unpivot_measures"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity' AS key, l_quantity AS val
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount', l_discount FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_tax',
  CASE WHEN l_returnflag <> 'N' THEN l_tax END FROM lineitem
"""

ORACLE["conform_output"] = """
SELECT o_orderstatus, o_orderkey::BIGINT AS load_id,
  CASE WHEN o_orderstatus <> 'P' THEN substr(o_orderpriority, 1, 1)::INTEGER END AS priority_no,
  o_totalprice
FROM orders
"""

ORACLE["overwrite_read_back"] = """
SELECT o_orderstatus, o_orderkey::VARCHAR AS load_id, o_custkey::INTEGER AS o_custkey FROM orders
"""

# --- parts of the fill plan -----------------------------------------------------------------

_TRUCKS = """
truck_sums AS (
  SELECT follow_on_doc_num, leo_tour_id, release_date || release_datetm AS release_dttm,
    max(release_date) AS release_date, max(release_datetm) AS release_datetm,
    max(truck_type_code) AS truck_type_code,
    sum(try_cast(pallet_num_qty AS DOUBLE)) AS pallet_num_qty,
    sum(try_cast(pallet_spot_qty AS DOUBLE)) AS pallet_spot_qty,
    sum(try_cast(total_gross_weight_qty AS DOUBLE)) AS total_gross_weight_qty,
    sum(try_cast(total_gross_vol_qty AS DOUBLE)) AS total_gross_vol_qty
  FROM truck_report GROUP BY 1, 2, 3),
releases AS (
  SELECT * FROM truck_sums QUALIFY row_number() OVER (
    PARTITION BY follow_on_doc_num ORDER BY release_dttm DESC, leo_tour_id DESC,
      release_date DESC, release_datetm DESC, truck_type_code DESC, pallet_num_qty DESC) = 1),
linked AS (
  SELECT sap_order_num AS order_num, right(transport_num, 9) AS load_id, transport_num,
    linkage_item_num, linkage_kind_code,
    sap_order_num AS doc_flow_order_num, transport_num AS doc_flow_load_id
  FROM order_linkage QUALIFY row_number() OVER (
    PARTITION BY sap_order_num, transport_num ORDER BY load_tmstp DESC, linkage_item_num DESC,
      linkage_kind_code DESC) = 1),
chain AS (
  SELECT linked.*, releases.*, vehicle_trans_medium_code, total_weight_qty, vehicle_inner_length_val,
    vehicle_inner_width_val, vehicle_inner_height_val,
    vehicle_type_code AS truck_vehicle_type_code, vehicle_type_code AS vehicle_type2_code,
    total_weight_qty AS vehicle_true_max_weight_qty,
    vehicle_inner_length_val * vehicle_inner_width_val * vehicle_inner_height_val
      AS vehicle_true_max_vol_qty
  FROM linked JOIN releases ON order_num = follow_on_doc_num
  JOIN vehicles ON truck_type_code = vehicle_trans_medium_code)
"""

_TRUCK_SOURCES = cte("truck_report", "vehicles", "order_linkage")

ORACLE["fill_truck_releases"] = f"WITH {_TRUCK_SOURCES}, {_TRUCKS} SELECT * FROM releases"
ORACLE["fill_order_loads"] = f"WITH {_TRUCK_SOURCES}, {_TRUCKS} SELECT * FROM linked"
ORACLE["fill_truck_chain"] = f"WITH {_TRUCK_SOURCES}, {_TRUCKS} SELECT * FROM chain"

_ITEMS = """
items AS (
  SELECT * REPLACE (ltrim(load_id, '0') AS load_id, ltrim(material_doc_num, '0') AS material_doc_num),
    gbu_code AS load_gbu_id
  FROM delivery_items),
shipped AS (
  SELECT load_id, sum(a) AS shipped_net_vol_qty, sum(b) AS shipped_net_weight_qty,
    sum(c) AS shipped_gross_vol_qty, sum(d) AS shipped_gross_weight_qty
  FROM (SELECT load_id, dlvry_item_num, material_doc_num, max(net_vol_qty) AS a,
      max(net_weight_qty) AS b, max(gross_vol_qty) AS c, max(gross_weight_qty) AS d
    FROM items GROUP BY 1, 2, 3)
  GROUP BY 1)
"""

ORACLE["fill_shipped_totals"] = f"WITH {cte('delivery_items')}, {_ITEMS} SELECT * FROM shipped"

_COSTS = """
cost AS (
  SELECT regexp_replace(load_id, '^0', '') AS load_id,
    max(actual_carr_trans_cost_amt) AS actual_carr_trans_cost_amt,
    max(linehaul_cost_amt) AS linehaul_cost_amt, max(fuel_cost_amt) AS fuel_cost_amt,
    max(fabric_subsector_step_cnt) AS fabric_subsector_step_cnt,
    max(hair_subsector_step_cnt) AS hair_subsector_step_cnt,
    max(other_subsector_cnt) AS other_subsector_cnt,
    max(origin_zone_ship_from_code) AS origin_zone_ship_from_code,
    max(origin_loc_id) AS origin_loc_id, max(origin_zone_code) AS origin_zone_code,
    max(dest_ship_from_code) AS dest_ship_from_code, max(dest_zone_code) AS dest_zone_code,
    max(ship_to_party_id) AS dest_loc_code, max(service_tms_code) AS tms_service_code,
    sum(avg_award_weekly_vol_qty) / count(avg_award_weekly_vol_qty) AS avg_award_weekly_vol_qty,
    max(freight_type_code) AS tac_freight_type_code,
    max(freight_auction_flag) AS freight_auction_flag,
    max(actual_carr_trans_cost_amt) AS actual_carr_total_trans_cost_usd_amt
  FROM load_costs GROUP BY 1),
awarded AS (
  SELECT regexp_replace(load_id, '^0', '') AS load_id, forward_agent_id AS carr_id,
    service_tms_code AS tms_service_code,
    max(avg_award_weekly_vol_qty) AS avg_average_awarded_weekly_volume
  FROM load_costs GROUP BY 1, 2, 3)
"""

ORACLE["fill_cost_per_load"] = f"WITH {cte('load_costs')}, {_COSTS} SELECT * FROM cost"
ORACLE["fill_awarded_volume"] = f"WITH {cte('load_costs')}, {_COSTS} SELECT * FROM awarded"

_FREIGHT = f"""
{_UNITS_PER_LOAD},
freight AS (
  SELECT s.*, units AS su_per_load_cnt FROM (
    SELECT regexp_replace(shpmt_id, '^0', '') AS load_id, max(step_per_load_rate) AS step_factor,
      max(freight_cost_charge_code) AS max_freight_cost_charge_code
    FROM freight_stats GROUP BY 1) s
  LEFT JOIN units USING (load_id))
"""

ORACLE["fill_freight_per_load"] = f"WITH {cte('freight_stats')}, {_FREIGHT} SELECT * FROM freight"

_PRIORITY = """
priority AS (
  SELECT load_id, max(try_cast(load_builder_prty_val AS INTEGER)) AS load_builder_prty_val
  FROM on_time_events WHERE try_cast(load_builder_prty_val AS INTEGER) > 0 GROUP BY 1)
"""

ORACLE["fill_load_priority"] = f"WITH {cte('on_time_events')}, {_PRIORITY} SELECT * FROM priority"

_HIERARCHY = """
levels AS (
  SELECT ship_to_party_id, max(customer_lvl1_code) AS customer_lvl1_code,
    max(customer_lvl1_desc) AS customer_lvl1_desc, max(customer_lvl3_code) AS customer_lvl3_code,
    max(customer_lvl3_desc) AS customer_lvl3_desc, max(customer_lvl5_code) AS customer_lvl5_code,
    max(customer_lvl5_desc) AS customer_lvl5_desc, max(customer_lvl12_code) AS customer_lvl12_code,
    max(customer_lvl12_desc) AS customer_lvl12_desc
  FROM load_costs GROUP BY 1),
hierarchy AS (
  SELECT l.*, t.trade_chanl_id, t.trade_chanl_desc, f.sambc_flag
  FROM levels l
  LEFT JOIN (customers JOIN trade_channels USING (trade_chanl_id)) t
    ON l.customer_lvl12_code = t.cust_id
  LEFT JOIN (SELECT customer_lvl3_desc, max(sambc_flag) AS sambc_flag FROM customer_flags GROUP BY 1) f ON l.customer_lvl3_desc = f.customer_lvl3_desc)
"""

_HIERARCHY_SOURCES = cte("load_costs", "customers", "trade_channels", "customer_flags")

ORACLE["fill_ship_to_hierarchy"] = f"""
WITH {_HIERARCHY_SOURCES}, {_HIERARCHY} SELECT * FROM hierarchy
"""

# --- on-time plan ---------------------------------------------------------------------------

_ON_TIME_SOURCES = cte(
    "on_time_events",
    "origin_units",
    "destination_channels",
    "ship_to_flags",
    "on_time_reasons",
    "freight_stats",
)

_KEY_LIST = (
    "order_num, load_id, cust_po_num, ship_to_party_code, ship_to_party_desc, failure_bucket_name, "
    "failure_bucket_updated_name, on_time_src_code, dest_sold_to_name, lot_delay_code"
)
_ALL_KEYS_KNOWN = " AND ".join(f"{k.strip()} IS NOT NULL" for k in _KEY_LIST.split(","))

# event columns that come out under their own name
_ON_TIME_ATTRIBUTES = ", ".join(
    f"max({c}) AS {c}"
    for c in [
        "actual_load_end_date",
        "final_lrdt_date",
        "on_time_src_desc",
        "first_dlvry_appt_date",
        "first_dlvry_appt_datetm",
        "last_dlvry_appt_date",
        "last_dlvry_appt_datetm",
        "request_dlvry_to_date",
        "request_dlvry_to_datetm",
        "orig_request_dlvry_to_date",
        "orig_request_dlvry_to_datetm",
        "actual_arrival_datetm",
        "schedule_date",
        "tender_date",
        "dest_city_name",
        "dest_state_code",
        "dest_postal_code",
        "ship_point_code",
        "carr_num",
        "carr_desc",
        "dest_ship_from_code",
        "ship_week_num",
        "customer_desc",
        "country_to_code",
        "dest_zone_code",
        "frt_type_desc",
    ]
) + ", max(actual_shpmt_end_date) AS actual_arrival_date, max(ship_point_desc) AS origin_zone_ship_from_code"

_ON_TIME = f"""
{_PROMISE},
ev AS (
  SELECT *, coalesce(customer_desc, ship_to_party_desc) AS dest_sold_to_name,
    coalesce(lot_delay_reason_code, '') AS lot_delay_code, trnsp_stage_num::INTEGER AS stage,
    origin_zone_code || ' to ' || dest_city_name || ',' || dest_state_code || ',' || dest_postal_code
      AS lane_name,
    failure_bucket_updated_name = 'On Time' AS is_on_time,
    (sd_doc_item_overall_process_status_val = '7' AND schedule_date <> 'NULL'
      AND tender_date <> 'NULL' AND first_dlvry_appt_date <> 'NULL') AS is_measurable
  FROM on_time_events),
loads AS (
  SELECT load_id, max(CASE WHEN is_on_time THEN 1 END) AS load_on_time,
    max(CASE WHEN is_measurable THEN 1 END) AS measrbl_shpmt_cnt,
    max(CASE WHEN drop_live_ind_desc IN ('Drop', 'Live', '') THEN drop_live_ind_desc END)
      AS drop_live_ind_desc,
    max(ship_to_party_code) AS max_ship_to_party_code,
    max(ship_to_party_desc) AS max_ship_to_party_desc
  FROM ev GROUP BY 1),
first_moment AS (SELECT load_id, stage, min(event_datetm) AS m FROM ev GROUP BY 1, 2),
first_stamps AS (
  SELECT ev.load_id, ev.stage, max(actual_dlvry_tmstp) AS a, max(first_appt_dlvry_tmstp) AS f
  FROM ev JOIN first_moment q
    ON ev.load_id = q.load_id AND ev.stage = q.stage AND ev.event_datetm = q.m
  GROUP BY 1, 2),
ratio AS (
  SELECT load_id,
    max(CASE WHEN a <= f THEN 1 WHEN a > f THEN 0 END)::DOUBLE / max(stage) AS cdot_ontime_cnt
  FROM first_stamps GROUP BY 1),
distance AS (
  SELECT ltrim(shpmt_id, '0') AS load_id,
    max(distance_per_load_qty::DECIMAL(30, 8))::DOUBLE AS distance_per_load_num_qty
  FROM freight_stats GROUP BY 1),
unit AS (
  SELECT origin_id, parent_loc_code, max(gbu_code) AS unit_code FROM origin_units GROUP BY 1, 2),
ord AS (
  SELECT {_KEY_LIST}, max(origin_zone_code) AS parent_loc_code,
    max(actual_service_tms_code) AS service_tms_code,
    max(ship_point_at_point_of_dprtr_code) AS origin_code,
    max(true_frt_type_desc) AS freight_type_val,
    max(sd_doc_item_overall_process_status_val) AS overall_status_val,
    max(profl_method_code) AS profl_method_code, max(lane_name) AS lane_name,
    {_ON_TIME_ATTRIBUTES},
    max(coalesce(lot_delay_reason_code_desc, '')) AS lot_delay_code_desc,
    max(split_part(carr_desc, '#', 1)) AS parent_carr_name,
    max(CASE WHEN change_type_code IS NULL THEN 'Y' ELSE 'N' END) AS exception_flag,
    max(CASE WHEN actual_service_tms_code IS NULL THEN 'Y' ELSE 'N' END) AS freight_auction_flag,
    max(CASE WHEN carr_num IS NOT NULL THEN 'Y' ELSE 'N' END) AS primary_carr_flag,
    max(CASE WHEN length(lot_delay_reason_code) > 0 THEN 0 ELSE 1 END) AS otd_cnt,
    max(CASE WHEN length(lot_delay_reason_code) > 0 THEN 1 ELSE 0 END) AS tat_late_counter_val,
    max(coalesce(nullif(lot_delay_reason_code_desc, ''), 'No delay')) AS lot_delay_bucket_val,
    max(unit_code) AS unit_code, max(cause_desc) AS aot_bucket_val
  FROM ev
  LEFT JOIN unit ON ev.ship_point_code = unit.origin_id AND ev.origin_zone_code = unit.parent_loc_code
  LEFT JOIN (SELECT definition_name, max(cause_desc) AS cause_desc FROM on_time_reasons GROUP BY 1)
    ON ev.on_time_src_desc = definition_name
  WHERE load_id IS NOT NULL AND origin_zone_code <> ''
  GROUP BY ALL),
measured AS (
  SELECT ord.*, 1 AS shpmt_cnt,
    CASE WHEN ord.failure_bucket_updated_name = 'On Time' THEN 1 END AS shpmt_on_time_cnt,
    loads.* EXCLUDE (load_id, load_on_time),
    CASE WHEN load_on_time = 1 THEN ord.load_id::BIGINT END AS iot_shpmt_on_time_load_id,
    CASE WHEN measrbl_shpmt_cnt = 1 THEN ord.load_id::BIGINT END AS iot_measrbl_shpmt_load_id,
    CASE WHEN measrbl_shpmt_cnt = 1 THEN
      CASE WHEN load_on_time = 1 THEN 100.0 ELSE 0.0 END END::DOUBLE AS iot_on_time_pct,
    iot_on_time_pct AS iot_on_time2_pct,
    ord.otd_cnt::DOUBLE / nullif(ord.otd_cnt + ord.tat_late_counter_val, 0) AS lot_rate,
    CASE WHEN ord.tat_late_counter_val > 0 THEN 'N' ELSE 'Y' END AS lot_flag,
    cdot_ontime_cnt, distance_per_load_num_qty, coalesce(unit_code, 'OTHER') AS gbu_code,
    coalesce(ch.customer_name, ord.dest_sold_to_name) AS customer_name,
    coalesce(ch.channel_name, 'OTHER') AS channel_name, ship_to_flag
  FROM ord JOIN loads USING (load_id) LEFT JOIN ratio USING (load_id)
  LEFT JOIN distance USING (load_id)
  LEFT JOIN (SELECT dest_sold_to_name, max(customer_name) AS customer_name,
      max(channel_name) AS channel_name FROM destination_channels GROUP BY 1) ch ON ord.dest_sold_to_name = ch.dest_sold_to_name
  LEFT JOIN (SELECT ship_to_num, max(ship_to_flag) AS ship_to_flag FROM ship_to_flags GROUP BY 1)
    ON ord.ship_to_party_code = ship_to_num),
rated AS (
  SELECT m.*, coalesce(shpmt_on_time_cnt, 0) * 100.0::DOUBLE / measrbl_shpmt_cnt AS on_time_pct,
    largest_order_num, {_ALL_KEYS_KNOWN.replace('load_id', 'm.load_id')} AS keys_known,
    p.load_lvl_on_time_pct AS promise_result
  FROM measured m LEFT JOIN promise p
    ON m.load_id = p.load_id AND m.profl_method_code = p.profl_method_code),
on_time_mart AS (
  SELECT * EXCLUDE (unit_code, keys_known, promise_result, largest_order_num),
    CASE WHEN keys_known THEN promise_result END AS load_lvl_on_time_pct,
    CASE WHEN keys_known AND customer_desc IN ('BUILDING', 'MACHINERY')
      THEN promise_result::DOUBLE ELSE on_time_pct END AS actual_on_time_pct
  FROM rated)
"""

ORACLE["mart_on_time"] = f"WITH {_ON_TIME_SOURCES}, {_ON_TIME} SELECT * FROM on_time_mart"

ORACLE["mart_on_time_largest_order"] = f"""
WITH {_ON_TIME_SOURCES}, {_ON_TIME},
last_row AS (
  SELECT load_id, ship_to_party_code AS last_code, ship_to_party_desc AS last_desc
  FROM ev QUALIFY row_number() OVER (PARTITION BY load_id
    ORDER BY stage DESC, event_datetm DESC, ship_to_party_code DESC, ship_to_party_desc DESC) = 1)
SELECT * EXCLUDE (unit_code, keys_known, promise_result, largest_order_num, last_code, last_desc)
    REPLACE (last_code AS max_ship_to_party_code, last_desc AS max_ship_to_party_desc),
  CASE WHEN keys_known AND order_num = largest_order_num THEN promise_result END
    AS load_lvl_on_time_pct,
  CASE WHEN keys_known AND customer_desc IN ('BUILDING', 'MACHINERY')
    THEN CASE WHEN order_num = largest_order_num THEN promise_result::DOUBLE END
    ELSE on_time_pct END AS actual_on_time_pct
FROM rated LEFT JOIN last_row USING (load_id)
"""

ORACLE["mart_interplant"] = f"""
WITH {_ON_TIME_SOURCES}, {_ON_TIME}
SELECT * FROM on_time_mart WHERE freight_type_val = 'INTERPLANT'
"""

# --- loading and tender plans ---------------------------------------------------------------

ORACLE["mart_loading"] = f"""
WITH {cte('on_time_events')},
picked AS (
  SELECT * FROM on_time_events e
  WHERE trnsp_stage_num = '1' AND length(coalesce(actual_load_end_date, '')) > 1
    AND length(coalesce(final_lrdt_date, '')) > 1
    AND length(coalesce(lot_delay_reason_code_desc, '')) > 1
    AND change_type_code IN ('PICKCI', 'PICKCO') AND length(coalesce(event_datetm, '')) > 1
    AND event_datetm <> '99991231235959'
    AND NOT EXISTS (SELECT 1 FROM on_time_events c
      WHERE regexp_replace(c.child_shpmt_num, '^0', '') = e.load_id)),
latest AS (
  SELECT *, strptime(event_datetm, '%Y%m%d%H%M%S') AS moment,
    try_strptime(actual_load_end_date, '%d/%m/%Y') AS ended,
    try_strptime(final_lrdt_date, '%d/%m/%Y') AS ready
  FROM picked
  QUALIFY row_number() OVER (PARTITION BY load_id, change_type_code
    ORDER BY event_datetm DESC, child_shpmt_num DESC, trnsp_stage_num DESC, lot_delay_reason_code DESC,
      lot_delay_reason_code_desc DESC, actual_load_end_date DESC, final_lrdt_date DESC,
      order_num DESC) = 1)
SELECT * EXCLUDE (moment, ended, ready)
    RENAME (dest_zone_code AS dest_zone_val, frt_type_desc AS freight_type_val),
  strftime(moment, '%b') AS ship_3lettermonth, month(moment)::INTEGER AS ship_month, year(moment)::INTEGER AS ship_year,
  strftime(moment, '%b') || ' ' || year(moment)::VARCHAR AS actual_ship_month_val,
  CASE WHEN ended <= ready THEN 1 ELSE 0 END AS lot_otd_cnt,
  CASE WHEN ended > ready THEN 1 ELSE 0 END AS lot_tat_late_counter_val,
  coalesce(country_to_code, 'UNKNOWN') AS country_to_desc, 1::BIGINT AS load_num_per_load_id_cnt
FROM latest
"""

_TENDER_LANES = """
lane_weeks AS (
  SELECT DISTINCT week_begin_date, region_code AS state_province_code, origin_zone_ship_from_code,
    dest_ship_from_code, customer_desc, accept_cnt,
    year(week_begin_date)::VARCHAR || lpad(weekofyear(week_begin_date)::VARCHAR, 2, '0')
      AS concat_week_year
  FROM tender_summary),
tender_lanes AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, dense_rank() OVER (ORDER BY concat_week_year DESC) AS rk FROM lane_weeks)
  WHERE rk < 14)
"""

ORACLE["mart_tender_lanes"] = f"""
WITH {cte('tender_summary')}, {_TENDER_LANES}
SELECT * REPLACE (strftime(week_begin_date, '%Y-%m-%d') AS week_begin_date),
  weekofyear(week_begin_date)::INTEGER AS calendar_week_num,
  year(week_begin_date)::INTEGER AS calendar_year_num
FROM tender_lanes
"""

_TENDER_LOADS = """
loads AS (
  SELECT DISTINCT regexp_replace(load_id, '^0', '') AS load_id, forward_agent_id, service_tms_code,
    ship_to_party_id, origin_zone_ship_from_code, origin_loc_id, dest_ship_from_code, dest_zone_code,
    avg_award_weekly_vol_qty, freight_type_code, freight_auction_flag, actual_goods_issue_date,
    final_stop_postal_code,
    year(actual_goods_issue_date)::VARCHAR
      || lpad(weekofyear(actual_goods_issue_date)::VARCHAR, 2, '0') AS concat_week_year
  FROM load_costs)
"""

_TENDER_SOURCES = cte("tender_summary", "load_costs", "locations")

_ONE_STOP = "(SELECT postal_code, max(stop_name) AS stop_name FROM locations GROUP BY 1)"

ORACLE["mart_tender_shipments"] = f"""
WITH {_TENDER_SOURCES}, {_TENDER_LANES}, {_TENDER_LOADS}
SELECT * EXCLUDE (postal_code) REPLACE (
    strftime(actual_goods_issue_date, '%Y-%m-%d') AS actual_goods_issue_date,
    strftime(week_begin_date, '%Y-%m-%d') AS week_begin_date)
FROM loads l JOIN tender_lanes t USING (concat_week_year, origin_zone_ship_from_code, dest_ship_from_code)
LEFT JOIN {_ONE_STOP} ON final_stop_postal_code = postal_code
"""

ORACLE["mart_tender_shipments_repeated"] = f"""
WITH {_TENDER_SOURCES}, {_TENDER_LANES}, {_TENDER_LOADS}
SELECT * EXCLUDE (postal_code) REPLACE (
    strftime(actual_goods_issue_date, '%Y-%m-%d') AS actual_goods_issue_date,
    strftime(week_begin_date, '%Y-%m-%d') AS week_begin_date)
FROM loads l JOIN tender_lanes t USING (concat_week_year, origin_zone_ship_from_code, dest_ship_from_code)
LEFT JOIN (SELECT DISTINCT postal_code, stop_name FROM locations) ON final_stop_postal_code = postal_code
"""

ORACLE["mart_tender_shipments_by_week"] = f"""
WITH {_TENDER_SOURCES}, {_TENDER_LANES}, {_TENDER_LOADS}
SELECT concat_week_year, load_id, count(*) AS rows, sum(accept_cnt)::BIGINT AS accepted
FROM loads JOIN tender_lanes USING (concat_week_year)
GROUP BY 1, 2
"""

# --- fill plans -----------------------------------------------------------------------------

_HUB_SOURCES = cte(
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
)

_HUB = f"""
{_TRUCKS}, {_ITEMS}, {_COSTS}, {_FREIGHT}, {_PRIORITY}, {_HIERARCHY},
one_truck AS (
  SELECT * FROM chain QUALIFY row_number() OVER (
    PARTITION BY load_id, order_num ORDER BY release_dttm DESC) = 1),
trucked AS (
  SELECT i.*, truck_type_code, pallet_num_qty, pallet_spot_qty, total_gross_weight_qty,
    total_gross_vol_qty, transport_num, linkage_item_num, linkage_kind_code, leo_tour_id, release_dttm,
    truck_vehicle_type_code, vehicle_true_max_vol_qty, vehicle_true_max_weight_qty,
    CASE WHEN t.order_num IS NULL THEN 'S' ELSE 'O' END AS ordered_shipped_flag,
    coalesce(oblb_gross_weight_plan_qty, total_gross_weight_qty) AS filled_weight,
    coalesce(oblb_gross_vol_plan_qty, total_gross_vol_qty) AS filled_vol,
    coalesce(pallet_num_qty, floor_position_qty) AS palletsshipped
  FROM items i LEFT JOIN one_truck t ON i.load_id = t.load_id AND i.order_num = t.order_num),
stats AS (
  SELECT load_id, max(palletsshipped) AS pallet_shipped_qty, min(trans_stage_num) AS min_stage,
    sum(net_weight_qty) AS sum_weight, sum(net_vol_qty) AS sum_vol, count(*) AS shipped_load_cnt
  FROM (SELECT DISTINCT load_id, load_gbu_id, tdcval_code, material_doc_num, dlvry_item_num,
      floor_position_qty, palletsshipped, net_vol_qty, net_weight_qty, gross_weight_qty,
      gross_vol_qty, trans_stage_num FROM trucked)
  GROUP BY 1),
planned AS (
  SELECT load_id, sum(a) AS plan_gross_weight_qty, sum(b) AS plan_gross_vol_qty,
    sum(c) AS plan_net_weight_qty, sum(d) AS plan_net_vol_qty
  FROM (SELECT load_id, dlvry_id, max(filled_weight) AS a, max(filled_vol) AS b,
      max(oblb_net_weight_plan_qty) AS c, max(oblb_net_vol_plan_qty) AS d
    FROM trucked GROUP BY 1, 2)
  GROUP BY 1),
final_stop AS (
  SELECT load_id, ship_to_party_id AS final_ship_to_party_id FROM items QUALIFY row_number() OVER (
    PARTITION BY load_id
    ORDER BY trans_stage_num DESC, ship_to_party_id DESC, ship_to_party_desc DESC) = 1),
prepared AS (
  SELECT t.*, 'Y' AS min_trans_stage_flag, s.* EXCLUDE (load_id), p.* EXCLUDE (load_id),
    sh.* EXCLUDE (load_id), c.* EXCLUDE (load_id), f.* EXCLUDE (load_id),
    load_builder_prty_val, final_ship_to_party_id, avg_average_awarded_weekly_volume,
    h.* EXCLUDE (ship_to_party_id), category AS categ_name,
    filled_weight / nullif(filled_vol, 0) AS weight_vol_plan_qty,
    shipped_gross_weight_qty / nullif(shipped_gross_vol_qty, 0) AS density_rate,
    origin_zone_ship_from_code || '-' || vfr_freight_type_code AS origin_freight_code,
    CASE WHEN avg_average_awarded_weekly_volume > 0 THEN 'Y' ELSE 'N' END AS primary_carr_flag,
    CASE WHEN freight_auction_flag = 'Y' THEN 'Y' ELSE 'N' END AS true_fa_flag,
    coalesce(fabric_subsector_step_cnt, 0) + coalesce(hair_subsector_step_cnt, 0)
      + coalesce(other_subsector_cnt, 0) AS subsector_sales_cnt,
    net_weight_qty / nullif(sum_weight, 0) AS load_material_weight_qty,
    net_vol_qty / nullif(sum_vol, 0) AS load_material_vol_qty,
    coalesce(load_gbu_id, 'OTHER') AS combined_gbu_code
  FROM (SELECT DISTINCT * FROM trucked) t
  JOIN stats s ON t.load_id = s.load_id AND t.trans_stage_num = s.min_stage
  LEFT JOIN planned p ON t.load_id = p.load_id
  LEFT JOIN shipped sh ON t.load_id = sh.load_id
  LEFT JOIN cost c ON t.load_id = c.load_id
  LEFT JOIN freight f ON t.load_id = f.load_id
  LEFT JOIN priority pr ON t.load_id = pr.load_id
  LEFT JOIN final_stop fs ON t.load_id = fs.load_id
  LEFT JOIN awarded a ON t.load_id = a.load_id AND t.carr_id = a.carr_id
    AND c.tms_service_code = a.tms_service_code
  LEFT JOIN hierarchy h ON t.ship_to_party_id = h.ship_to_party_id
  LEFT JOIN (SELECT tdcval_code, max(category) AS category FROM value_categories GROUP BY 1) v
    ON t.tdcval_code = v.tdcval_code
  ),
lane AS (
  SELECT origin_zone_ship_from_code, dest_ship_from_code,
    sum(w) / nullif(sum(v), 0) AS load_density_rate,
    CASE WHEN sum(w) / nullif(sum(v), 0) < 0.5 THEN 'Low' ELSE 'Normal' END AS low_density_site_val
  FROM (SELECT DISTINCT load_id, origin_freight_code, filled_weight, filled_vol,
      oblb_gross_weight_shipped_qty, oblb_gross_vol_shipped_qty, shipped_gross_weight_qty AS w,
      shipped_gross_vol_qty AS v, origin_zone_ship_from_code, dest_ship_from_code FROM prepared
    WHERE origin_zone_ship_from_code IS NOT NULL)
  GROUP BY 1, 2),
pallets AS (
  SELECT load_id, sum(pallet_shipped_qty / nullif(shipped_load_cnt, 0)) AS pallet_load_qty
  FROM (SELECT DISTINCT load_id, pallet_shipped_qty, shipped_load_cnt FROM prepared) GROUP BY 1),
valued AS (
  SELECT p.*, pallet_load_qty, load_density_rate, low_density_site_val,
    coalesce(actual_carr_total_trans_cost_usd_amt, actual_cost_amt) AS cost_amt,
    CASE WHEN density_rate < load_density_rate THEN 1 ELSE 0 END AS check_density,
    (1 - pallet_shipped_qty / nullif(max_pallet_tms_trans_type_qty, 0))
      * coalesce(actual_carr_total_trans_cost_usd_amt, actual_cost_amt) AS pallet_impact_amt,
    0.11::DOUBLE * coalesce(actual_carr_total_trans_cost_usd_amt, actual_cost_amt)
      AS opertng_space_impact_amt,
    shipped_net_vol_qty / nullif(max_vol_trans_mgmt_sys_qty, 0) AS net_vol_fill_rate,
    greatest(plan_net_weight_qty, shipped_net_weight_qty) AS max_net_weight_order_qty
  FROM prepared p LEFT JOIN pallets USING (load_id)
  LEFT JOIN lane USING (origin_zone_ship_from_code, dest_ship_from_code)),
averages AS (
  SELECT load_id, avg(plan_net_weight_qty) / nullif(avg(plan_net_vol_qty), 0)
      AS net_density_order_qty, sum(pallet_spot_qty) AS sum_pallet_spot_qty
  FROM (SELECT DISTINCT load_id, max_net_weight_order_qty, net_vol_fill_rate, plan_net_weight_qty,
      plan_net_vol_qty, pallet_spot_qty FROM valued)
  GROUP BY 1),
impact AS (
  SELECT v.* REPLACE (coalesce(tac_freight_type_code, vfr_freight_type_code) AS tac_freight_type_code),
    net_density_order_qty, sum_pallet_spot_qty, site_name AS origin_site_name,
    net_density_order_qty * 3533.0 AS calc_std_weight_qty,
    max_weight_qty - shipped_gross_weight_qty AS hopade_amt,
    CASE WHEN plan_net_weight_qty < shipped_net_weight_qty THEN 0
      ELSE plan_net_weight_qty - shipped_net_weight_qty END AS max_orders_incrmtl_amt,
    CASE WHEN plan_net_vol_qty < shipped_net_vol_qty THEN 0
      ELSE plan_net_vol_qty - shipped_net_vol_qty END AS glb_segment_impact_cat_ld_amt,
    max_vol_trans_mgmt_sys_qty - shipped_gross_vol_qty AS drf_last_truck_amt,
    CASE WHEN 1 - shipped_gross_weight_qty / nullif(plan_gross_weight_qty, 0) < 0 THEN 0
      ELSE 1 - shipped_gross_weight_qty / nullif(plan_gross_weight_qty, 0) END AS cut_impact_rate,
    max_net_weight_order_qty - plan_net_weight_qty AS max_orders_non_drp_amt,
    (load_density_rate - density_rate) / nullif(load_density_rate, 0) AS prod_density_gap_impact_pct
  FROM valued v LEFT JOIN averages USING (load_id)
  LEFT JOIN origin_names ON origin_zone_ship_from_code = origin_sf_dict),
hub AS (
  SELECT i.*, greatest(hopade_amt, 0) AS hopade_amt_dec,
    greatest(max_orders_incrmtl_amt, 0) + greatest(hopade_amt, 0) + greatest(drf_last_truck_amt, 0)
      + greatest(max_orders_non_drp_amt, 0) AS total_vf_optny_amt,
    t.* EXCLUDE (load_gbu_id), oblb_gross_weight_plan_qty AS weight_avg_qty
  FROM impact i LEFT JOIN (
    SELECT load_gbu_id, sum(max_orders_incrmtl_amt) AS sum_max_orders_incrmtl_amt,
      sum(max_orders_non_drp_amt) AS sum_max_orders_non_drp_amt, sum(hopade_amt) AS sum_hopade_amt,
      sum(drf_last_truck_amt) AS sum_drf_last_truck_amt
    FROM impact GROUP BY 1) t ON i.load_gbu_id = t.load_gbu_id)
"""


def _columns(plain: list[str], rounded: list[str]) -> str:
    return ", ".join([*plain, *(f"round({c}, 6) AS {c}" for c in rounded)])


_HUB_PLAIN = (
    """load_id load_gbu_id material_doc_num ship_to_party_id tdcval_code dlvry_item_num
    vfr_freight_type_code ship_cond_desc trans_stage_num dlvry_id order_num carr_id
    ordered_shipped_flag truck_type_code min_trans_stage_flag shipped_load_cnt palletsshipped
    pallet_shipped_qty primary_carr_flag true_fa_flag origin_freight_code subsector_sales_cnt
    combined_gbu_code shipped_net_weight_qty shipped_gross_vol_qty plan_gross_weight_qty
    plan_net_vol_qty step_factor su_per_load_cnt load_builder_prty_val
    avg_average_awarded_weekly_volume customer_lvl3_desc trade_chanl_desc sambc_flag categ_name
    final_ship_to_party_id low_density_site_val origin_site_name tac_freight_type_code
    check_density sum_pallet_spot_qty hopade_amt max_orders_incrmtl_amt
    glb_segment_impact_cat_ld_amt drf_last_truck_amt max_orders_non_drp_amt
    sum_max_orders_incrmtl_amt sum_max_orders_non_drp_amt sum_hopade_amt sum_drf_last_truck_amt
    weight_avg_qty gbu_code gbu_desc ship_to_party_desc net_weight_qty gross_weight_qty net_vol_qty
    gross_vol_qty oblb_gross_weight_plan_qty oblb_gross_weight_shipped_qty
    oblb_net_weight_plan_qty oblb_gross_vol_plan_qty oblb_gross_vol_shipped_qty
    oblb_net_vol_plan_qty max_weight_qty max_vol_trans_mgmt_sys_qty
    max_pallet_tms_trans_type_qty floor_position_qty pallet_qty theortc_pallet_qty
    actual_cost_amt shpmt_start_date fiscal_year_num fiscal_year_perd_num pallet_num_qty
    pallet_spot_qty total_gross_weight_qty total_gross_vol_qty shipped_net_vol_qty
    shipped_gross_weight_qty plan_gross_vol_qty plan_net_weight_qty actual_carr_trans_cost_amt
    linehaul_cost_amt fuel_cost_amt fabric_subsector_step_cnt hair_subsector_step_cnt
    other_subsector_cnt origin_zone_ship_from_code origin_loc_id origin_zone_code
    dest_ship_from_code dest_zone_code dest_loc_code tms_service_code freight_auction_flag
    actual_carr_total_trans_cost_usd_amt max_freight_cost_charge_code customer_lvl1_code
    customer_lvl1_desc customer_lvl3_code customer_lvl5_code customer_lvl5_desc
    customer_lvl12_code customer_lvl12_desc trade_chanl_id max_net_weight_order_qty
    transport_num linkage_item_num linkage_kind_code leo_tour_id release_dttm
    truck_vehicle_type_code vehicle_true_max_vol_qty vehicle_true_max_weight_qty""".split()
)
_HUB_ROUNDED = (
    """avg_award_weekly_vol_qty weight_vol_plan_qty density_rate load_material_weight_qty
    load_material_vol_qty load_density_rate pallet_load_qty pallet_impact_amt opertng_space_impact_amt net_vol_fill_rate
    net_density_order_qty calc_std_weight_qty cut_impact_rate prod_density_gap_impact_pct
    hopade_amt_dec total_vf_optny_amt""".split()
)
_HUB_COLUMNS = _columns(_HUB_PLAIN, _HUB_ROUNDED)

ORACLE["mart_fill_hub"] = f"WITH {_HUB_SOURCES}, {_HUB} SELECT {_HUB_COLUMNS} FROM hub"

# columns of the load rollup with a rule of their own; all others of the hub are the highest of their rows
_FILL_LOAD_OWN = """load_id gbu_desc gbu_code load_gbu_id fiscal_year_num fiscal_year_perd_num net_weight_qty
    net_vol_qty total_vf_optny_amt total_gross_weight_qty oblb_gross_weight_plan_qty total_gross_vol_qty
    oblb_gross_vol_plan_qty pallet_spot_qty floor_position_qty pallet_qty theortc_pallet_qty
    load_material_weight_qty load_material_vol_qty gross_weight_qty gross_vol_qty cut_impact_rate
    drf_last_truck_amt glb_segment_impact_cat_ld_amt hopade_amt max_orders_non_drp_amt
    max_orders_incrmtl_amt""".split()
_FILL_LOAD_MAX = ", ".join(f"max({c}) AS {c}" for c in [*_HUB_PLAIN, *_HUB_ROUNDED] if c not in _FILL_LOAD_OWN)
_FILL_LOAD_BUCKETS = """oblb_gross_weight_plan_qty oblb_gross_weight_shipped_qty oblb_net_weight_plan_qty
    oblb_gross_vol_plan_qty oblb_gross_vol_shipped_qty oblb_net_vol_plan_qty""".split()
_FILL_LOAD_MAX += "".join(f", max(coalesce({c}, 0)) AS {c}_load" for c in _FILL_LOAD_BUCKETS)

_FILL_LOAD_COLUMNS = _columns(
    [*_HUB_PLAIN, *(f"{c}_load" for c in _FILL_LOAD_BUCKETS), "tfs_su_per_load_qty", "tfs_step_factor"],
    [*_HUB_ROUNDED, "agg_gross_weight_qty", "agg_gross_vol_qty", "agg_net_weight_qty", "agg_net_vol_qty", "tfs_total_cost_amt"],
)

ORACLE["mart_fill_load"] = f"""
WITH {_HUB_SOURCES}, {cte('unit_costs')}, {_HUB}, {_UNIT_COSTS},
gross AS (
  SELECT load_id, sum(a) AS total_gross_weight_qty, sum(b) AS oblb_gross_weight_plan_qty,
    sum(c) AS total_gross_vol_qty, sum(d) AS oblb_gross_vol_plan_qty, sum(e) AS pallet_spot_qty
  FROM (SELECT DISTINCT load_id, total_gross_weight_qty AS a, oblb_gross_weight_plan_qty AS b,
    total_gross_vol_qty AS c, oblb_gross_vol_plan_qty AS d, pallet_spot_qty AS e FROM hub)
  GROUP BY 1),
positions AS (
  SELECT load_id, sum(DISTINCT floor_position_qty) AS floor_position_qty,
    sum(DISTINCT pallet_qty) AS pallet_qty, sum(DISTINCT theortc_pallet_qty) AS theortc_pallet_qty
  FROM hub GROUP BY 1),
material AS (
  SELECT load_id, load_gbu_id, sum(load_material_weight_qty) AS load_material_weight_qty,
    sum(load_material_vol_qty) AS load_material_vol_qty, sum(gross_weight_qty) AS gross_weight_qty,
    sum(gross_vol_qty) AS gross_vol_qty, sum(drf_last_truck_amt) AS drf_last_truck_amt,
    sum(glb_segment_impact_cat_ld_amt) AS glb_segment_impact_cat_ld_amt,
    sum(max_orders_non_drp_amt) AS max_orders_non_drp_amt,
    sum(cut_impact_rate) AS cut_impact_rate, sum(hopade_amt) AS hopade_amt,
    sum(max_orders_incrmtl_amt) AS max_orders_incrmtl_amt,
    max(plan_net_weight_qty) AS pw, max(plan_net_vol_qty) AS pv
  FROM (SELECT DISTINCT load_id, load_gbu_id, tdcval_code, material_doc_num, dlvry_item_num,
      gross_weight_qty, gross_vol_qty, load_material_weight_qty, load_material_vol_qty,
      plan_net_weight_qty, plan_net_vol_qty, cut_impact_rate, drf_last_truck_amt,
      glb_segment_impact_cat_ld_amt, hopade_amt, max_orders_non_drp_amt, max_orders_incrmtl_amt
    FROM hub)
  GROUP BY 1, 2),
units_of_load AS (
  SELECT load_id, gbu_desc, gbu_code, load_gbu_id, {_FILL_LOAD_MAX},
    max(fiscal_year_num::INTEGER) AS fiscal_year_num,
    max(fiscal_year_perd_num::INTEGER) AS fiscal_year_perd_num,
    sum(net_weight_qty) AS net_weight_qty,
    sum(net_vol_qty) AS net_vol_qty, sum(total_vf_optny_amt) AS total_vf_optny_amt
  FROM hub GROUP BY 1, 2, 3, 4),
fill_load AS (
  SELECT u.*, m.* EXCLUDE (load_id, load_gbu_id), g.* EXCLUDE (load_id), p.* EXCLUDE (load_id),
    tfs_su_per_load_qty, tfs_total_cost_amt, tfs_step_factor,
    total_gross_weight_qty * load_material_weight_qty AS agg_gross_weight_qty,
    total_gross_vol_qty * load_material_vol_qty AS agg_gross_vol_qty,
    pw * load_material_weight_qty AS agg_net_weight_qty, pv * load_material_vol_qty AS agg_net_vol_qty
  FROM units_of_load u
  JOIN material m ON u.load_id = m.load_id AND u.load_gbu_id IS NOT DISTINCT FROM m.load_gbu_id
  JOIN gross g ON u.load_id = g.load_id JOIN positions p ON u.load_id = p.load_id
  LEFT JOIN cost_of_unit c ON u.load_id = c.load_id AND u.load_gbu_id = c.load_gbu_id)
SELECT {_FILL_LOAD_COLUMNS} FROM fill_load
"""

# --- scorecard ------------------------------------------------------------------------------

_SCORECARD_SOURCES = cte("tender_weekly", "on_time_view", "loading_view", "fill_view")

_SCORECARD = """
tender AS (
  SELECT calendar_year_week_tac AS week, carrier_id AS carrier, tms_service_code AS service,
    origin_location_id AS origin, origin_zone_ship_from_code AS zone, dest_ship_from_code AS dest,
    lane, lpad(carrier_id, 10, '0') AS long_carrier, accept_cnt, total_cnt, linehaul_cost_amt
  FROM tender_weekly),
facts AS (
  SELECT parent_loc_code, dest_ship_from_code AS dest, ship_to_party_code, carr_num AS carrier,
    service_tms_code AS service, origin_code AS origin, origin_zone_ship_from_code,
    ship_week_num AS week, max(ship_to_party_desc) AS ship_to_party_desc,
    max(dest_sold_to_name) AS dest_sold_to_name, max(actual_ship_date) AS actual_ship_date,
    max(freight_type_val) AS freight_type_val, max(cdot_ontime_cnt) AS cdot_ontime_cnt,
    max(parent_carr_name) AS parent_carr_name, max(carr_desc) AS carr_desc,
    sum(shpmt_cnt)::BIGINT AS shpmt_cnt,
    sum(shpmt_on_time_cnt)::BIGINT AS shpmt_on_time_cnt,
    sum(measrbl_shpmt_cnt)::BIGINT AS measrbl_shpmt_cnt
  FROM on_time_view GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
per_origin AS (
  SELECT week, carrier, service, origin, dest, max(parent_loc_code) AS parent_loc_code,
    max(ship_to_party_desc) AS ship_to_party_desc, max(dest_sold_to_name) AS dest_sold_to_name,
    max(actual_ship_date) AS actual_ship_date, max(freight_type_val) AS freight_type_val,
    max(cdot_ontime_cnt) AS cdot_ontime_cnt, max(parent_carr_name) AS parent_carr_name,
    max(carr_desc) AS carr_desc, sum(shpmt_cnt)::BIGINT AS shpmt_cnt, sum(shpmt_on_time_cnt)::BIGINT AS shpmt_on_time_cnt,
    sum(measrbl_shpmt_cnt)::BIGINT AS measrbl_shpmt_cnt
  FROM facts f WHERE NOT EXISTS (SELECT 1 FROM tender t WHERE t.week = f.week
    AND t.carrier = f.carrier AND t.service = f.service AND t.origin = f.origin AND t.dest = f.dest)
  GROUP BY 1, 2, 3, 4, 5),
per_lane AS (
  SELECT week, carrier, service, parent_loc_code, dest, max(origin) AS monster,
    max(ship_to_party_desc) AS ship_to_party_desc, max(dest_sold_to_name) AS dest_sold_to_name,
    max(actual_ship_date) AS actual_ship_date, max(freight_type_val) AS freight_type_val,
    max(cdot_ontime_cnt) AS cdot_ontime_cnt, max(parent_carr_name) AS parent_carr_name,
    max(carr_desc) AS carr_desc, {counts}(shpmt_cnt)::BIGINT AS shpmt_cnt,
    {counts}(shpmt_on_time_cnt)::BIGINT AS shpmt_on_time_cnt,
    {counts}(measrbl_shpmt_cnt)::BIGINT AS measrbl_shpmt_cnt
  FROM per_origin GROUP BY 1, 2, 3, 4, 5),
first_tier AS (
  SELECT f.week, f.carrier, f.service, f.origin, f.origin AS monster, f.dest, f.parent_loc_code,
    zone, carr_desc, ship_to_party_desc, dest_sold_to_name, actual_ship_date, freight_type_val, parent_carr_name,
    cdot_ontime_cnt, shpmt_cnt, shpmt_on_time_cnt, measrbl_shpmt_cnt, lane, long_carrier, accept_cnt,
    total_cnt, linehaul_cost_amt, CASE WHEN t.week IS NULL THEN 0 ELSE 1 END AS match_tier
  FROM facts f LEFT JOIN tender t ON t.week = f.week AND t.carrier = f.carrier
    AND t.service = f.service AND t.origin = f.origin AND t.dest = f.dest),
second_tier AS (
  SELECT f.week, f.carrier, f.service, t.origin, f.monster, f.dest, f.parent_loc_code,
    f.parent_loc_code AS zone, carr_desc, ship_to_party_desc, dest_sold_to_name, actual_ship_date, freight_type_val, parent_carr_name,
    cdot_ontime_cnt, shpmt_cnt, shpmt_on_time_cnt, measrbl_shpmt_cnt, lane, long_carrier, accept_cnt,
    total_cnt, linehaul_cost_amt, CASE WHEN t.week IS NULL THEN 0 ELSE 2 END AS match_tier
  FROM per_lane f LEFT JOIN tender t ON t.week = f.week AND t.carrier = f.carrier
    AND t.service = f.service AND t.zone = f.parent_loc_code AND t.dest = f.dest),
load_facts AS (
  SELECT ship_point_code AS monster, dest_ship_from_code AS dest, carr_num AS carrier,
    actual_service_tms_code AS service, ship_week_num AS week,
    sum(lot_otd_cnt)::BIGINT AS lot_otd_count,
    sum(lot_tat_late_counter_val)::BIGINT AS lot_tat_late_counter_val,
    sum(lot_cust_failure_cnt)::BIGINT AS lot_customer_failure_cnt,
    sum(shipper_failure_cnt)::BIGINT AS shipper_failure_cnt,
    sum(carr_failure_cnt)::BIGINT AS carr_failure_cnt,
    sum(others_failure_cnt)::BIGINT AS others_failure_cnt, max(tolrnc_sot_val) AS tolrnc_sot_val
  FROM loading_view GROUP BY 1, 2, 3, 4, 5),
fill_days AS (
  SELECT *, strptime(shpmt_start_date, '%d/%m/%Y') AS day FROM fill_view),
fill_facts AS (
  SELECT ship_point_code AS monster, dest_ship_from_code AS dest, ltrim(carr_id, '0') AS carrier,
    tms_service_code AS service, {week} AS week,
    {fill}
  FROM fill_days GROUP BY 1, 2, 3, 4, 5),
both_tiers AS (
  SELECT * FROM first_tier WHERE {first} UNION ALL SELECT * FROM second_tier)
SELECT b.week AS week_year_val, b.carrier AS forward_agent_id, b.service AS service_tms_code,
  b.origin AS origin_code, b.monster AS monster_origin_code, b.dest AS dest_ship_from_code,
  match_tier, parent_loc_code, zone AS origin_zone_ship_from_code, carr_desc, ship_to_party_desc, dest_sold_to_name, actual_ship_date,
  freight_type_val, parent_carr_name, cdot_ontime_cnt, shpmt_cnt, shpmt_on_time_cnt,
  measrbl_shpmt_cnt, lane AS lane_name, long_carrier AS long_forward_agent_id, accept_cnt,
  total_cnt, linehaul_cost_amt, l.* EXCLUDE (monster, dest, carrier, service, week),
  v.* EXCLUDE (monster, dest, carrier, service, week)
FROM both_tiers b
LEFT JOIN load_facts l ON b.monster = l.monster AND b.dest = l.dest AND b.carrier = l.carrier
  AND b.service = l.service AND b.week = l.week
LEFT JOIN fill_facts v ON b.monster = v.monster AND b.dest = v.dest AND b.carrier = v.carrier
  AND b.service = v.service AND b.week = v.week
WHERE b.monster <> 'NULL'
"""

_PADDED = "lpad(weekofyear(day)::VARCHAR, 2, '0') || '/' || year(day)::VARCHAR"
_UNPADDED = "weekofyear(day)::VARCHAR || '/' || year(day)::VARCHAR"

_BOTH = ["max_weight_qty", "max_vol_trans_mgmt_sys_qty"] + [
    f"{k}_{b}_{m}_qty" for k in ("plan", "shipped") for b in ("gross", "net") for m in ("weight", "vol")
]
_SUMMED = [
    "su_per_load_cnt",
    "cut_impact_rate",
    "drf_last_truck_amt",
    "glb_segment_impact_cat_ld_amt",
    "hopade_amt",
    "max_orders_incrmtl_amt",
    "max_orders_non_drp_amt",
    "total_vf_optny_amt",
]
_FILL = ", ".join(
    [f"sum({c}) AS {c}" for c in _BOTH + _SUMMED]
    + [f"sum({c}) / count({c}) AS avg_{c}" for c in _BOTH]
    + [f"sum({c}) / count({c}) AS {c}" for c in ("floor_position_qty", "max_pallet_tms_trans_type_qty")]
)

ORACLE["mart_scorecard"] = f"WITH {_SCORECARD_SOURCES}, " + _SCORECARD.format(
    week=_PADDED, first="match_tier = 1", counts="sum", fill=_FILL
)
ORACLE["mart_scorecard_with_duplicates"] = f"WITH {_SCORECARD_SOURCES}, " + _SCORECARD.format(
    week=_UNPADDED, first="TRUE", counts="max", fill=_FILL
)

# --- sources, sinks and jobs ------------------------------------------------------------------

_COUNTED = " UNION ALL ".join(
    f"""SELECT '{n}' AS source, (SELECT count(*) FROM {n}) AS rows,
  (SELECT count(*) FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM {n}) ON COLUMNS(*))) AS filled"""
    for n in FRAMES
)

ORACLE["sources_by_name"] = f"WITH {cte(*FRAMES)} {_COUNTED}"

ORACLE["job_loading"] = f"""
SELECT load_id, change_type_code, ship_year::BIGINT AS ship_year, lot_otd_cnt::DOUBLE AS lot_otd_cnt
FROM ({ORACLE["mart_loading"]})
"""
ORACLE["job_tenders"] = ORACLE["mart_tender_shipments_repeated"]
ORACLE["job_interplant"] = ORACLE["mart_interplant"]
ORACLE["job_fill_load"] = ORACLE["mart_fill_load"]
ORACLE["job_scorecard"] = ORACLE["mart_scorecard"]

# --- targets, formulas and stages -----------------------------------------------------------

ORACLE["overwrite_survives_failure"] = """
SELECT o_orderkey, o_orderstatus, o_custkey + 1 AS o_custkey FROM orders WHERE o_orderstatus <> 'P'
"""

ORACLE["formula_graph"] = """
WITH g AS (SELECT *, l_extendedprice + 1 AS gross FROM lineitem),
n AS (SELECT *, gross - gross * l_discount AS exact FROM g)
SELECT l_orderkey, l_linenumber, lower(l_returnflag) AS l_returnflag, round(exact, 6) AS net,
  'net ' || lower(l_returnflag) || ' ' || CASE WHEN exact > 50000 THEN 'high' ELSE 'low' END AS label
FROM n
"""

ORACLE["tender_lanes_newest_folders"] = ORACLE["mart_tender_lanes"]
ORACLE["tender_shipments_pruned"] = ORACLE["mart_tender_shipments"]

ORACLE["fill_loads_bucketed"] = f"""
WITH {_HUB_SOURCES}, {_HUB}
SELECT s.load_id, shipped_load_cnt, min_stage AS min_trans_stage_num, pallet_shipped_qty AS avg_palletsshipped,
  sum_weight AS sum_material_weight_qty, sum_vol AS sum_material_vol_qty,
  shipped_net_weight_qty, shipped_net_vol_qty, shipped_gross_weight_qty, shipped_gross_vol_qty,
  plan_net_weight_qty, plan_net_vol_qty, plan_gross_weight_qty, plan_gross_vol_qty,
  actual_carr_total_trans_cost_usd_amt, tms_service_code, step_factor, su_per_load_cnt,
  max_freight_cost_charge_code, load_builder_prty_val, final_ship_to_party_id
FROM stats s LEFT JOIN planned p ON s.load_id = p.load_id LEFT JOIN shipped sh ON s.load_id = sh.load_id
LEFT JOIN cost c ON s.load_id = c.load_id LEFT JOIN freight f ON s.load_id = f.load_id
LEFT JOIN priority pr ON s.load_id = pr.load_id LEFT JOIN final_stop fs ON s.load_id = fs.load_id
"""

ORACLE["stage_figures"] = f"""
WITH {_HUB_SOURCES}, {_HUB},
counted AS (
  SELECT 'delivery_items' AS stage, count(*) AS rows, 0 AS null_keys FROM delivery_items
  UNION ALL SELECT 'items', count(*), count(*) FILTER (WHERE load_id IS NULL OR load_gbu_id IS NULL) FROM trucked
  UNION ALL SELECT 'costs', count(*), count(*) FILTER (WHERE load_id IS NULL) FROM load_costs
  UNION ALL SELECT 'freight', count(*), count(*) FILTER (WHERE shpmt_id IS NULL) FROM freight_stats
  UNION ALL SELECT 'priorities', count(*), count(*) FILTER (WHERE load_id IS NULL) FROM on_time_events
    WHERE load_builder_prty_val::INT > 0)
SELECT stage, 'rows' AS figure, rows AS value FROM counted UNION ALL SELECT stage, 'null_keys', null_keys FROM counted
UNION ALL SELECT 'items', 'fan_out', (SELECT count(*) FROM trucked) // (SELECT count(*) FROM delivery_items)
"""

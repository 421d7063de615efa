"""Loading on time: the latest pick-up check-in and check-out of each load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import LOADING, apply_formulas, check_names
from ..functions.keys import composite_key, normalize_key
from ..functions.periods import EVENT_STAMP_SENTINEL, parse_dmy, parse_event_stamp
from ..functions.rules import non_blank, not_sentinel, presence
from ..operators.dedupe import drop_linked_children, latest_per_key

# Change types of a pick-up check-in and check-out.
PICK_UP_EVENTS = ["PICKCI", "PICKCO"]
FIRST_STAGE = "1"

# Event columns that have another name in the result.
RESULT_NAMES = {"dest_zone_code": "dest_zone_val", "frt_type_desc": "freight_type_val"}


def pick_up_events(events: DataFrame) -> DataFrame:
    """First-stage pick-up events with all the dates and reasons the result needs."""
    return events.filter(
        (F.col("trnsp_stage_num") == FIRST_STAGE)
        & F.col("change_type_code").isin(PICK_UP_EVENTS)
        & non_blank("actual_load_end_date")
        & non_blank("final_lrdt_date")
        & non_blank("lot_delay_reason_code_desc")
        & non_blank("event_datetm")
        & not_sentinel("event_datetm", EVENT_STAMP_SENTINEL)
    )


def build(events: DataFrame, *, formulas: Mapping[str, str] | None = None) -> DataFrame:
    """Latest event per load and change type, loads that are children of another left out."""
    check_names(formulas, LOADING)
    children = events.select(normalize_key("child_shpmt_num", mode="one").alias("child_load_id"))
    picked = drop_linked_children(pick_up_events(events), "load_id", children, "child_load_id")
    latest = latest_per_key(picked, ["load_id", "change_type_code"], ["event_datetm"])
    dated = latest.withColumnsRenamed(RESULT_NAMES).withColumns(
        {
            "event_date": parse_event_stamp("event_datetm").cast("date"),
            "load_end_date": parse_dmy("actual_load_end_date"),
            "ready_date": parse_dmy("final_lrdt_date"),
        }
    )
    dated = apply_formulas(dated, LOADING, formulas)
    label = composite_key("ship_3lettermonth", "ship_year", sep=" ")
    return dated.withColumns(
        {
            "actual_ship_month_val": label,
            "load_num_per_load_id_cnt": presence("load_id"),
            "last_update_utc_tmstp": F.current_timestamp(),
        }
    ).drop("event_date", "load_end_date", "ready_date")

"""Column functions on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulgrain.functions.formulas import apply_formulas
from haulgrain.functions.keys import composite_key, normalize_key, padded_key, tail_key
from haulgrain.functions.periods import (
    parse_date_time,
    parse_dmy,
    parse_event_stamp,
    year_week_key,
)
from haulgrain.functions.rules import (
    clamp_floor,
    dispatch_by_code,
    measurable,
    non_blank,
    not_sentinel,
    not_text_null,
    on_time_flag,
    presence,
    safe_ratio,
)
from haulgrain.plans.on_time import PROFILE_PROMISES


def values(spark, inputs, column, kind="string"):
    """The column over one-column input ``x``, in input order."""
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("y")).collect()]


KEYS = ["0123", "00123", "0", "", None, "123456789012", "000"]


def test_normalize_key_strips_all_or_one_zero(spark):
    assert values(spark, KEYS, normalize_key("x")) == ["123", "123", "", "", None, "123456789012", ""]
    one = ["123", "0123", "", "", None, "123456789012", "00"]
    assert values(spark, KEYS, normalize_key("x", mode="one")) == one
    kept = ["123", "123", "0", "", None, "123456789012", "0"]
    assert values(spark, KEYS, normalize_key("x", keep_zero=True)) == kept
    with pytest.raises(ValueError):
        normalize_key("x", mode="some")


def test_tail_and_padding_do_not_lose_characters(spark):
    assert values(spark, ["1234567890", "123", "", None], tail_key("x", 9)) == [
        "234567890",
        "123",
        "",
        None,
    ]
    assert values(spark, ["7", "12345678901", None], padded_key("x", 10)) == [
        "0000000007",
        "12345678901",
        None,
    ]


def test_composite_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "p string, q string")
    assert [r[0] for r in df.select(composite_key("p", "q")).collect()] == ["a-b", None]


WEEKS = [dt.date(2018, 12, 31), dt.date(2021, 1, 1), dt.date(2020, 7, 1), None]


def test_year_week_key_modes(spark):
    assert values(spark, WEEKS, year_week_key("x"), "date") == ["201901", "202053", "202027", None]
    calendar = year_week_key("x", year_mode="calendar")
    assert values(spark, WEEKS, calendar, "date") == ["201801", "202153", "202027", None]
    slash = year_week_key("x", "ww/yyyy", "calendar")
    assert values(spark, WEEKS, slash, "date") == ["01/2018", "53/2021", "27/2020", None]
    bare = year_week_key("x", "ww/yyyy", "calendar", pad=False)
    assert values(spark, WEEKS[:1], bare, "date") == ["1/2018"]


def test_bad_date_texts_are_null(spark):
    dates = ["31/12/2020", "99/99/2020", "", None, "abc"]
    at_eight = parse_date_time("x", F.lit("08:00:00"))
    assert values(spark, dates, F.date_format(at_eight, "yyyyMMddHH")) == [
        "2020123108",
        None,
        None,
        None,
        None,
    ]
    other = parse_date_time("x", F.lit("08:00"), "dd/MM/yyyy HH:mm")
    assert values(spark, ["31/12/2020", "1/1/2020"], F.hour(other)) == [8, None]
    strict = parse_date_time("x", F.lit("24:00:00"))
    assert values(spark, ["31/12/2020", "31/02/2020"], strict) == [None, None]
    assert values(spark, ["1/2/2020", "29/02/2020", "30/02/2020"], at_eight) == [
        None,
        dt.datetime(2020, 2, 29, 8),
        None,
    ]
    assert values(spark, ["31.12.2020", "31/13/2020", None], parse_dmy("x")) == [
        dt.date(2020, 12, 31),
        None,
        None,
    ]
    stamps = ["20200229120000", "99991231235959", "2020", None]
    assert values(spark, stamps, F.year(parse_event_stamp("x"))) == [2020, None, None, None]


def test_text_predicates(spark):
    texts = ["ab", "a", "", None, "NULL"]
    assert values(spark, texts, non_blank("x")) == [True, False, False, False, True]
    assert values(spark, texts, not_text_null("x")) == [True, True, True, None, False]
    assert values(spark, texts, not_sentinel("x", "ab")) == [False, True, True, None, True]


def test_measurable_needs_status_and_every_date(spark):
    rows = [("7", "d", "d"), ("7", "NULL", "d"), ("7", None, "d"), ("3", "d", "d"), ("7", "", "d")]
    df = spark.createDataFrame(rows, "s string, a string, b string")
    assert df.filter(measurable("s", ["a", "b"])).count() == 2


def test_ratio_and_clamp(spark):
    assert values(spark, [2, 0, None], safe_ratio(F.lit(1), "x", 100), "int") == [50.0, None, None]
    assert values(spark, [-1.0, 0.0, 2.5, None], clamp_floor("x"), "double") == [0.0, 0.0, 2.5, None]


def test_on_time_flag_has_three_values(spark):
    rows = [(2, 1), (1, 1), (1, 2), (None, 1), (1, None)]
    df = spark.createDataFrame(rows, "p int, a int")
    assert [r[0] for r in df.select(on_time_flag("p", "a")).collect()] == [1, 1, 0, None, None]


def test_profile_codes_pick_their_moment(spark):
    codes = ["APFD", "RDDAPF", "APF", "APLD", "RDDAPL", "APL", "RDD", "ORDD", "OTIF", "XX", None]
    columns = {codes_: F.lit(name) for codes_, name in PROFILE_PROMISES.items()}
    first, last, request, original = dict.fromkeys(PROFILE_PROMISES.values())
    assert values(spark, codes, dispatch_by_code("x", columns)) == [
        *[first] * 3,
        *[last] * 3,
        request,
        *[original] * 2,
        None,
        None,
    ]
    with pytest.raises(ValueError):
        dispatch_by_code("x", {})


def test_presence(spark):
    assert values(spark, ["a", None], presence("x")) == [1, 0]


def test_bad_numbers_become_null_not_errors(spark):
    assert values(spark, ["abc", "1.5", None], F.col("x").try_cast("double")) == [None, 1.5, None]
    assert values(spark, [1e40, 1.0], F.col("x").try_cast("decimal(38,6)").isNull(), "double") == [
        True,
        False,
    ]


def test_formulas_run_in_order_and_can_be_replaced(spark):
    df = spark.range(1).select(F.lit(6.0).alias("a"))
    group = {"b": "a * 2", "c": "b + {k}", "d": "try_divide(c, 0)"}
    row = apply_formulas(df, group, {"b": "a * 3"}, k=1.0).collect()[0]
    assert (row.b, row.c, row.d) == (18.0, 19.0, None)

"""Column rules on hand-written edge values."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from payfeed.functions import fields


def values(spark, kind, items, rule):
    """The rule's result for every item, in order."""
    rows = spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")
    return [r[1] for r in rows.select("i", rule(F.col("v")).alias("x")).orderBy("i").collect()]


def python_int(text, default=0):
    try:
        return default if text in (None, "") else int(text)
    except ValueError:
        return default


def python_float(text, default=0.0):
    try:
        return default if text in (None, "") else float(text)
    except ValueError:
        return default


WORDS = [None, "", " 12 ", "12.5", "abc", "+7", "-3", "1_000", "1__0", "_1", "1e3", "0x10", "1d", "2f", ".5", "5.",
         "1_0.5", "-1e-2", "true", "12 3", "\t9\n"]


def test_to_int_reads_text_like_python(spark):
    got = values(spark, "string", WORDS, lambda c: fields.to_int(c, 0, text=True))
    assert got == [python_int(w) for w in WORDS]


def test_to_float_reads_text_like_python(spark):
    got = values(spark, "string", WORDS, lambda c: fields.to_float(c, 0.0, text=True))
    assert got == [python_float(w) for w in WORDS]
    inf, nan = values(spark, "string", ["-inf", "NaN"], lambda c: fields.to_float(c, 0.0, text=True))
    assert inf == -math.inf and math.isnan(nan)


def test_to_int_cuts_fractions_and_survives_bad_numbers(spark):
    got = values(spark, "double", [12.9, -12.9, float("nan"), float("inf"), None], lambda c: fields.to_int(c, 1, text=False))
    assert got == [12, -12, 1, 1, 1]
    assert values(spark, "boolean", [True, False, None], lambda c: fields.to_int(c, 0, text=False)) == [1, 0, 0]


def test_round_money_decides_on_the_stored_value(spark):
    random.seed(7)
    ties = [2.675, 1.005, 0.125, 0.375, -2.675, -0.125, 1234567.125, 0.0, 2.5, 1e-9, 99.995, 8.345, 1e11 + 0.125]
    ties += [n / 1000 for n in range(5, 4000, 10)] + [random.uniform(-1e6, 1e6) for _ in range(500)]
    got = values(spark, "double", ties, fields.round_money)
    assert got == [round(x, 2) for x in ties]


def test_float_text_prints_like_python(spark):
    numbers = [0.0, -0.0, 1.0, 12345678.9, -98765432.125, 1e15, 1e16, 1.5e16, 1.5e300, 1e-4, 1.5e-5, 1e-10, 123456789012345.0,
               float("inf"), float("-inf"), 0.1, 400000.07]
    assert values(spark, "double", numbers, fields.float_text) == [repr(x) for x in numbers]


def test_iso_text_shows_microseconds_only_when_present(spark):
    times = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120000), dt.datetime(2024, 1, 2, 3, 4, 5, 7), None]
    got = values(spark, "timestamp_ntz", times, lambda c: fields.iso_text(c, "timestamp_ntz"))
    assert got == [t and t.isoformat() for t in times]


def test_plain_text_and_first_ten_characters(spark):
    assert values(spark, "string", ["a", None], lambda c: fields.plain_text(c, "string")) == ["a", "None"]
    assert values(spark, "string", [None], lambda c: fields.plain_text(c, "string", None)) == [None]
    assert values(spark, "boolean", [True], lambda c: fields.plain_text(c, "boolean")) == ["True"]
    day = [dt.date(2024, 5, 6), None]
    assert values(spark, "date", day, lambda c: fields.ymd10(c, "date")) == ["2024-05-06", "None"]


def test_ymd_of_text(spark):
    got = values(spark, "string", ["2024-05-06 07:08:09", "2024-05-06", "soon", None], fields.ymd)
    assert got == ["2024-05-06", "2024-05-06", None, None]


def test_attendance_value(spark):
    assert values(spark, "double", [-1.0, None, 0.5, 0.0], fields.attendance_value) == [0.0, 0.0, 0.5, 0.0]


def test_gender_code(spark):
    assert values(spark, "string", ["Male", "FEMALE", "male", "x", "", None], fields.gender_code) == [1, 2, 1, 3, 3, 3]


def test_date_floor(spark):
    floor = fields.year_start_floor(dt.datetime(2026, 5, 5))
    assert floor == dt.date(2025, 1, 1)
    days = [dt.date(2024, 12, 31), dt.date(2025, 1, 1), dt.date(2025, 6, 1), None]
    assert values(spark, "date", days, lambda c: fields.date_floor(c, floor)) == [floor, floor, dt.date(2025, 6, 1), floor]


def test_effective_date_by_country(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1))],
        "eff timestamp_ntz, start timestamp_ntz",
    )
    def result(country):
        return [r[0] for r in rows.select(fields.effective_date(country, F.col("eff"), F.col("start"))).collect()]
    assert result("INDIA") == [dt.date(2024, 2, 1), dt.date(2024, 1, 1)]
    assert result("PHILIPPINES") == [dt.date(2024, 1, 1)] * 2
    assert result("THAILAND") == [dt.date(2024, 1, 1), None]
    with pytest.raises(ValueError):
        result("ELSEWHERE")


def test_signed_amount_has_no_negative_zero(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0), (2, 0.0), (None, 5.0)], "c int, a double")
    got = [r[0] for r in rows.select(fields.signed_amount(F.col("c"), F.col("a"))).collect()]
    assert [str(x) for x in got] == ["5.0", "-5.0", "0.0", "5.0"]


def test_minutes_and_hours(spark):
    got = values(spark, "string", ["90", "100", "", "  ", "x", None], lambda c: fields.overtime_hours(fields.minutes_value(c)))
    assert got == [1.5, 1.67, 0.0, 0.0, None, None]


def test_unit_code(spark):
    assert values(spark, "string", ["Hours", "Days", None], fields.unit_code) == ["H", "Days", None]


def test_split_list_drops_empty_items(spark):
    got = values(spark, "string", ["1|2", " 1 || 2|", "", None], fields.split_list)
    assert got == [["1", "2"], ["1", "2"], [], []]


def test_proper_case_works_per_item(spark):
    assert values(spark, "string", ["SSSEMPLOYEE,wTax", "a", None], fields.proper_case) == ["Sssemployee,Wtax", "A", None]


def test_is_open(spark):
    ends = [None, dt.datetime(1900, 1, 1), dt.datetime(2020, 1, 1)]
    assert values(spark, "timestamp_ntz", ends, fields.is_open) == [True, True, False]


def test_round_money_equals_python_near_every_tie(spark):
    rng = random.Random(11)
    some = [0.0, -0.0, math.inf, -math.inf, 1e300, 5e-324, 2.0**46, 2.0**46 - 2**-6, -(2.0**46) + 2**-7, 0.994999999, 0.995, 0.999999999999]
    for whole in [0, 1, 7, 1234, 10**6 + 1, 2**40 + 3, 2**45 + 1]:
        for cents in range(100):
            tie = whole + (2 * cents + 1) / 200
            some += [tie, math.nextafter(tie, math.inf), math.nextafter(tie, -math.inf), -tie]
    some += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 15) for _ in range(3000)]
    got = spark.createDataFrame([(v,) for v in some], "v double").select("v", fields.round_money(F.col("v")).alias("r")).collect()
    assert all(repr(r.r) == repr(round(r.v, 2)) for r in got), [(r.v, r.r, round(r.v, 2)) for r in got if repr(r.r) != repr(round(r.v, 2))][:5]
    odd = spark.createDataFrame([(None,), (math.nan,)], "v double").select(fields.round_money(F.col("v")).alias("r")).collect()
    assert odd[0].r is None and math.isnan(odd[1].r)

"""Filters, column rules and scalar functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payfeed.catalog.registry import (
    ROSTER_MARK,
    SALARY_AS_OF,
    SALARY_MARK,
    VARIABLE_AS_OF,
    VARIABLE_MARK,
    query,
)
from payfeed.catalog.star_schema import emp_code, hr_tables, read
from payfeed.functions import fields
from payfeed.operators import attributes, changes, predicates
from payfeed.operators.batching import iso_records
from payfeed.plans import overtime, variable

# A first run in the middle of a day.
BACKFILL_AS_OF = dt.datetime(2024, 4, 15, 12)


@query(
    "changed_strict",
    """SELECT EmpCode, "Date", UpdatedDate FROM rostering WHERE UpdatedDate > TIMESTAMP '2024-01-15 00:00:00'""",
)
def changed_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["rostering"]
    return changes.changed_since(rows, "UpdatedDate", ROSTER_MARK).select("EmpCode", "Date", "UpdatedDate")


@query(
    "changed_backfill",
    """SELECT EmpCode, "Date", UpdatedDate FROM rostering WHERE "Date" >= TIMESTAMP '2024-04-15 12:00:00' - INTERVAL 90 DAY""",
)
def changed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["rostering"]
    return changes.changed_since(
        rows, "UpdatedDate", None, backfill_col="Date", as_of=BACKFILL_AS_OF
    ).select("EmpCode", "Date", "UpdatedDate")


@query(
    "changed_inclusive",
    "SELECT EmpCode, HeadCode, updateDate FROM salary_master WHERE updateDate >= TIMESTAMP '2001-01-01 00:00:00'",
)
def changed_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["salary_master"]
    return changes.changed_since(rows, "updateDate", SALARY_MARK, inclusive=True).select(
        "EmpCode", "HeadCode", "updateDate"
    )


@query("changed_full", "SELECT EmpCode, HeadCode, updateDate FROM salary_master")
def changed_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["salary_master"]
    return changes.changed_since(rows, "updateDate", None, days=None).select("EmpCode", "HeadCode", "updateDate")


@query(
    "changed_keys",
    "SELECT DISTINCT EmpCode, updateDate FROM salary_master WHERE updateDate > TIMESTAMP '2001-01-01 00:00:00'",
)
def changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.changed_keys(hr_tables(spark, sf_dir)["salary_master"], "EmpCode", "updateDate", SALARY_MARK)


@query(
    "changed_employees",
    """SELECT EmpCode, HeadCode, MonthlyRate, updateDate FROM salary_master WHERE EmpCode IN
    (SELECT EmpCode FROM salary_master WHERE updateDate > TIMESTAMP '2001-01-01 00:00:00')""",
)
def changed_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["salary_master"]
    keys = changes.changed_keys(rows, "EmpCode", "updateDate", SALARY_MARK)
    return changes.only_changed(rows, keys, "EmpCode").select("EmpCode", "HeadCode", "MonthlyRate", "updateDate")


@query(
    "changed_days",
    """SELECT EmpCode, "Date", AttValue1, UpdatedDate FROM rostering r WHERE EXISTS (SELECT 1 FROM rostering c
    WHERE c.EmpCode = r.EmpCode AND c."Date" = r."Date" AND c.OT_Param_json IS NOT NULL
    AND c.OT_UpdatedDate > TIMESTAMP '2024-01-15 00:00:00')""",
)
def changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["rostering"]
    changed = changes.changed_since(rows.where(F.col("OT_Param_json").isNotNull()), "OT_UpdatedDate", ROSTER_MARK)
    days = changes.changed_days(rows, changed.select("EmpCode", "Date", "OT_UpdatedDate"), ["EmpCode", "Date"])
    return days.select("EmpCode", "Date", "AttValue1", "UpdatedDate")


@query("open_attributes", "SELECT * FROM open_rows")
def open_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    return attributes.attribute_rows(
        t["employee_attribute_details"], t["attribute_type_master"], t["attribute_unit_master"]
    )


@query(
    "current_salary",
    "SELECT EmpCode, HeadCode, MonthlyRate, FromDate FROM salary_master WHERE ToDate IS NULL AND MonthlyRate <> 0",
)
def current_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predicates.current_salary(hr_tables(spark, sf_dir)["salary_master"])
    return rows.select("EmpCode", "HeadCode", "MonthlyRate", "FromDate")


@query(
    "status_filter",
    """SELECT ED_EMPID, ED_Status, ED_Status IN (1, 10, 5, 6) AS onboarding_india, ED_Status IN (1, 10) AS active_or_notice,
    ED_Status IN (1) AS active FROM employee_details WHERE ED_Status IN (1, 10, 5, 6)""",
)
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("ED_Status")
    staff = predicates.with_status(hr_tables(spark, sf_dir)["employee_details"], predicates.STATUS_ONBOARDING_INDIA)
    return staff.select(
        "ED_EMPID",
        "ED_Status",
        fields.has_status(status, predicates.STATUS_ONBOARDING_INDIA).alias("onboarding_india"),
        fields.has_status(status, predicates.STATUS_ACTIVE_AND_NOTICE).alias("active_or_notice"),
        fields.has_status(status, predicates.STATUS_ACTIVE).alias("active"),
    )


@query(
    "variable_rows",
    """SELECT EmpCode, HeadCode, Amount, UpdatedDate FROM emp_variable WHERE UpdatedDate IS NOT NULL AND Amount <> 0
    AND UpdatedDate >= TIMESTAMP '1998-01-01 00:00:00'""",
)
def variable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variable.variable_rows(hr_tables(spark, sf_dir)["emp_variable"], VARIABLE_MARK, VARIABLE_AS_OF)
    return rows.select("EmpCode", "HeadCode", "Amount", "UpdatedDate")


@query(
    "variable_distinct",
    "SELECT DISTINCT EmpCode, HeadCode, CreatedDate, Amount <> 0 AS counts FROM emp_variable",
)
def variable_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["emp_variable"]
    return rows.select("EmpCode", "HeadCode", "CreatedDate", (F.col("Amount") != 0).alias("counts")).distinct()


def signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a signed-up organisation."""
    return read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("organizationName"), (F.lit(101) + F.col("c_nationkey") % 3).alias("CountryID")
    )


@query(
    "country_lookup",
    """SELECT ED_EMPID, ED_EMPCode, ED_CountryID FROM employee_details WHERE ED_CountryID =
    (SELECT 101 + c_nationkey % 3 FROM customer WHERE c_name = 'Customer#000000002')""",
)
def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    organisation = predicates.organisation_of("HR_Customer#000000002", "HR_")
    country = predicates.country_of(signups(spark, sf_dir), organisation)
    staff = hr_tables(spark, sf_dir)["employee_details"].where(F.col("ED_CountryID") == country)
    return staff.select("ED_EMPID", "ED_EMPCode", "ED_CountryID")


def timed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as batches per user and day, with some missing and some unreadable times."""
    time = (
        F.when(F.col("event_id") % 997 == 0, "not a time")
        .when(F.col("event_id") % 5 != 0, None)
        .otherwise(F.col("ts").cast("string"))
    )
    return read(spark, sf_dir, "events").select(
        emp_code(F.col("user_id")).alias("EmpCode"), F.col("ts").cast("date").alias("Date"), time.alias("time")
    )


_BATCH_TIMES = """SELECT 'E' || CAST(user_id AS VARCHAR) AS EmpCode, CAST(ts AS DATE) AS "Date", count(*) AS batch_size,
    CASE WHEN bool_or(event_id % 997 = 0) THEN NULL ELSE max(CASE WHEN event_id % 5 = 0 THEN ts END) END AS max_timestamp
    FROM events GROUP BY 1, 2"""


@query(
    "batch_max_time",
    f"""SELECT EmpCode, "Date", batch_size, coalesce(max_timestamp, TIMESTAMP '2024-01-31 00:00:00') AS max_timestamp
    FROM ({_BATCH_TIMES}) b""",
)
def batch_max_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.batch_max_time(
        timed_rows(spark, sf_dir), ["EmpCode", "Date"], "time", now=dt.datetime(2024, 1, 31)
    )


@query("reject_undated", f"""SELECT EmpCode, "Date", batch_size FROM ({_BATCH_TIMES}) b WHERE max_timestamp IS NULL""")
def reject_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = predicates.batch_max_time(timed_rows(spark, sf_dir), ["EmpCode", "Date"], "time")
    _, rejected = predicates.split_dated(batches)
    return rejected.select("EmpCode", "Date", "batch_size")


# ---- column rules --------------------------------------------------------------


@query(
    "attendance_value",
    """SELECT EmpCode, UpdatedDate, CASE WHEN AttValue1 = -1 OR AttValue1 IS NULL THEN 0 ELSE AttValue1 END AS attendance
    FROM rostering""",
)
def attendance_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["rostering"]
    return rows.select("EmpCode", "UpdatedDate", fields.attendance_value(F.col("AttValue1")).alias("attendance"))


@query(
    "gender_code",
    """SELECT ED_EMPID, CASE lower(ED_Sex) WHEN 'male' THEN 1 WHEN 'female' THEN 2 ELSE 3 END AS gender
    FROM employee_details""",
)
def gender_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = hr_tables(spark, sf_dir)["employee_details"]
    return staff.select("ED_EMPID", fields.gender_code(F.col("ED_Sex")).alias("gender"))


@query(
    "date_floor",
    """SELECT ED_EMPID, greatest(ED_DOJ, DATE '2025-01-01') AS onboarding_date, greatest(ED_DOJ, DATE '2024-01-01') AS revision_date
    FROM employee_details""",
)
def date_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.col("ED_DOJ")
    return hr_tables(spark, sf_dir)["employee_details"].select(
        "ED_EMPID",
        fields.date_floor(joined, fields.ONBOARDING_FLOOR).alias("onboarding_date"),
        fields.date_floor(joined, fields.year_start_floor(dt.datetime(2025, 6, 1))).alias("revision_date"),
    )


@query(
    "effective_date",
    """SELECT EmpCode, HeadCode, CAST(coalesce(EffDate, FromDate) AS DATE) AS india, CAST(FromDate AS DATE) AS philippines,
    CASE WHEN EffDate IS NOT NULL THEN CAST(FromDate AS DATE) END AS thailand FROM salary_master""",
)
def effective_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hr_tables(spark, sf_dir)["salary_master"]
    return rows.select(
        "EmpCode",
        "HeadCode",
        *[
            fields.effective_date(c.upper(), F.col("EffDate"), F.col("FromDate")).alias(c)
            for c in ("india", "philippines", "thailand")
        ],
    )


@query(
    "signed_amount",
    """SELECT v.EmpCode, v.HeadCode, v.CreatedDate, CASE WHEN p.PayHeadCategoryID = 2 THEN 0 - v.Amount ELSE v.Amount END AS amount
    FROM emp_variable v JOIN payhead_master p ON v.HeadCode = p.PayHeadCode""",
)
def signed_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    heads = t["payhead_master"].select(F.col("PayHeadCode").alias("HeadCode"), "PayHeadCategoryID")
    rows = t["emp_variable"].join(heads, "HeadCode")
    amount = fields.signed_amount(F.col("PayHeadCategoryID"), F.col("Amount")).alias("amount")
    return rows.select("EmpCode", "HeadCode", "CreatedDate", amount)


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overtime.explode_params(hr_tables(spark, sf_dir)["rostering"], ("EmpCode", "Date", "OT_UpdatedDate"))


@query("explode_params", "SELECT * FROM roster_params")
def explode_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _params(spark, sf_dir)


@query(
    "overtime_hours",
    """SELECT EmpCode, OT_UpdatedDate, Code, round(CAST(Minutes AS DOUBLE) / 60.0, 2) AS hours FROM roster_params""",
)
def overtime_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = fields.overtime_hours(fields.minutes_value(F.col("Minutes"))).alias("hours")
    return _params(spark, sf_dir).select("EmpCode", "OT_UpdatedDate", "Code", hours)


@query(
    "unit_code",
    """SELECT EmpCode, OT_UpdatedDate, Code, CASE WHEN Conversion = 'Hours' THEN 'H' ELSE Conversion END AS unit
    FROM roster_params""",
)
def unit_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _params(spark, sf_dir).select(
        "EmpCode", "OT_UpdatedDate", "Code", fields.unit_code(F.col("Conversion")).alias("unit")
    )


# ---- scalar functions ------------------------------------------------------------


@query(
    "split_list",
    """SELECT o_orderkey, trim(i.item) AS item FROM orders,
    unnest(string_split(o_orderpriority || '| ' || o_orderstatus || ' ||' || CAST(o_custkey AS VARCHAR), '|')) AS i(item)
    WHERE trim(i.item) <> ''""",
)
def split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.col("o_orderpriority"), F.lit("| "), F.col("o_orderstatus"), F.lit(" ||"), F.col("o_custkey").cast("string")
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", F.explode(fields.split_list(text)).alias("item"))


@query(
    "proper_case",
    """SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) || ',' || upper(p_brand[1]) || lower(p_brand[2:]) AS names
    FROM part""",
)
def proper_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(",", F.upper("p_type"), F.lower("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", fields.proper_case(text).alias("names"))


@query(
    "iso_text",
    """SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN t = date_trunc('second', t) THEN ''
    ELSE strftime(t, '.%f') END AS moment, CAST(CAST(t AS DATE) AS VARCHAR) AS day, CAST(CAST(value AS DECIMAL(18, 4)) AS DOUBLE) AS amount
    FROM (SELECT event_id, value, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) WHEN event_id % 3 = 1
    THEN date_trunc('millisecond', ts) ELSE ts END AS t FROM events) e""",
)
def iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, ts = F.col("event_id"), F.col("ts")
    moment = (
        F.when(k % 3 == 0, F.date_trunc("second", ts).cast("timestamp_ntz"))
        .when(k % 3 == 1, F.date_trunc("millisecond", ts).cast("timestamp_ntz"))
        .otherwise(ts)
    )
    rows = read(spark, sf_dir, "events").select(
        "event_id",
        moment.alias("moment"),
        ts.cast("date").alias("day"),
        F.col("value").cast("decimal(18,4)").alias("amount"),
    )
    return iso_records(rows, ["moment", "day", "amount"])


_WORDS = """CASE l_orderkey % 7 WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN ' ' || CAST(l_partkey AS VARCHAR) || ' '
    WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN '-' || CAST(l_suppkey AS VARCHAR) ELSE '1_0' || CAST(l_linenumber AS VARCHAR) END"""


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are whole numbers, fractions, padded, signed, grouped, empty, or words."""
    k = F.col("l_orderkey") % 7
    word = (
        F.when(k == 0, F.col("l_quantity").cast("string"))
        .when(k == 1, F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")))
        .when(k == 2, "abc")
        .when(k == 3, "")
        .when(k == 4, None)
        .when(k == 5, F.concat(F.lit("-"), F.col("l_suppkey").cast("string")))
        .otherwise(F.concat(F.lit("1_0"), F.col("l_linenumber").cast("string")))
    )
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", word.alias("word"))


@query(
    "to_int",
    f"""SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS BIGINT) AS whole_price,
    CASE WHEN regexp_full_match(trim(word), '[+-]?[0-9]+(_[0-9]+)*') THEN CAST(replace(trim(word), '_', '') AS BIGINT) ELSE 1 END AS whole_word
    FROM (SELECT *, {_WORDS} AS word FROM lineitem) w""",
)
def to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        fields.to_int(F.col("l_extendedprice"), text=False).alias("whole_price"),
        fields.to_int(F.col("word"), 1, text=True).alias("whole_word"),
    )


@query(
    "to_float",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN regexp_full_match(trim(word), '[+-]?[0-9]+(_[0-9]+)*([.][0-9]*)?')
    THEN CAST(replace(trim(word), '_', '') AS DOUBLE) ELSE 0.0 END AS number
    FROM (SELECT *, {_WORDS} AS word FROM lineitem) w""",
)
def to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("l_orderkey", "l_linenumber", fields.to_float(F.col("word"), text=True).alias("number"))


@query(
    "ymd10",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
    CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS closed_day FROM orders""",
)
def ymd10(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    closed = F.when(F.col("o_orderstatus") == "P", None).otherwise(day)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fields.ymd10(day, "timestamp_ntz").alias("order_day"),
        fields.ymd10(closed, "timestamp_ntz").alias("closed_day"),
    )


@query(
    "ymd",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_from_text FROM orders""",
)
def ymd(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("string")).otherwise("soon")
    closed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", fields.ymd(closed).alias("day"), fields.ymd(text).alias("day_from_text")
    )


@query(
    "round_money",
    """SELECT l_orderkey, l_linenumber, CAST(format('{:.2f}', l_quantity * 0.125) AS DOUBLE) AS eighths,
    CAST(format('{:.2f}', l_extendedprice * l_tax) AS DOUBLE) AS tax, CAST(format('{:.2f}', 0 - (l_quantity + 2.675)) AS DOUBLE) AS shifted
    FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax FROM lineitem) l""",
)
def round_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fields.round_money(F.col("l_quantity") * 0.125).alias("eighths"),
        fields.round_money(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
        fields.round_money(F.lit(0) - (F.col("l_quantity") + 2.675)).alias("shifted"),
    )


@query(
    "empty_feed",
    """SELECT EmployeeCode, "Date", Code, ExtraHrs, Conversion, ExtraTimePay, updateDate_timestamp FROM overtime_rows
    WHERE updateDate_timestamp > TIMESTAMP '2099-01-01 00:00:00'""",
)
def empty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing changed: no rows, but the feed's own columns."""
    return overtime.overtime_feed(hr_tables(spark, sf_dir), dt.datetime(2099, 1, 1), SALARY_AS_OF)

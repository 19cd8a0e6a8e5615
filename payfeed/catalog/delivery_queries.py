"""Sources, batches, envelopes, outcomes, marks, and the increment itself."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType

from payfeed.catalog.feed_queries import feed_attendance, feed_onboarding_in, feed_onboarding_ph, feed_overtime
from payfeed.catalog.registry import ROSTER_AS_OF, ROSTER_MARK, SALARY_AS_OF, SALARY_MARK, query
from payfeed.catalog.star_schema import PROPERTY_CODES, emp_code, hr_tables, read, rostering
from payfeed.functions.fields import ntz
from payfeed.operators.batching import batch_keys, batch_rows, envelopes, iso_records
from payfeed.operators.predicates import current_salary
from payfeed.plans import attendance
from payfeed.plans.consume import consume
from payfeed.plans.increment import FEEDS, run_increment, write_batches
from payfeed.plans.overtime import overtime_rejects
from payfeed.session import materialize, run_path
from payfeed.sources.delivery import append_log, apply_outcomes, batch_log
from payfeed.sources.marks import commit_marks, latest_mark, next_mark, stored_marks
from payfeed.sources.outbox import decode_envelopes, envelope_message, new_batches
from payfeed.sources.tables import fan_in, route
from payfeed.streaming.keyed import Watch, keyed, stream_changes
from payfeed.streaming.stream import arriving
from payfeed.streaming.stream import stream_increment as run_stream


@query(
    "fan_in",
    """SELECT EmpCode, HeadCode, Amount, CreatedDate, CAST(NULL AS DOUBLE) AS "MonthlyRate", 'variable' AS source_db FROM emp_variable
    UNION ALL
    SELECT EmpCode, HeadCode, NULL, NULL, MonthlyRate, 'salary' FROM salary_master WHERE ToDate IS NULL AND MonthlyRate <> 0""",
)
def fan_in_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    return fan_in(
        {
            "variable": t["emp_variable"].select("EmpCode", "HeadCode", "Amount", "CreatedDate"),
            "salary": current_salary(t["salary_master"]).select("EmpCode", "HeadCode", "MonthlyRate"),
        }
    )


# ---- marks and outcomes derived from orders --------------------------------------

_SOURCE = "'S' || CAST(o_custkey % 97 AS VARCHAR)"


def mark_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a mark that its customer's source once had; some are still empty."""
    moment = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("ID"),
        moment.alias("last_timestamp"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 97).cast("string")).alias("source_db"),
    )


_MARKS = f"""SELECT CAST(o_orderkey AS INT) AS ID, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS last_timestamp,
    {_SOURCE} AS source_db FROM orders"""


@query(
    "latest_mark",
    f"""SELECT source_db, last_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY source_db ORDER BY ID DESC) AS n
    FROM ({_MARKS}) m) r WHERE n = 1""",
)
def latest_mark_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_mark(mark_history(spark, sf_dir))


@query("latest_mark_global", f"SELECT last_timestamp FROM ({_MARKS}) m ORDER BY ID DESC LIMIT 1")
def latest_mark_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_mark(mark_history(spark, sf_dir), per_source=False)


def order_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a delivered batch of its customer's source; a few late ones failed."""
    day = F.col("o_orderdate")
    failed = (F.col("o_orderkey") % 31 == 0) & (day >= ntz(dt.datetime(2000, 1, 1)))
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 97).cast("string")).alias("source_db"),
        F.col("o_orderkey").alias("batch_no"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        (day - F.expr("INTERVAL 3 DAYS")).alias("min_timestamp"),
        day.alias("max_timestamp"),
    )


_OUTCOMES = f"""SELECT {_SOURCE} AS source_db, o_orderkey AS batch_no,
    CASE WHEN o_orderkey % 31 = 0 AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    o_orderdate - INTERVAL 3 DAY AS min_timestamp, o_orderdate AS max_timestamp FROM orders"""


def old_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark per source: empty, early, or already past everything."""
    number = F.col("o_custkey") % 97
    marks = read(spark, sf_dir, "orders").select(number.cast("int").alias("n")).distinct()
    moment = F.when(F.col("n") % 3 == 1, ntz(dt.datetime(1999, 6, 1))).when(
        F.col("n") % 3 == 2, ntz(dt.datetime(2001, 12, 31))
    )
    return marks.select(
        (F.col("n") + 1).alias("ID"),
        moment.alias("last_timestamp"),
        F.concat(F.lit("S"), F.col("n").cast("string")).alias("source_db"),
    )


_OLD = """SELECT n + 1 AS ID, CASE n % 3 WHEN 1 THEN TIMESTAMP '1999-06-01 00:00:00' WHEN 2 THEN TIMESTAMP '2001-12-31 00:00:00' END
    AS last_timestamp, 'S' || CAST(n AS VARCHAR) AS source_db FROM (SELECT DISTINCT CAST(o_custkey % 97 AS INT) AS n FROM orders) d"""


@query(
    "advance_mark",
    f"""WITH outcomes AS ({_OUTCOMES}), old AS ({_OLD}), ok AS (
        SELECT source_db, max_timestamp, row_number() OVER (PARTITION BY source_db ORDER BY batch_no DESC) AS n
        FROM outcomes WHERE status = 'SUCCESS'), fresh AS (
        SELECT s.source_db, coalesce(ok.max_timestamp + INTERVAL 1 MICROSECOND, old.last_timestamp) AS last_timestamp
        FROM (SELECT DISTINCT source_db FROM outcomes) s LEFT JOIN ok ON ok.source_db = s.source_db AND ok.n = 1
        LEFT JOIN old ON old.source_db = s.source_db),
        moved AS (SELECT fresh.* FROM fresh LEFT JOIN old USING (source_db) WHERE fresh.last_timestamp IS DISTINCT FROM old.last_timestamp)
    SELECT CAST((SELECT max(ID) FROM old) + row_number() OVER (ORDER BY source_db) AS INT) AS "ID", last_timestamp, source_db FROM moved""",
)
def advance_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = old_marks(spark, sf_dir)
    new = materialize(next_mark(order_outcomes(spark, sf_dir), marks, policy="last_success", bump=True), "new")
    path = run_path(spark, "marks")
    commit_marks(marks, path)
    for _ in range(2):  # a repeated commit adds nothing
        commit_marks(new, path, forward=False)
    top = stored_marks(spark, path, 1).agg(F.max("ID")).first()[0]
    return stored_marks(spark, path).where(F.col("ID") > top).select("ID", "last_timestamp", "source_db")


@query(
    "mark_safe",
    f"""WITH outcomes AS ({_OUTCOMES}), old AS ({_OLD}), s AS (
        SELECT source_db, max(CASE WHEN status = 'SUCCESS' THEN max_timestamp END) AS newest,
        min(CASE WHEN status <> 'SUCCESS' THEN min_timestamp END) AS first_open FROM outcomes GROUP BY source_db)
    SELECT s.source_db, CASE WHEN s.newest IS NULL THEN old.last_timestamp ELSE greatest(old.last_timestamp,
    least(s.newest, s.first_open - INTERVAL 1 MICROSECOND)) END AS last_timestamp
    FROM s LEFT JOIN old ON old.source_db = s.source_db""",
)
def mark_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_mark(order_outcomes(spark, sf_dir), old_marks(spark, sf_dir))


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        k.cast("string").alias("batch_id"),
        (F.lit(1) + k % 250).alias("batch_size"),
        F.when(k % 101 == 0, "unreadable monthly_rate").alias("error"),
        F.concat(F.lit('{"key":'), k.cast("string"), F.lit("}")).alias("payload"),
    )


def order_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery results: mostly fine, some refused with a long answer, some lost, some open."""
    k = F.col("o_orderkey")
    code = F.when(k % 7 == 0, 500).when(k % 11 == 0, 0).otherwise(200)
    return read(spark, sf_dir, "orders").where(k % 13 != 0).select(
        k.cast("string").alias("batch_id"),
        code.alias("status_code"),
        F.repeat("o_orderpriority", 200).alias("response"),
    )


_STATUS = """CASE WHEN o_orderkey % 101 = 0 THEN 'ERROR' WHEN o_orderkey % 13 = 0 THEN 'PENDING'
    WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'FAILED' ELSE 'SUCCESS' END"""


@query(
    "apply_outcomes",
    f"""SELECT batch_id, batch_size, status, CASE status WHEN 'ERROR' THEN 'unreadable monthly_rate' WHEN 'SUCCESS' THEN ''
    WHEN 'FAILED' THEN repeat(o_orderpriority, 200) END AS details, status = 'SUCCESS' AS is_complete
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, 1 + o_orderkey % 250 AS batch_size, o_orderpriority, {_STATUS} AS status
    FROM orders) o""",
)
def outcomes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = apply_outcomes(order_envelopes(spark, sf_dir), order_results(spark, sf_dir), "onboarding")
    return outcomes.select("batch_id", "batch_size", "status", "details", "is_complete")


@query(
    "batch_log",
    f"""WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, CAST(1 + o_orderkey % 250 AS INT) AS size, o_orderpriority,
        {_STATUS} AS status, '{{"key":' || CAST(o_orderkey AS VARCHAR) || '}}' AS payload FROM orders)
    SELECT batch_id, TIMESTAMP '2001-08-02 00:00:00' AS "Timestamp", size AS "BatchSize", status AS "Status",
    CASE status WHEN 'ERROR' THEN 'unreadable monthly_rate' WHEN 'SUCCESS' THEN '' ELSE repeat(o_orderpriority, 200)[:1000] END AS "Details",
    status = 'SUCCESS' AS "IsBatchComplete", payload AS "Payload", 'onboarding' AS feed FROM o WHERE status <> 'PENDING'
    UNION ALL
    SELECT batch_id, TIMESTAMP '2001-08-02 00:00:00', size, status,
    CASE status WHEN 'ERROR' THEN 'unreadable monthly_rate' ELSE repeat(o_orderpriority, 200)[:1000] END,
    status = 'FAILED', CASE WHEN status = 'FAILED' THEN payload ELSE '0' END, 'attendance' FROM o WHERE status <> 'PENDING'""",
)
def batch_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, results = order_envelopes(spark, sf_dir), order_results(spark, sf_dir)
    path = run_path(spark, "log")
    for feed in ("onboarding", "attendance", "attendance"):  # a repeated call adds nothing
        log = batch_log(apply_outcomes(sent, results, feed), dt.datetime(2001, 8, 2), feed)
        append_log(log, f"{path}/{feed}")
    logs = [spark.read.parquet(f"{path}/{feed}").drop("day").withColumn("feed", F.lit(feed)) for feed in ("onboarding", "attendance")]
    return logs[0].unionByName(logs[1])


@query(
    "replay_dedupe",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS batch_id, 1 + o_orderkey % 250 AS batch_size FROM orders
    WHERE {_STATUS} <> 'SUCCESS'""",
)
def replay_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches offered again: only those not delivered remain."""
    sent = order_envelopes(spark, sf_dir)
    outcomes = apply_outcomes(sent, order_results(spark, sf_dir), "onboarding")
    path = run_path(spark, "log")
    append_log(batch_log(outcomes, dt.datetime(2001, 8, 2), "onboarding"), path)
    log = spark.read.parquet(path)
    return new_batches(sent, log, dt.datetime(2001, 8, 1)).select("batch_id", "batch_size")


@query(
    "route",
    """SELECT c_custkey, c_mktsegment AS subscription_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
    WHEN c_mktsegment < 'C' THEN 'INDIA' ELSE 'PHILIPPINES' END AS source_country,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'no source configured for MACHINERY' END AS route_error FROM customer""",
)
def route_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    customers = read(spark, sf_dir, "customer")
    sources = customers.where(segment != "MACHINERY").select(
        F.concat(F.lit("db-"), segment).alias("name"),
        segment.alias("subscription_name"),
        F.when(segment < "C", "INDIA").otherwise("PHILIPPINES").alias("country"),
    ).distinct()
    sent = customers.select("c_custkey", segment.alias("subscription_name"))
    return route(sent, sources).select("c_custkey", "subscription_name", "source_country", "route_error")


# ---- batches and envelopes ---------------------------------------------------------

_ROW_BATCHES = """SELECT *, (row_number() OVER (ORDER BY EmployeeID NULLS FIRST, AttendanceDate, updateDate_timestamp, Attendance) - 1) // 250
    AS batch_no FROM attendance_rows"""


@query("batch_rows", f"SELECT EmployeeID, updateDate_timestamp, batch_no FROM ({_ROW_BATCHES}) b")
def row_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batch_rows(feed_attendance(spark, sf_dir), 250, list(attendance.ORDER))
    return batched.select("EmployeeID", "updateDate_timestamp", "batch_no")


_KEY_BATCHES = "SELECT *, (dense_rank() OVER (ORDER BY EmployeeCode) - 1) // 100 AS batch_no FROM overtime_rows"


@query("batch_employees", f"SELECT EmployeeCode, Code, updateDate_timestamp, batch_no FROM ({_KEY_BATCHES}) b")
def employee_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batch_keys(feed_overtime(spark, sf_dir), "EmployeeCode", 100)
    return batched.select("EmployeeCode", "Code", "updateDate_timestamp", "batch_no")


@query(
    "envelopes",
    f"""SELECT batch_no, count(*) AS batch_size, min(updateDate_timestamp) AS min_timestamp, max(updateDate_timestamp) AS max_timestamp,
    string_agg(EmployeeCode, ',' ORDER BY EmployeeID, AttendanceDate, updateDate_timestamp, Attendance) AS employees
    FROM ({_ROW_BATCHES}) b GROUP BY batch_no""",
)
def folded_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batch_rows(feed_attendance(spark, sf_dir), 250, list(attendance.ORDER))
    folded = envelopes(batched, ["EmployeeCode"], ["batch_no"], ["row_index"], "updateDate_timestamp")
    employees = F.array_join(F.transform("records", lambda r: r["EmployeeCode"]), ",")
    return folded.select("batch_no", "batch_size", "min_timestamp", "max_timestamp", employees.alias("employees"))


RECORD = StructType(
    [
        StructField("EmployeeID", LongType()),
        StructField("EmployeeCode", StringType()),
        StructField("AttendanceDate", StringType()),
        StructField("Attendance", DoubleType()),
        StructField("updateDate_timestamp", StringType()),
    ]
)


@query(
    "decode_envelopes",
    f"""SELECT EmployeeID, EmployeeCode, CAST(AttendanceDate AS VARCHAR) AS "AttendanceDate", Attendance,
    strftime(updateDate_timestamp, '%Y-%m-%dT%H:%M:%S') || CASE WHEN updateDate_timestamp = date_trunc('second', updateDate_timestamp)
    THEN '' ELSE strftime(updateDate_timestamp, '.%f') END AS "updateDate_timestamp", 'sub-1' AS subscription_name,
    max(updateDate_timestamp) OVER (PARTITION BY batch_no) AS max_timestamp FROM ({_ROW_BATCHES}) b""",
)
def decoded_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance batches as JSON messages, read back into rows."""
    columns = RECORD.fieldNames()
    batched = batch_rows(feed_attendance(spark, sf_dir), 250, list(attendance.ORDER))
    timed = batched.withColumn("_time", F.col("updateDate_timestamp"))
    folded = envelopes(iso_records(timed, columns), columns, ["batch_no"], ["row_index"], "_time")
    messages = (
        folded.withColumn("source_db", F.lit("db-1"))
        .withColumn("subscription_name", F.lit("sub-1"))
        .select(envelope_message().alias("message"))
    )
    return decode_envelopes(messages, RECORD).drop("position")


@query(
    "outbox",
    f"""SELECT 'db-1' AS source_db, batch_no, count(*) AS batch_size, max(updateDate_timestamp) AS max_timestamp
    FROM ({_KEY_BATCHES}) b GROUP BY batch_no""",
)
def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overtime batches written to an outbox and read back."""
    rows = materialize(feed_overtime(spark, sf_dir).withColumn("source_db", F.lit("db-1")), "rows")
    path = run_path(spark, "outbox")
    write_batches(rows, FEEDS["overtime"], {"db-1": "sub-1"}, ROSTER_AS_OF, path)
    return spark.read.parquet(f"{path}/batches").select("source_db", "batch_no", "batch_size", "max_timestamp")


def roster_marks(spark: SparkSession) -> DataFrame:
    """One source that was delivered up to the mark, and one that never was."""
    rows = [(1, ROSTER_MARK, "east"), (2, None, "west")]
    return spark.createDataFrame(rows, "ID int, last_timestamp timestamp_ntz, source_db string")


@query(
    "increment",
    """WITH rows AS (
        SELECT 'east' AS source_db, EmployeeID, AttendanceDate, updateDate_timestamp, Attendance FROM attendance_rows
        UNION ALL
        SELECT 'west', d.ED_EMPID, r."Date", r.UpdatedDate, CASE WHEN r.AttValue1 = -1 OR r.AttValue1 IS NULL THEN 0 ELSE r.AttValue1 END
        FROM rostering r JOIN employee_details d ON r.EmpCode = d.ED_EMPCode
        WHERE r."Date" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 90 DAY)
    SELECT source_db, batch_no, count(*) AS batch_size, min(updateDate_timestamp) AS min_timestamp,
    max(updateDate_timestamp) AS max_timestamp, 'sub-' || source_db AS subscription_name
    FROM (SELECT *, (row_number() OVER (PARTITION BY source_db
        ORDER BY EmployeeID, AttendanceDate, updateDate_timestamp, Attendance) - 1) // 250 AS batch_no FROM rows) b
    GROUP BY source_db, batch_no""",
)
def increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance of two sources, one after its mark and one for the first time."""
    t = hr_tables(spark, sf_dir)
    sent = run_increment(
        FEEDS["attendance"],
        {"east": t, "west": t},
        {"east": "sub-east", "west": "sub-west"},
        roster_marks(spark),
        ROSTER_AS_OF,
        run_path(spark, "increment"),
    )
    return sent.select(
        "source_db", "batch_no", "batch_size", "min_timestamp", "max_timestamp", "subscription_name"
    )


@query(
    "stream_increment",
    """SELECT d.ED_EMPID AS "EmployeeID", r.EmpCode AS "EmployeeCode", count(*) AS n, CAST(max(r."Date") AS VARCHAR) AS newest
    FROM rostering r JOIN employee_details d ON r.EmpCode = d.ED_EMPCode GROUP BY 1, 2""",
)
def stream_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance batches of arriving event files; what was sent, summed up per employee."""
    t = hr_tables(spark, sf_dir)
    path = run_path(spark, "stream")

    run_stream(
        spark,
        arriving(FEEDS["attendance"], t, "rostering", "db-1", "sub-1", adapt=rostering, now=lambda: ROSTER_AS_OF),
        sf_dir,
        read(spark, sf_dir, "events").schema,
        f"{path}/outbox",
        f"{path}/checkpoint",
        glob="events.parquet",
    )
    sent = F.from_json("record", "EmployeeID bigint, EmployeeCode string, AttendanceDate string")
    return (
        spark.read.parquet(f"{path}/outbox/records")
        .select(sent.alias("r"))
        .groupBy("r.EmployeeID", "r.EmployeeCode")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("r.AttendanceDate").cast("date")).cast("string").alias("newest"))
    )


def _pay_arrives(spark: SparkSession, sf_dir: str) -> Watch:
    """Salary rows newer than the mark, which arrive as order lines."""
    owners = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    newer = lambda lines: lines.where(F.col("l_shipdate") > ntz(SALARY_MARK)).join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    return Watch("salary_master", sf_dir, read(spark, sf_dir, "lineitem").schema, emp_code(F.col("o_custkey")), prepare=newer, glob="lineitem.parquet")


def _streamed(spark: SparkSession, sf_dir: str, feed: str, watches: list[Watch], **options) -> DataFrame:
    """What a stream over the watched tables sends, summed up per employee."""
    path = run_path(spark, "stream")
    shape = keyed(FEEDS[feed], lambda: hr_tables(spark, sf_dir), "db-1", "sub-1", now=lambda: SALARY_AS_OF, **options)
    stream_changes(spark, watches, shape, f"{path}/outbox", f"{path}/checkpoint")
    value = lambda name: F.get_json_object("record", f"$.{name}")
    sent = spark.read.parquet(f"{path}/outbox/records").groupBy(value("employee_code").alias("employee_code"))
    return sent.agg(F.count(F.lit(1)).alias("n"), F.max(value("monthly_rate").cast("double")).alias("monthly"))


@query(
    "stream_onboarding_in",
    "SELECT EmployeeCode AS employee_code, count(*) AS n, max(coalesce(MonthlyAmount, 0.0)) AS monthly FROM onboarding_india_all GROUP BY 1",
)
def stream_onboarding_india(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New pay and new employees arrive side by side: all pay of whoever is named in either."""
    new = Watch("employee_details", sf_dir, read(spark, sf_dir, "customer").schema, emp_code(F.col("c_custkey")), glob="customer.parquet")
    return _streamed(spark, sf_dir, "onboarding_india", [_pay_arrives(spark, sf_dir), new])


@query(
    "stream_onboarding_ph",
    "SELECT EmployeeCode AS employee_code, count(*) AS n, max(coalesce(MonthlyRate, 0.0)) AS monthly FROM onboarding_philippines_rows GROUP BY 1",
)
def stream_onboarding_philippines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New pay arrives: all pay of its employees, as the batch run sends it."""
    return _streamed(spark, sf_dir, "onboarding_philippines", [_pay_arrives(spark, sf_dir)], codes=list(PROPERTY_CODES))


@query(
    "overtime_rejects",
    """SELECT EmpCode, "Date", OT_UpdatedDate, CASE WHEN second(OT_UpdatedDate) % 17 = 0 THEN 'not a JSON list of parameters'
    ELSE 'minutes are not a number' END AS reason FROM rostering WHERE OT_Param_json IS NOT NULL
    AND (second(OT_UpdatedDate) % 17 = 0 OR second(OT_UpdatedDate) % 19 = 0)""",
)
def unreadable_overtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster rows with broken parameter lists and with minutes that are no number."""
    second = F.second("OT_UpdatedDate")
    broken = F.when(second % 17 == 0, F.lit("[{")).when(
        second % 19 == 0, F.lit('[{"ParameterCode":"click","ParameterValue":"some","Conversion":"H"}]')
    )
    roster = hr_tables(spark, sf_dir)["rostering"]
    text = F.when(F.col("OT_Param_json").isNotNull(), F.coalesce(broken, F.col("OT_Param_json")))
    found = overtime_rejects(roster.withColumn("OT_Param_json", text))
    return found.select("EmpCode", "Date", "OT_UpdatedDate", "reason")


def _as_json(dtype: str) -> str:
    """The Spark type that a feed column has in a message."""
    return "string" if dtype == "date" or dtype.startswith("timestamp") else "double" if dtype.startswith("decimal") else dtype


@query(
    "consume_onboarding",
    """SELECT 'INDIA' AS country, EmployeeCode AS employee_code, count(*) AS n, max(coalesce(MonthlyAmount, 0.0)) AS monthly,
    CAST(NULL AS VARCHAR) AS error FROM onboarding_india_rows GROUP BY EmployeeCode
    UNION ALL
    SELECT 'PHILIPPINES', EmployeeCode, count(*), max(coalesce(MonthlyRate, 0.0)), NULL
    FROM onboarding_philippines_rows GROUP BY EmployeeCode
    UNION ALL
    SELECT NULL, NULL, 1, NULL, e.error FROM (SELECT count(*) FROM customer) c,
    (VALUES ('no source configured for nobody'), ('unsupported country: null')) AS e(error)""",
)
def consume_onboarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of an Indian and a Philippine source, of no source, and of a source without country, in one call."""
    feeds = {"INDIA": feed_onboarding_in(spark, sf_dir), "PHILIPPINES": feed_onboarding_ph(spark, sf_dir)}
    schemas, sent = {}, []
    for country, rows in feeds.items():
        schemas[country] = StructType([StructField(c, DataType.fromDDL(_as_json(t))) for c, t in rows.dtypes])
        folded = envelopes(iso_records(rows, rows.columns).withColumn("_key", F.col("EmployeeCode")), rows.columns, ["_key"], ["PayHeadCategoryID", "EmployeeID"])
        named = folded.withColumn("source_db", F.lit("db")).withColumn("subscription_name", F.lit(f"sub-{country}"))
        sent.append(named.select(F.concat_ws("-", F.lit(country), "_key").alias("message_id"), envelope_message(("subscription_name",)).alias("message")))
    strays = F.explode(F.array(F.lit("nobody"), F.lit("nowhere")))
    stray = read(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n")).select(strays.alias("message_id"))
    stray = stray.withColumn("message", F.format_string('{"records":[{}],"subscription_name":"%s"}', "message_id"))
    known = [(c.lower(), f"sub-{c}", c) for c in feeds] + [("db", "nowhere", None)]
    sources = spark.createDataFrame(known, "name string, subscription_name string, country string")
    got = consume(sent[0].unionByName(sent[1]).unionByName(stray), "onboarding", sources, schemas, ROSTER_AS_OF)
    return got.groupBy("country", F.get_json_object("record", "$.employee_code").alias("employee_code"), "error").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.get_json_object("record", "$.monthly_rate").cast("double")).alias("monthly"),
    )

"""HR tables derived from the star-schema test tables.

Each function is the DataFrame counterpart of one adapter view in FIXTURES.md; the
oracle SQL states the same views on its own. Small configuration lists are numbered
through sorted arrays, so nothing needs a global window or a cross join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payfeed.functions.fields import OPEN_END, ntz
from payfeed.operators.attributes import MODULE

# Countries and property codes of the derived configuration.
COUNTRIES = (101, 103)
PROPERTY_CODES = ("SSSEMPLOYEE", "PHILHEALTHEMPLOYEE", "OTAPPLICABLE")


# Columns of the star-schema tables (see FIXTURES.md); stating them saves
# a job per table that would only read the file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def emp_code(key: Column) -> Column:
    return F.concat(F.lit("E"), key.cast("string"))


def employee_details(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("ED_EMPID"),
        emp_code(k).alias("ED_EMPCode"),
        (F.lit(101) + F.col("c_nationkey") % 3).alias("ED_CountryID"),
        F.when(k % 4 == 0, None).otherwise(F.lit("Mx")).alias("ED_Salutation"),
        F.col("c_name").alias("ED_FirstName"),
        F.lit(None).cast("string").alias("ED_MiddleName"),
        F.col("c_mktsegment").alias("ED_LastName"),
        F.date_add(F.lit(dt.date(1970, 1, 1)), (k % 9000).cast("int")).alias("ED_DOB"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (k % 1500).cast("int")).alias("ED_DOJ"),
        F.when(k % 3 == 0, "Male").when(k % 3 == 1, "FEMALE").alias("ED_Sex"),
        F.when(k % 5 == 0, 1).when(k % 5 == 1, 10).when(k % 5 == 2, 5).when(k % 5 == 3, 6).otherwise(2).alias("ED_Status"),
        F.lit(None).cast("date").alias("ED_DOL"),
    )


def employee_fin_details(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("EFD_ED_EMPID"),
        F.col("c_nationkey").alias("EFD_StateId"),
        (k % 2).cast("int").alias("EFD_PFApplicable"),
        ((k % 3).cast("int") % 2).alias("EFD_ESICApplicable"),
        F.when(k % 7 == 0, None).otherwise(1).alias("EFD_PTApplicable"),
        ((k + 1) % 2).cast("int").alias("EFD_LwfApplicable"),
        F.when(k % 5 == 0, None).otherwise(0).alias("EFD_VPFApplicable"),
    )


def attribute_type_master(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES (1,'CC','Cost Center',1),(2,'RG','Region',1),(3,'XX','Retired',0)"
        " AS t(AttributeTypeID, AttributeTypeCode, AttributeTypeDescription, Applicable)"
    )


def _numbered(df: DataFrame, column: str, first: int, number: str, keep: str) -> DataFrame:
    """Distinct values of a column that has few, numbered in order."""
    values = F.array_sort(F.collect_set(column))
    return df.agg(values.alias("v")).select(F.posexplode("v").alias("_p", keep)).select(
        (F.col("_p") + first).alias(number), keep
    )


def attribute_unit_master(customer: DataFrame, region: DataFrame) -> DataFrame:
    centers = _numbered(customer, "c_mktsegment", 101, "AttributeTypeUnitID", "c_mktsegment")
    return centers.select(
        "AttributeTypeUnitID",
        F.lit(1).alias("AttributeTypeID"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("AttributeTypeUnitCode"),
        F.col("c_mktsegment").alias("AttributeTypeUnitDescription"),
        F.lit(1).alias("Applicable"),
    ).unionByName(
        region.select(
            (F.lit(200) + F.col("r_regionkey")).alias("AttributeTypeUnitID"),
            F.lit(2).alias("AttributeTypeID"),
            F.substring("r_name", 1, 2).alias("AttributeTypeUnitCode"),
            F.col("r_name").alias("AttributeTypeUnitDescription"),
            F.lit(1).alias("Applicable"),
        )
    )


def employee_attribute_details(
    customer: DataFrame, nation: DataFrame, region: DataFrame, units: DataFrame
) -> DataFrame:
    """Both attributes of every employee from one pass over the customers."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    wide = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = wide.select(
        F.col("c_custkey").alias("k"),
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("AttributeTypeID"), F.col("c_mktsegment").alias("AttributeTypeUnitDescription")),
                F.struct(F.lit(2).alias("AttributeTypeID"), F.col("r_name").alias("AttributeTypeUnitDescription")),
            )
        ).alias("a"),
    ).select("k", "a.*")
    named = units.select("AttributeTypeID", "AttributeTypeUnitDescription", "AttributeTypeUnitID")
    end = (
        F.when(F.col("k") % 3 == 0, None)
        .when(F.col("k") % 11 == 1, ntz(dt.datetime(2020, 1, 1)))
        .otherwise(ntz(OPEN_END))
    )
    return rows.join(named, ["AttributeTypeID", "AttributeTypeUnitDescription"]).select(
        emp_code(F.col("k")).alias("EmployeeCode"), "AttributeTypeID", "AttributeTypeUnitID", end.alias("ToDate")
    )


def type_configuration(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT '{MODULE}' AS ModuleCode, '{MODULE}' AS SubModuleCode,"
        " '1|2' AS AttributeBasedOn, 'Cost Center|Region' AS AttributeBasedOnDesc, 1 AS Applicable"
    )


def unit_type_configuration(units: DataFrame) -> DataFrame:
    """Every cost centre with every region, from the two short id lists."""
    ids = units.agg(
        F.collect_list(F.when(F.col("AttributeTypeID") == 1, F.col("AttributeTypeUnitID"))).alias("centers"),
        F.collect_list(F.when(F.col("AttributeTypeID") == 2, F.col("AttributeTypeUnitID"))).alias("regions"),
    )
    pairs = ids.select("regions", F.explode("centers").alias("a")).select("a", F.explode("regions").alias("b"))
    return pairs.select(
        (F.col("a") * 1000 + F.col("b")).alias("CombinationID"),
        F.concat_ws("|", F.col("a").cast("string"), F.col("b").cast("string")).alias("AttributeUnitConfig"),
        F.lit(MODULE).alias("ModuleCode"),
        F.lit(MODULE).alias("SubModuleCode"),
        F.lit(1).alias("Applicable"),
    )


def pay_group_master(unit_config: DataFrame) -> DataFrame:
    numbered = _numbered(unit_config, "CombinationID", 1, "PayGroupID", "ComboID")
    return numbered.select(
        "PayGroupID", "ComboID", F.when(F.col("ComboID") % 7 == 0, 0).otherwise(1).alias("Applicable")
    )


def payhead_master(part: DataFrame) -> DataFrame:
    numbered = _numbered(part, "p_brand", 1, "PayHeadID", "PayHeadCode")
    return numbered.select(
        "PayHeadID",
        "PayHeadCode",
        (F.lit(1) + F.col("PayHeadID") % 3).alias("PayHeadCategoryID"),
        F.when(F.col("PayHeadCode") == "Brand#3", 0).otherwise(1).alias("Applicable"),
    )


def pay_group_payhead_details(groups: DataFrame, heads: DataFrame) -> DataFrame:
    g, h = F.col("PayGroupID"), F.col("PayHeadID")
    numbers = F.sequence(F.lit(1), heads.select(F.max("PayHeadID")).scalar())
    rules = groups.select("PayGroupID", F.explode(numbers).alias("PayHeadID")).where((g + h) % 4 != 0)
    return rules.join(heads.select("PayHeadID", "PayHeadCategoryID"), "PayHeadID").select(
        "PayGroupID",
        "PayHeadID",
        (g % 2).alias("PfApp"),
        (h % 2).alias("EsicApp"),
        F.lit(1).alias("PtApp"),
        F.lit(0).alias("LwfApp"),
        ((g + h) % 2).alias("OTApplicable"),
        F.when(h % 5 == 0, None).otherwise(1).alias("TaxApp"),
        (h % 3 % 2).alias("SpotTaxApp"),
        F.when(h % 4 == 0, 0).otherwise(1).alias("GrossNetApp"),
        F.lit(1).alias("GratuityApp"),
        (F.col("PayHeadCategoryID") % 2).alias("LeenPayApp"),
    )


def payhead_properties(rules: DataFrame) -> DataFrame:
    g, h, n = F.col("PayGroupID"), F.col("PayHeadID"), F.col("p.n")
    codes = F.array(
        *[F.struct(F.lit(i).alias("n"), F.lit(c).alias("code")) for i, c in enumerate(PROPERTY_CODES, 1)]
    )
    return (
        rules.select("PayGroupID", "PayHeadID", F.explode(F.array(*[F.lit(c) for c in COUNTRIES])).alias("cid"))
        .select("PayGroupID", "PayHeadID", "cid", F.explode(codes).alias("p"))
        .select(
            g.alias("APGD_PaygroupID"),
            h.alias("PM_PayheadID"),
            F.col("cid").alias("GPP_CountryID"),
            F.col("p.code").alias("GPP_PropertyCode"),
            F.when((g + h + n) % 5 == 0, None)
            .otherwise((h + n) % 2 == 0)
            .alias("PropertyChecked"),
        )
    )


def salary_master(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    lines = lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag", "l_shipdate"
    )
    heads = part.select("p_partkey", "p_brand")
    owners = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        lines.join(heads, F.col("l_partkey") == F.col("p_partkey"))
        .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            emp_code(F.col("o_custkey")).alias("EmpCode"),
            F.col("p_brand").alias("HeadCode"),
            F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.col("l_extendedprice")).alias("MonthlyRate"),
            (F.lit(12) * F.col("l_extendedprice")).alias("YearlyValue"),
            F.col("l_shipdate").alias("FromDate"),
            F.when(F.col("l_linestatus") == "O", None).otherwise(F.col("l_shipdate")).alias("ToDate"),
            F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("o_orderdate")).alias("EffDate"),
            F.col("l_shipdate").alias("updateDate"),
        )
    )


def emp_variable(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        emp_code(F.col("o_custkey")).alias("EmpCode"),
        F.concat(F.lit("Brand#"), (F.lit(1) + k % 25).cast("string")).alias("HeadCode"),
        F.when(k % 13 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("Amount"),
        F.col("o_orderdate").alias("CreatedDate"),
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderdate")).alias("UpdatedDate"),
    )


def rostering(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    params = F.concat(
        F.lit('[{"ParameterCode":"'),
        kind,
        F.lit('","ParameterValue":"'),
        (F.col("event_id") % 480).cast("string"),
        F.lit('","Conversion":"Hours"},{"ParameterCode":"NONE","ParameterValue":"15","Conversion":"Days"}]'),
    )
    return events.select(
        emp_code(F.col("user_id")).alias("EmpCode"),
        F.col("ts").cast("date").alias("Date"),
        F.when(kind == "error", -1.0).when(kind == "signup", None).otherwise(F.col("value")).alias("AttValue1"),
        F.col("ts").alias("UpdatedDate"),
        F.when(kind == "view", None).otherwise(params).alias("OT_Param_json"),
        F.col("ts").alias("OT_UpdatedDate"),
    )


def ot_parameter_master(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES ('click',1.5),('purchase',2.0),('signup',1.0) AS t(Name, Rate)"
    )


class HrTables(Mapping):
    """The HR tables of one data folder, each built when first read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._read: dict[str, DataFrame] = {}
        star, own = self._star, self.__getitem__
        self._builders = {
            "employee_details": lambda: employee_details(star("customer")),
            "employee_fin_details": lambda: employee_fin_details(star("customer")),
            "attribute_type_master": lambda: attribute_type_master(spark),
            "attribute_unit_master": lambda: attribute_unit_master(star("customer"), star("region")),
            "employee_attribute_details": lambda: employee_attribute_details(
                star("customer"), star("nation"), star("region"), own("attribute_unit_master")
            ),
            "type_configuration": lambda: type_configuration(spark),
            "unit_type_configuration": lambda: unit_type_configuration(own("attribute_unit_master")),
            "pay_group_master": lambda: pay_group_master(own("unit_type_configuration")),
            "payhead_master": lambda: payhead_master(star("part")),
            "pay_group_payhead_details": lambda: pay_group_payhead_details(
                own("pay_group_master"), own("payhead_master")
            ),
            "payhead_properties": lambda: payhead_properties(own("pay_group_payhead_details")),
            "salary_master": lambda: salary_master(star("lineitem"), star("orders"), star("part")),
            "emp_variable": lambda: emp_variable(star("orders")),
            "rostering": lambda: rostering(star("events")),
            "ot_parameter_master": lambda: ot_parameter_master(spark),
        }

    def _star(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read(self._spark, self._dir, name)
        return self._read[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def hr_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return HrTables(spark, sf_dir)

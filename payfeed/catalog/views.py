"""The HR tables as SQL views over the star-schema tables, for the oracle side.

The DataFrame side (star_schema.py) derives the same tables on its own.
"""

from __future__ import annotations

import re

# Column lists that several views share.
PERSON = "Salutation, FirstName, MiddleName, LastName, DOB"
INDIA_FLAGS = """PfApp AS IsPFApplicable, EFD_PFApplicable AS IsPFApplicableForEmployee,
        EsicApp AS IsESICApplicable, EFD_ESICApplicable AS IsESICApplicableForEmployee,
        PtApp AS IsPTApplicable, EFD_PTApplicable AS IsPTApplicableForEmployee,
        LwfApp AS IsLWFApplicable, EFD_LwfApplicable AS IsLWFApplicableForEmployee,
        PfApp AS IsVPFApplicable, EFD_VPFApplicable AS IsVPFApplicableForEmployee,
        OTApplicable AS IsOTApplicable, TaxApp AS IsTaxApplicable, SpotTaxApp, GratuityApp AS gratuity_applicable"""
PROPERTY_KEYS = f"""ED_EMPID AS EmployeeID, EmpCode AS EmployeeCode, CountryId, {PERSON}, gender_code AS Gender,
        HeadCode AS PayheadCode, PayHeadCategoryID, PayHeadID AS PayheadId, MonthlyRate, YearlyValue AS YearlyRate,
        CAST(ToDate AS DATE) AS ToDate"""
PROPERTY_FLAGS = ", ".join(
    f"max(CASE WHEN code = '{name.upper()}' THEN flag END) AS {name}"
    for name in ("Sssemployee", "Philhealthemployee", "Otapplicable")
)

# In dependency order: the HR tables, then steps that several oracles share.
VIEWS: dict[str, str] = {
    "employee_details": """
        SELECT c_custkey AS ED_EMPID, concat('E', CAST(c_custkey AS STRING)) AS ED_EMPCode,
        101 + c_nationkey % 3 AS ED_CountryID,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Mx' END AS ED_Salutation,
        c_name AS ED_FirstName, CAST(NULL AS STRING) AS ED_MiddleName, c_mktsegment AS ED_LastName,
        DATE '1970-01-01' + CAST(c_custkey % 9000 AS INT) AS ED_DOB,
        DATE '2023-01-01' + CAST(c_custkey % 1500 AS INT) AS ED_DOJ,
        CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' ELSE NULL END AS ED_Sex,
        CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 5 WHEN 3 THEN 6 ELSE 2 END AS ED_Status,
        CAST(NULL AS DATE) AS ED_DOL
        FROM customer
    """,
    "employee_fin_details": """
        SELECT c_custkey AS EFD_ED_EMPID, c_nationkey AS EFD_StateId,
        CAST(c_custkey % 2 AS INT) AS EFD_PFApplicable, CAST(c_custkey % 3 AS INT) % 2 AS EFD_ESICApplicable,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1 END AS EFD_PTApplicable,
        CAST((c_custkey + 1) % 2 AS INT) AS EFD_LwfApplicable,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 0 END AS EFD_VPFApplicable
        FROM customer
    """,
    "attribute_type_master": """
        SELECT * FROM (VALUES (1,'CC','Cost Center',1),(2,'RG','Region',1),(3,'XX','Retired',0))
        AS t(AttributeTypeID, AttributeTypeCode, AttributeTypeDescription, Applicable)
    """,
    "attribute_unit_master": """
        SELECT 100 + CAST(row_number() OVER (ORDER BY c_mktsegment) AS INT) AS AttributeTypeUnitID, 1 AS AttributeTypeID,
        upper(substring(c_mktsegment,1,3)) AS AttributeTypeUnitCode, c_mktsegment AS AttributeTypeUnitDescription, 1 AS Applicable
        FROM (SELECT DISTINCT c_mktsegment FROM customer) s
        UNION ALL
        SELECT 200 + r_regionkey, 2, substring(r_name,1,2), r_name, 1 FROM region
    """,
    "employee_attribute_details": """
        SELECT e.ec AS EmployeeCode, u.AttributeTypeID, u.AttributeTypeUnitID,
        CASE WHEN e.k % 3 = 0 THEN NULL WHEN e.k % 11 = 1 THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '1900-01-01 00:00:00' END AS ToDate
        FROM (SELECT concat('E', CAST(c_custkey AS STRING)) AS ec, c_custkey AS k, c_mktsegment AS v, 1 AS t FROM customer
        UNION ALL
        SELECT concat('E', CAST(c_custkey AS STRING)), c_custkey, r_name, 2 FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) e
        JOIN attribute_unit_master u ON u.AttributeTypeID = e.t AND u.AttributeTypeUnitDescription = e.v
    """,
    "type_configuration": """
        SELECT 'CompensationAndBenefits' AS ModuleCode, 'CompensationAndBenefits' AS SubModuleCode,
        '1|2' AS AttributeBasedOn, 'Cost Center|Region' AS AttributeBasedOnDesc, 1 AS Applicable
    """,
    "unit_type_configuration": """
        SELECT a.AttributeTypeUnitID * 1000 + b.AttributeTypeUnitID AS CombinationID,
        concat(CAST(a.AttributeTypeUnitID AS STRING), '|', CAST(b.AttributeTypeUnitID AS STRING)) AS AttributeUnitConfig,
        'CompensationAndBenefits' AS ModuleCode, 'CompensationAndBenefits' AS SubModuleCode, 1 AS Applicable
        FROM attribute_unit_master a JOIN attribute_unit_master b ON a.AttributeTypeID = 1 AND b.AttributeTypeID = 2
    """,
    "pay_group_master": """
        SELECT CAST(row_number() OVER (ORDER BY CombinationID) AS INT) AS PayGroupID, CombinationID AS ComboID,
        CASE WHEN CombinationID % 7 = 0 THEN 0 ELSE 1 END AS Applicable FROM unit_type_configuration
    """,
    "payhead_master": """
        SELECT CAST(row_number() OVER (ORDER BY p_brand) AS INT) AS PayHeadID, p_brand AS PayHeadCode,
        1 + CAST(row_number() OVER (ORDER BY p_brand) AS INT) % 3 AS PayHeadCategoryID,
        CASE WHEN p_brand = 'Brand#3' THEN 0 ELSE 1 END AS Applicable FROM (SELECT DISTINCT p_brand FROM part) s
    """,
    "pay_group_payhead_details": """
        SELECT g.PayGroupID, h.PayHeadID, g.PayGroupID % 2 AS PfApp, h.PayHeadID % 2 AS EsicApp, 1 AS PtApp, 0 AS LwfApp,
        (g.PayGroupID + h.PayHeadID) % 2 AS OTApplicable, CASE WHEN h.PayHeadID % 5 = 0 THEN NULL ELSE 1 END AS TaxApp,
        h.PayHeadID % 3 % 2 AS SpotTaxApp, CASE WHEN h.PayHeadID % 4 = 0 THEN 0 ELSE 1 END AS GrossNetApp,
        1 AS GratuityApp, h.PayHeadCategoryID % 2 AS LeenPayApp
        FROM pay_group_master g CROSS JOIN payhead_master h WHERE (g.PayGroupID + h.PayHeadID) % 4 <> 0
    """,
    "payhead_properties": """
        SELECT d.PayGroupID AS APGD_PaygroupID, d.PayHeadID AS PM_PayheadID, c.cid AS GPP_CountryID, p.code AS GPP_PropertyCode,
        CASE WHEN (d.PayGroupID + d.PayHeadID + p.n) % 5 = 0 THEN NULL WHEN (d.PayHeadID + p.n) % 2 = 0 THEN true ELSE false END AS PropertyChecked
        FROM pay_group_payhead_details d CROSS JOIN (VALUES (101),(103)) AS c(cid)
        CROSS JOIN (VALUES (1,'SSSEMPLOYEE'),(2,'PHILHEALTHEMPLOYEE'),(3,'OTAPPLICABLE')) AS p(n, code)
    """,
    "salary_master": """
        SELECT concat('E', CAST(o_custkey AS STRING)) AS EmpCode, p_brand AS HeadCode,
        CASE WHEN l_quantity = 1 THEN 0.0 ELSE l_extendedprice END AS MonthlyRate, 12 * l_extendedprice AS YearlyValue,
        l_shipdate AS FromDate, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS ToDate,
        CASE WHEN l_returnflag = 'N' THEN NULL ELSE o_orderdate END AS EffDate, l_shipdate AS updateDate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    """,
    "emp_variable": """
        SELECT concat('E', CAST(o_custkey AS STRING)) AS EmpCode, concat('Brand#', CAST(1 + o_orderkey % 25 AS STRING)) AS HeadCode,
        CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE o_totalprice END AS Amount,
        o_orderdate AS CreatedDate, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS UpdatedDate FROM orders
    """,
    "rostering": """
        SELECT concat('E', CAST(user_id AS STRING)) AS EmpCode, CAST(ts AS DATE) AS "Date",
        CASE WHEN event_type = 'error' THEN -1.0 WHEN event_type = 'signup' THEN NULL ELSE value END AS AttValue1,
        ts AS UpdatedDate, CASE WHEN event_type = 'view' THEN NULL ELSE
        concat('[{"ParameterCode":"', event_type, '","ParameterValue":"', CAST(event_id % 480 AS STRING), '","Conversion":"Hours"},{"ParameterCode":"NONE","ParameterValue":"15","Conversion":"Days"}]') END AS OT_Param_json,
        ts AS OT_UpdatedDate FROM events
    """,
    "ot_parameter_master": """
        SELECT * FROM (VALUES ('click',1.5),('purchase',2.0),('signup',1.0)) AS t(Name, Rate)
    """,
    "open_rows": """
        SELECT e.EmployeeCode, t.AttributeTypeDescription, u.AttributeTypeUnitDescription
        FROM employee_attribute_details e
        JOIN attribute_type_master t ON t.AttributeTypeID = e.AttributeTypeID
        JOIN attribute_unit_master u ON u.AttributeTypeUnitID = e.AttributeTypeUnitID AND u.AttributeTypeID = e.AttributeTypeID
        WHERE t.Applicable = u.Applicable AND t.Applicable = 1
        AND (e.ToDate IS NULL OR e.ToDate = TIMESTAMP '1900-01-01 00:00:00')
    """,
    "emp_matrix": """
        SELECT EmployeeCode,
        max(CASE WHEN AttributeTypeDescription = 'Cost Center' THEN AttributeTypeUnitDescription END) AS CostCenter_Description,
        max(CASE WHEN AttributeTypeDescription = 'Region' THEN AttributeTypeUnitDescription END) AS Region_Description
        FROM open_rows GROUP BY EmployeeCode
    """,
    "config_items": """
        SELECT t.AttributeTypeID, t.AttributeTypeCode, t.AttributeTypeDescription
        FROM type_configuration c, unnest(string_split(c.AttributeBasedOn, '|')) AS i(item)
        JOIN attribute_type_master t ON CAST(t.AttributeTypeID AS VARCHAR) = i.item AND t.Applicable = 1
        WHERE c.Applicable = 1 AND c.ModuleCode = 'CompensationAndBenefits' AND c.SubModuleCode = 'CompensationAndBenefits'
    """,
    "group_units": """
        SELECT c.CombinationID, p.PayGroupID, i.item AS Items, u.AttributeTypeID, u.AttributeTypeUnitCode, u.AttributeTypeUnitDescription
        FROM unit_type_configuration c JOIN pay_group_master p ON c.CombinationID = p.ComboID AND c.Applicable = p.Applicable,
        unnest(string_split(c.AttributeUnitConfig, '|')) AS i(item)
        JOIN attribute_unit_master u ON CAST(u.AttributeTypeUnitID AS VARCHAR) = i.item AND u.Applicable = 1
        WHERE c.Applicable = 1 AND c.ModuleCode = 'CompensationAndBenefits' AND c.SubModuleCode = 'CompensationAndBenefits'
    """,
    "group_matrix": """
        SELECT g.CombinationID, g.PayGroupID,
        max(CASE WHEN c.AttributeTypeDescription = 'Cost Center' THEN g.AttributeTypeUnitDescription END) AS "Cost Center",
        max(CASE WHEN c.AttributeTypeDescription = 'Region' THEN g.AttributeTypeUnitDescription END) AS "Region"
        FROM config_items c JOIN group_units g ON c.AttributeTypeID = g.AttributeTypeID
        GROUP BY g.CombinationID, g.PayGroupID
    """,
    "assigned": """
        SELECT e.EmployeeCode AS EmpCode, g.CombinationID, g.PayGroupID, g."Cost Center", g."Region"
        FROM emp_matrix e JOIN group_matrix g
        ON g."Cost Center" = e.CostCenter_Description AND g."Region" = e.Region_Description
    """,
    "attendance_rows": """
        SELECT d.ED_EMPID AS EmployeeID, r.EmpCode AS EmployeeCode, r."Date" AS AttendanceDate, r."Date" AS ApprovedDate,
        CASE WHEN r.AttValue1 = -1 THEN 0 WHEN r.AttValue1 IS NULL THEN 0 ELSE r.AttValue1 END AS Attendance,
        0 AS EarlyMinutes, 0 AS LateMinutes, r.UpdatedDate AS updateDate_timestamp
        FROM rostering r JOIN employee_details d ON r.EmpCode = d.ED_EMPCode
        WHERE r.UpdatedDate > TIMESTAMP '2024-01-15 00:00:00'
    """,
    "roster_params": """
        SELECT r.EmpCode, r."Date", r.OT_UpdatedDate, json_extract_string(j.p, '$.ParameterCode') AS Code,
        json_extract_string(j.p, '$.ParameterValue') AS Minutes, json_extract_string(j.p, '$.Conversion') AS Conversion
        FROM rostering r, unnest(CAST(json_extract(r.OT_Param_json, '$[*]') AS JSON[])) AS j(p)
        WHERE r.OT_Param_json IS NOT NULL
    """,
    "overtime_rows": """
        SELECT d.ED_EMPID AS EmployeeCode, p."Date", p.Code, round(CAST(p.Minutes AS DOUBLE) / 60.0, 2) AS ExtraHrs,
        CASE WHEN p.Conversion = 'Hours' THEN 'H' ELSE p.Conversion END AS Conversion, m.Rate AS ExtraTimePay,
        p.OT_UpdatedDate AS updateDate_timestamp
        FROM roster_params p JOIN employee_details d ON p.EmpCode = d.ED_EMPCode JOIN ot_parameter_master m ON p.Code = m.Name
        WHERE p.OT_UpdatedDate > TIMESTAMP '2024-01-15 00:00:00'
    """,
    "staff": """
        SELECT ED_EMPID, ED_EMPCode, ED_CountryID, ED_DOB AS DOB, ED_DOJ, ED_Sex, ED_Status, ED_DOL,
        coalesce(ED_Salutation, '') AS Salutation, coalesce(ED_FirstName, '') AS FirstName,
        coalesce(ED_MiddleName, '') AS MiddleName, coalesce(ED_LastName, '') AS LastName,
        CASE lower(ED_Sex) WHEN 'male' THEN 1 WHEN 'female' THEN 2 ELSE 3 END AS gender_code,
        EFD_StateId AS StateID, EFD_PFApplicable, EFD_ESICApplicable, EFD_PTApplicable, EFD_LwfApplicable, EFD_VPFApplicable
        FROM employee_details JOIN employee_fin_details ON EFD_ED_EMPID = ED_EMPID
    """,
    "current_pay": """
        SELECT s.*, a.PayGroupID, h.PayHeadID, h.PayHeadCategoryID
        FROM (SELECT * FROM salary_master WHERE ToDate IS NULL AND MonthlyRate <> 0) s
        JOIN assigned a USING (EmpCode)
        JOIN (SELECT * FROM payhead_master WHERE Applicable = 1) h ON h.PayHeadCode = s.HeadCode
    """,
    "ruled_pay": """
        SELECT * FROM current_pay JOIN pay_group_payhead_details USING (PayGroupID, PayHeadID)
        JOIN staff ON ED_EMPCode = EmpCode
    """,
    "changed_since_2001": "SELECT DISTINCT EmpCode FROM salary_master WHERE updateDate > TIMESTAMP '2001-01-01 00:00:00'",
    "onboarding_india_all": f"""
        SELECT 'Daily' AS InputType, ED_EMPID AS EmployeeID, EmpCode AS EmployeeCode, ED_CountryID AS CountryId, {PERSON},
        StateID, ED_DOJ AS DOJ, ED_Sex AS Gender, HeadCode AS PayHead, PayHeadID, PayHeadCategoryID, MonthlyRate AS MonthlyAmount,
        YearlyValue AS YearlyAmount, FromDate, ToDate, EffDate AS effDate, ED_Status, ED_DOL, {INDIA_FLAGS}, GrossNetApp
        FROM ruled_pay WHERE GrossNetApp = 1 AND ED_Status IN (1, 5, 6, 10)
    """,
    "onboarding_india_rows": """
        SELECT * FROM onboarding_india_all SEMI JOIN changed_since_2001 ON EmpCode = EmployeeCode
    """,
    "salary_india_rows": f"""
        SELECT ED_EMPID AS EmployeeID, EmpCode AS EmployeeCode, ED_CountryID AS CountryId, {PERSON}, StateID, gender_code AS Gender,
        HeadCode AS PayHead, PayHeadID, PayHeadCategoryID, MonthlyRate AS MonthlyAmount, YearlyValue AS YearlyAmount,
        CAST(FromDate AS DATE) AS FromDate, CAST(ToDate AS DATE) AS ToDate, CAST(coalesce(EffDate, FromDate) AS DATE) AS EffDate,
        {INDIA_FLAGS}, GrossNetApp, LeenPayApp, updateDate AS updateDate_timestamp
        FROM ruled_pay WHERE ED_Status IN (1, 10) AND updateDate >= TIMESTAMP '2001-01-01 00:00:00'
    """,
    # One row per property of the head in the employee's pay group, in the country 103.
    "property_pay": """
        SELECT c.*, s.*, b.GPP_CountryID AS CountryId, b.GPP_PropertyCode AS code, coalesce(CAST(b.PropertyChecked AS INT), 0) AS flag
        FROM current_pay c JOIN staff s ON s.ED_EMPCode = c.EmpCode
        JOIN payhead_properties b ON b.APGD_PaygroupID = c.PayGroupID AND b.PM_PayheadID = c.PayHeadID AND b.GPP_CountryID = 103
    """,
    # The same with the rules that the head has in any pay group.
    "property_rule_pay": """
        SELECT p.*, r.LeenPayApp, r.TaxApp, r.SpotTaxApp FROM property_pay p JOIN pay_group_payhead_details r ON r.PayHeadID = p.PayHeadID
    """,
    "onboarding_philippines_rows": f"""
        SELECT {PROPERTY_KEYS}, CAST(EffDate AS DATE) AS EffDate, DATE '2026-01-01' AS DOJ, DATE '2026-01-01' AS FromDate,
        LeenPayApp, TaxApp, SpotTaxApp, updateDate AS updateDate_timestamp, {PROPERTY_FLAGS}
        FROM property_rule_pay SEMI JOIN changed_since_2001 USING (EmpCode) WHERE ED_Status IN (1, 10) GROUP BY ALL
    """,
    "salary_philippines_rows": f"""
        SELECT {PROPERTY_KEYS}, CAST(FromDate AS DATE) AS EffDate, greatest(ED_DOJ, DATE '2000-01-01') AS DOJ,
        DATE '2001-11-05' AS FromDate, {PROPERTY_FLAGS}
        FROM property_pay WHERE ED_Status = 1 AND updateDate >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY ALL
    """,
    "salary_thailand_rows": f"""
        SELECT {PROPERTY_KEYS}, CASE WHEN EffDate IS NOT NULL THEN CAST(FromDate AS DATE) END AS EffDate,
        greatest(ED_DOJ, DATE '2000-01-01') AS DOJ, greatest(ED_DOJ, DATE '2000-01-01') AS FromDate,
        LeenPayApp, TaxApp, SpotTaxApp, {PROPERTY_FLAGS}
        FROM property_rule_pay WHERE ED_Status IN (1, 10) AND updateDate >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY ALL
    """,
    "applicability_rows": f"""
        SELECT ED_EMPID AS EmployeeID, PayHeadID AS PayheadId, MonthlyRate, YearlyValue, CAST(EffDate AS DATE) AS EffDate,
        LeenPayApp, TaxApp, SpotTaxApp, {PROPERTY_FLAGS} FROM property_rule_pay GROUP BY ALL
    """,
    "variable_india_rows": """
        SELECT ED_EMPID AS EmployeeID, v.EmpCode AS EmployeeCode, ED_CountryID AS CountryId, PayHeadCode, r.PayHeadID,
        UpdatedDate AS ApprovedDate, CASE PayHeadCategoryID WHEN 2 THEN 0 - Amount ELSE Amount END AS Amount,
        PayHeadCategoryID AS Type, ifnull(EFD_PFApplicable, 0) AS PFApplicable, ifnull(EFD_PTApplicable, 0) AS PTApplicable,
        ifnull(EFD_LwfApplicable, 0) AS LWFApplicable, ifnull(EFD_ESICApplicable, 0) AS ESICApplicable,
        ifnull(EFD_VPFApplicable, 0) AS VPFApplicable, ifnull(TaxApp, 0) AS TaxApplicable,
        ifnull(SpotTaxApp, 0) AS SpotTaxApplicable, ifnull(OTApplicable, 0) AS OTApplicable
        FROM (SELECT * FROM emp_variable WHERE Amount <> 0 AND UpdatedDate >= TIMESTAMP '1998-01-01 00:00:00') v
        JOIN staff ON ED_EMPCode = v.EmpCode
        JOIN assigned a ON a.EmpCode = v.EmpCode
        JOIN payhead_master h ON h.PayHeadCode = v.HeadCode AND h.Applicable = 1
        JOIN pay_group_payhead_details r ON r.PayGroupID = a.PayGroupID AND r.PayHeadID = h.PayHeadID
    """,
    "variable_philippines_rows": """
        SELECT DISTINCT ED_EMPID AS EmployeeID, EmpCode AS EmployeeCode, payhead_master.PayHeadID, HeadCode AS PayheadCode, PayHeadCategoryID,
        CreatedDate AS ApprovedDate, CASE PayHeadCategoryID WHEN 2 THEN 0 - Amount ELSE Amount END AS Amount, 1 AS Type,
        ifnull(Sssemployee, 0) AS PFApplicable, ifnull(Philhealthemployee, 0) AS SSCApplicable, 0 AS VPFApplicable,
        LeenPayApp, TaxApp AS TaxApplicable, SpotTaxApp AS SpotTaxApplicable
        FROM emp_variable JOIN payhead_master ON PayHeadCode = HeadCode JOIN staff ON ED_EMPCode = EmpCode
        JOIN applicability_rows ON EmployeeID = ED_EMPID
    """,
}


def with_views(sql: str) -> str:
    """``sql`` with the views it needs as WITH items in front.

    ``sql`` may bring WITH items of its own.
    """
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & VIEWS.keys()) - needed:
            needed.add(name)
            todo.append(VIEWS[name])
    items = [f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed]
    sql = sql.strip()
    if not items:
        return sql
    if sql.upper().startswith("WITH "):
        return f"WITH {', '.join(items)}, {sql[5:]}"
    return f"WITH {', '.join(items)} {sql}"

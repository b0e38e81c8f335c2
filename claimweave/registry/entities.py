"""Claim and log entities, derived from the given star-schema and event tables.

The SQL runs unchanged in Spark and in the database that checks the results. Table names
are placeholders: Spark puts frames there, the check puts the plain names.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from claimweave.sources.tables import read_table

# Master rows whose key starts with "other-" match no fact: they leave facts unmatched, as in real data.
ENTITY_SQL = {
    "claim_fact": """
        SELECT CAST(l.l_orderkey AS STRING) AS claimid,
               'M' || CAST(o.o_custkey AS STRING) AS memberid,
               CAST(o.o_custkey AS STRING) AS patientid,
               CAST(l.l_orderkey AS STRING) AS visit_id,
               CAST(l.l_partkey AS STRING) AS charge_id,
               CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS activityid,
               l.l_extendedprice AS gross, l.l_discount AS patientshare,
               l.l_extendedprice - l.l_discount AS netclaim, l.l_quantity AS activityquantity,
               o.o_orderpriority AS encountertype, o.o_orderstatus AS patient_type,
               'ICD' || lpad(CAST(l.l_partkey % 500 AS STRING), 3, '0') AS primary_icd,
               CAST(l.l_suppkey AS STRING) AS insurance_co_id,
               CAST(c.c_nationkey AS STRING) AS tpa_id, CAST(c.c_nationkey AS STRING) AS center_id,
               CAST(l.l_partkey AS STRING) AS plan_id, CAST(l.l_linenumber AS STRING) AS org_id,
               o.o_orderdate AS submission_date, l.l_shipdate AS registration_date,
               CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 2 END AS org_sub_seq
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
    """,
    "open_claim": """
        SELECT CAST(o_orderkey AS STRING) AS claim_id, CAST(o_custkey AS STRING) AS patient_id,
               CAST(o_orderkey AS STRING) AS visit_id, CAST(c_nationkey AS STRING) AS center_id,
               CAST(c_nationkey AS STRING) AS tpa_id
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus = 'P'
    """,
    "patient": """
        SELECT CASE WHEN c_custkey % 10 = 9 THEN 'other-' ELSE '' END || CAST(c_custkey AS STRING) AS mr_no,
               CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE c_mktsegment END AS patient_name,
               CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'M' || CAST(c_custkey % 10 AS STRING) END AS middle_name,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'L' || CAST(c_custkey AS STRING) END AS last_name,
               DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INT) AS dateofbirth,
               CASE WHEN c_custkey % 5 = 0 THEN DATE '1988-02-29' + CAST(c_custkey % 400 AS INT) END AS expected_dob,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS patient_gender,
               'NATION_' || CAST(c_nationkey AS STRING) AS custom_list1_value,
               'P' || CAST(c_custkey AS STRING) AS passport_no,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'X' || CAST(c_custkey AS STRING) END AS custom_field2
        FROM {customer}
    """,
    "registration": """
        SELECT CAST(o_custkey AS STRING) AS mr_no, CAST(o_orderkey AS STRING) AS patient_id,
               CAST(c_nationkey AS STRING) AS center_id, CAST(o_orderdate AS DATE) AS reg_date,
               lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') || ':' || lpad(CAST(o_custkey % 60 AS STRING), 2, '0') AS reg_time,
               CAST(o_custkey % 120 AS STRING) AS doctor, o_orderpriority AS dept_name,
               o_orderstatus AS transfer_source,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS transfer_destination
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    """,
    "diagnosis": """
        SELECT CAST(l_orderkey AS STRING) AS visit_id,
               CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_shipdate AS STRING) AS id,
               'ICD' || lpad(CAST(l_partkey % 500 AS STRING), 3, '0') AS icd_code, 'ICD10' AS code_type,
               CASE WHEN l_returnflag = 'A' THEN 'P' WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 'S' ELSE 'V' END AS diag_type
        FROM {lineitem}
    """,
    "diagnosis_by_patient": """
        SELECT CAST(o_custkey AS STRING) AS visit_id,
               CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id,
               'ICD' || lpad(CAST(l_partkey % 500 AS STRING), 3, '0') AS icd_code, 'ICD10' AS code_type,
               CASE WHEN l_returnflag = 'A' THEN 'P' WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 'S' ELSE 'V' END AS diag_type
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    """,
    "patient_diagnosis": """
        SELECT CAST(l_orderkey AS STRING) AS visit_id, l_linenumber AS diag_order,
               'ICD' || lpad(CAST(l_partkey % 500 AS STRING), 3, '0') AS diagnosis_code
        FROM {lineitem}
    """,
    "observation": """
        SELECT CAST(user_id AS STRING) AS charge_id, event_type AS observation_type,
               'C' || CAST(event_id % 100 AS STRING) AS code, CAST(event_id AS STRING) AS value,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Text' END AS value_type
        FROM {events}
    """,
    "patient_observation": """
        SELECT CAST(user_id AS STRING) AS visit_id, ts AS observation_date,
               event_type AS observation_code, CAST(event_id AS STRING) AS observation_value
        FROM {events}
    """,
    "submission_batch": """
        SELECT substr(CAST(o_orderdate AS STRING), 1, 7) AS submission_batch_id, min(o_orderdate) AS submission_date
        FROM {orders} GROUP BY substr(CAST(o_orderdate AS STRING), 1, 7)
    """,
    "claim_header": """
        SELECT substr(CAST(o_orderdate AS STRING), 1, 7) AS submission_batch_id, CAST(o_orderkey AS STRING) AS patient_id
        FROM {orders}
    """,
    "bill": """
        SELECT CAST(o_orderkey AS STRING) AS bill_no, o_orderdate AS finalized_date FROM {orders}
    """,
    "bill_charge": """
        SELECT CAST(l_partkey AS STRING) AS charge_id, CAST(l_orderkey AS STRING) AS bill_no FROM {lineitem}
    """,
    "insurance_details": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'other-' END || CAST(o_orderkey AS STRING) AS visit_id,
               o_orderpriority AS company_name, o_orderstatus AS plan_name
        FROM {orders}
    """,
    "dim_doctor": """
        SELECT CAST(s_suppkey AS STRING) AS doctor_id, s_name AS doctor_name, CAST(s_nationkey AS STRING) AS dept_id FROM {supplier}
    """,
    "dim_department": """
        SELECT CASE WHEN n_nationkey < 20 THEN '' ELSE 'other-' END || CAST(n_nationkey AS STRING) AS dept_id,
               'DEPT_' || n_name AS dept_name
        FROM {nation}
    """,
    "dim_center": """
        SELECT n_nationkey AS center_id, n_name AS center_name FROM {nation}
    """,
    "dim_insurance_company": """
        SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'other-' ELSE '' END || CAST(s_suppkey AS STRING) AS insurance_co_id,
               s_name AS insurance_co_name
        FROM {supplier}
    """,
    "dim_insurance_category": """
        SELECT DISTINCT CASE WHEN p_size % 10 = 0 THEN 'other-' ELSE '' END || CAST(p_size % 10 AS STRING) AS category_id,
               'CAT' || CAST(p_size % 10 AS STRING) AS category_name
        FROM {part}
    """,
    "dim_plan": """
        SELECT p_partkey AS plan_id, p_name AS plan_name, CAST(p_size % 10 AS STRING) AS category_id FROM {part}
    """,
    "dim_organization": """
        SELECT CAST(r_regionkey AS STRING) AS org_id, r_name AS org_name FROM {region}
    """,
    "dim_tpa": """
        SELECT CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'other-' END || CAST(n_nationkey AS STRING) AS tpa_id,
               'TPA_' || n_name AS tpa_name
        FROM {nation}
    """,
    "run_params": """
        SELECT * FROM (VALUES (1, '1,2,3', DATE '1996-01-01', DATE '1996-06-30'), (2, '3,4', DATE '1996-06-01', DATE '1997-12-31'), (3, '', DATE '2000-01-01', DATE '2000-01-31')) AS t(param_id, centers, from_date, to_date)
    """,
    "log_line": """
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log' AS file, event_id AS pos,
               substr(CAST(ts AS STRING), 1, 19) || ' [10.0.0.' || CAST(user_id % 256 AS STRING) || '] [user' || CAST(user_id AS STRING) || '] ' ||
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END || ' ' ||
               CASE WHEN event_id % 4 = 0 THEN 'plain message ' || CAST(event_id AS STRING)
                    ELSE 'fn' || CAST(event_id % 12 AS STRING) || ' (Mod' || CAST(event_id % 5 AS STRING) || '.java:' || CAST(event_id % 300 AS STRING) || ') : ' || event_type || ' id=' || CAST(event_id AS STRING) END AS line
        FROM {events}
    """,
}

# One row per visit, for the visit-grain variant of the claim product.
ENTITY_SQL["visit"] = """
        SELECT CAST(o_custkey AS STRING) AS patient_id, CAST(o_orderkey AS STRING) AS visit_id,
               o_orderdate AS visit_date, CAST(c_nationkey AS STRING) AS center_id
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    """

# Log files in which events have continuation lines: a property line, a blank line, a cause line.
ENTITY_SQL["log_text"] = f"""
        SELECT file, pos * 4 AS pos, line FROM ({ENTITY_SQL["log_line"]}) AS heads
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 1, chr(9) || 'props ' || props || ' '
        FROM {{events}} WHERE event_type <> 'click'
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 2, '  '
        FROM {{events}} WHERE event_type = 'error'
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 3, 'caused by user' || CAST(user_id AS STRING)
        FROM {{events}} WHERE event_type = 'error'
    """

# The same lines with the hour of their event.
ENTITY_SQL["log_text_by_hour"] = f"""
        SELECT file, pos * 4 AS pos, line, substr(line, 12, 2) AS hour FROM ({ENTITY_SQL["log_line"]}) AS heads
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 1, chr(9) || 'props ' || props || ' ',
               substr(CAST(ts AS STRING), 12, 2)
        FROM {{events}} WHERE event_type <> 'click'
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 2, '  ', substr(CAST(ts AS STRING), 12, 2)
        FROM {{events}} WHERE event_type = 'error'
        UNION ALL
        SELECT 'app-' || substr(CAST(ts AS STRING), 1, 10) || '.log', event_id * 4 + 3, 'caused by user' || CAST(user_id AS STRING),
               substr(CAST(ts AS STRING), 12, 2)
        FROM {{events}} WHERE event_type = 'error'
    """


def tables_of(sql: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(sql) if field})


class Entities:
    """The entities of one data folder, by attribute; each table's footer is read once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._tables = spark, sf_dir, {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self._spark, self._dir, name)
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ENTITY_SQL:
            raise AttributeError(name)
        sql = ENTITY_SQL[name]
        return self._spark.sql(sql, **{t: self.table(t) for t in tables_of(sql)})


def plain_sql(name: str) -> str:
    sql = ENTITY_SQL[name]
    return sql.format(**{t: t for t in tables_of(sql)}).strip()

"""SQL that checks the registered queries on the same tables.

Written from the semantics, not from the Spark plans: windows and joins where the
library aggregates or splits work.
"""

from __future__ import annotations

from claimweave.functions.logtext import (
    CALL_PREFIX,
    CANDIDATE_FORMATS,
    HEADER,
    STRICT_HEADER,
)
from claimweave.registry.entities import plain_sql
from claimweave.registry.queries import AS_OF, CENTERS, FIRST_DAY, LAST_DAY, PERIOD
from claimweave.schemas import CLAIM_FACT, CLAIM_WIDE, DIAG_COLUMNS, DIAG_SLOTS, OBS_ATTRIBUTES

SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}

IN_CENTERS = "IN (" + ", ".join(f"'{c}'" for c in CENTERS.split(",")) + ")"


def in_days(column: str, period=PERIOD) -> str:
    return f"CAST({column} AS DATE) BETWEEN DATE '{period[0]}' AND DATE '{period[1]}'"


def with_entities(names: str, body: str, **ctes: str) -> str:
    parts = [f"{n} AS ({plain_sql(n)})" for n in names.split()] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


ENTITY_FACT_COLUMNS = (
    "claimid memberid patientid visit_id charge_id activityid gross patientshare netclaim activityquantity "
    "encountertype patient_type primary_icd insurance_co_id tpa_id center_id plan_id org_id submission_date "
    "registration_date org_sub_seq"
).split()
SOURCE_NAME = {
    "encounterdiagnosisprincipal": "primary_icd",
    "priorauthorizationid": "prior_auth_id",
    "rate_plan_id": "org_id",
}


def wide_select(overrides: dict[str, str] | None = None, alias: str = "f") -> str:
    """Select list of the wide layout; columns without source or override are typed nulls."""
    items = []
    for field in CLAIM_WIDE.fields:
        source = SOURCE_NAME.get(field.name, field.name)
        if field.name in (overrides or {}):
            value = overrides[field.name]
        elif source in ENTITY_FACT_COLUMNS:
            value = f"{alias}.{source}"
        else:
            value = "NULL"
        items.append(f"CAST({value} AS {SQL_TYPES[field.dataType.simpleString()]}) AS {field.name}")
    return ", ".join(items)


def typed_pivot(table: str) -> str:
    rank = f"""
        SELECT visit_id, icd_code, diag_type,
               row_number() OVER (PARTITION BY visit_id, diag_type ORDER BY icd_code NULLS LAST, id NULLS LAST) AS rn
        FROM {table}
    """
    slots = ", ".join(
        f"max(CASE WHEN diag_type = 'S' AND rn = {i} THEN icd_code END) AS s{i}" for i in range(1, 16)
    )
    return f"""
        SELECT visit_id, max(CASE WHEN diag_type = 'P' THEN icd_code END) AS p1, {slots}
        FROM ({rank}) AS r GROUP BY visit_id
    """


def positional_pivot(table: str) -> str:
    slots = ", ".join(f"max(CASE WHEN rn = {i} THEN icd_code END) AS {s}" for i, s in enumerate(DIAG_SLOTS, start=1))
    return f"""
        SELECT visit_id, {slots} FROM (
            SELECT visit_id, icd_code, row_number() OVER (
                PARTITION BY visit_id ORDER BY diag_type NULLS LAST, icd_code NULLS LAST, id NULLS LAST) AS rn
            FROM {table}) AS r
        GROUP BY visit_id
    """


def ordered_pivot(table: str) -> str:
    slots = ", ".join(
        f"max(CASE WHEN diag_order = {i} THEN diagnosis_code END) AS {s}" for i, s in enumerate(DIAG_SLOTS, start=1)
    )
    return f"SELECT visit_id, {slots} FROM {table} GROUP BY visit_id"


OBS_PIVOT = (
    "SELECT charge_id, "
    + ", ".join(
        f"max(CASE WHEN rn = {i} THEN {source} END) AS {prefix}{i}"
        for prefix, (source, _) in OBS_ATTRIBUTES.items()
        for i in range(1, 6)
    )
    + """
    FROM (SELECT *, row_number() OVER (PARTITION BY charge_id ORDER BY observation_type NULLS LAST,
              code NULLS LAST, value NULLS LAST, value_type NULLS LAST) AS rn FROM observation) AS r
    WHERE rn <= 5 GROUP BY charge_id
    """
)

PATIENT_ATTRIBUTES = f"""
    SELECT mr_no,
           patient_name || ' ' || coalesce(middle_name, '') ||
               CASE WHEN coalesce(middle_name, '') <> '' THEN ' ' ELSE '' END || coalesce(last_name, '') AS patientname,
           strftime(coalesce(expected_dob, dateofbirth), '%b-%d-%Y') AS patientbirthdate,
           CAST(date_part('year', age(CAST(DATE '{AS_OF}' AS TIMESTAMP),
                CAST(coalesce(expected_dob, dateofbirth) AS TIMESTAMP))) AS INTEGER) AS age,
           patient_gender AS gender, custom_list1_value AS nationality, custom_field2 AS passport_no
    FROM patient
"""
DOCTOR_ATTRIBUTES = """
    SELECT r.patient_id AS visit_id, d.doctor_name AS doctorname, p.dept_name AS doctorsdepartment,
           r.transfer_source AS encountertransfersource, r.transfer_destination AS encountertransferdestination,
           CAST(CAST(r.reg_date AS VARCHAR) || ' ' || r.reg_time AS TIMESTAMP) AS registration_date
    FROM registration r JOIN dim_doctor d ON d.doctor_id = r.doctor JOIN dim_department p ON p.dept_id = d.dept_id
"""
PLAN_ATTRIBUTES = """
    SELECT CAST(p.plan_id AS VARCHAR) AS plan_id, p.plan_name AS insurance_plan, c.category_name AS insurance_plan_type
    FROM dim_plan p JOIN dim_insurance_category c ON c.category_id = p.category_id
"""
PATIENT_COLUMNS = "patientname patientbirthdate age gender nationality passport_no".split()
DOCTOR_COLUMNS = (
    "doctorname doctorsdepartment encountertransfersource encountertransferdestination registration_date"
).split()
OBS_PAIRS = {f"{wide}{i}": f"{prefix}{i}" for i in range(1, 6) for prefix, (_, wide) in OBS_ATTRIBUTES.items()}

STAGED_VISITS = f"""
    SELECT pr.* FROM submission_batch b
    LEFT JOIN claim_header h ON h.submission_batch_id = b.submission_batch_id
    JOIN registration pr ON h.patient_id = pr.patient_id
    JOIN dim_center m ON CAST(m.center_id AS VARCHAR) = pr.center_id
    WHERE CAST(m.center_id AS VARCHAR) {IN_CENTERS} AND {in_days('b.submission_date')}
"""
STAGED = "submission_batch claim_header registration dim_center"
EXTRACTED = f"SELECT * FROM claim_fact WHERE org_sub_seq = 1 AND center_id {IN_CENTERS} AND {in_days('submission_date')}"

HEADS = f"""
    SELECT file, pos, CAST(regexp_extract(line, '^{HEADER}', 1) AS TIMESTAMP) AS timestamp,
           regexp_extract(line, '^{HEADER}', 2) AS ip, regexp_extract(line, '^{HEADER}', 3) AS username,
           regexp_extract(line, '^{HEADER}', 4) AS log_level, trim(regexp_extract(line, '^{HEADER}', 5)) AS message
    FROM log_line WHERE regexp_matches(line, '^{HEADER}')
"""
PARSED = f"""
    SELECT *, CASE WHEN regexp_matches(message, '{CALL_PREFIX}') THEN regexp_extract(message, '{CALL_PREFIX}', 1)
                   ELSE 'unknown' END AS function,
           regexp_extract(message, '{CALL_PREFIX}', 2) AS file_info,
           CASE WHEN regexp_matches(message, '{CALL_PREFIX}') THEN regexp_extract(message, '{CALL_PREFIX}', 3)
                ELSE message END AS clean_message,
           CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
           CAST(minute(timestamp) AS INTEGER) AS minute
    FROM heads
"""
GAPS = """
    SELECT *, CAST(date_diff('second', timestamp, lead(timestamp) OVER (PARTITION BY file ORDER BY pos)) AS DOUBLE)
              AS time_diff_seconds
    FROM parsed
"""


def from_log(body: str, **ctes: str) -> str:
    return with_entities("log_line", body, heads=HEADS, parsed=PARSED, gaps=GAPS, **ctes)


def updated(entities: str, source: str, target_key: str, source_key: str, pairs: dict[str, str]) -> str:
    """All claims after one update: a matched row takes the source value, null or not."""
    columns = ", ".join(
        f"CASE WHEN s.{source_key} IS NOT NULL THEN s.{v} ELSE {old(c)} END AS {c}" for c, v in pairs.items()
    )
    key = SOURCE_NAME.get(target_key, target_key)
    return with_entities(
        f"claim_fact {entities}",
        f"""SELECT f.activityid, f.claimid, f.{key} AS {target_key}, {columns}
            FROM claim_fact f LEFT JOIN src s ON f.{key} = s.{source_key}""",
        src=source,
    )


def old(column: str) -> str:
    source = SOURCE_NAME.get(column, column)
    return f"f.{source}" if source in ENTITY_FACT_COLUMNS else "NULL"


def same(columns: list[str]) -> dict[str, str]:
    return {c: c for c in columns}


def claim_wide() -> str:
    hits = {
        **{c: ("p", "mr_no", c) for c in PATIENT_COLUMNS},
        **{c: ("d", "visit_id", c) for c in DOCTOR_COLUMNS},
        **{c: ("g", "visit_id", s) for c, s in zip(DIAG_COLUMNS, DIAG_SLOTS)},
        **{c: ("o", "charge_id", s) for c, s in OBS_PAIRS.items()},
        "insurancecompany": ("i", "insurance_co_id", "insurance_co_name"),
        "rate_plan": ("n", "org_id", "org_name"),
        "insurance_plan": ("l", "plan_id", "insurance_plan"),
        "insurance_plan_type": ("l", "plan_id", "insurance_plan_type"),
        "tpa_name": ("t", "tpa_id", "tpa_name"),
        "centername": ("c", "center_id", "center_name"),
    }
    overrides = {
        column: f"CASE WHEN {a}.{key} IS NOT NULL THEN {a}.{value} ELSE {old(column)} END"
        for column, (a, key, value) in hits.items()
    }
    return with_entities(
        "claim_fact patient registration diagnosis observation dim_doctor dim_department dim_center "
        "dim_insurance_company dim_insurance_category dim_plan dim_organization dim_tpa",
        f"""SELECT {wide_select(overrides)} FROM claim_fact f
            LEFT JOIN pats p ON p.mr_no = f.patientid
            LEFT JOIN docs d ON d.visit_id = f.visit_id
            LEFT JOIN diag g ON g.visit_id = f.visit_id
            LEFT JOIN obs o ON o.charge_id = f.charge_id
            LEFT JOIN dim_insurance_company i ON i.insurance_co_id = f.insurance_co_id
            LEFT JOIN dim_organization n ON n.org_id = f.org_id
            LEFT JOIN plans l ON l.plan_id = f.plan_id
            LEFT JOIN dim_tpa t ON t.tpa_id = f.tpa_id
            LEFT JOIN dim_center c ON CAST(c.center_id AS VARCHAR) = f.center_id
            WHERE f.org_sub_seq = 1 AND {in_days('f.submission_date', (FIRST_DAY, LAST_DAY))}""",
        pats=PATIENT_ATTRIBUTES,
        docs=DOCTOR_ATTRIBUTES,
        diag=typed_pivot("diagnosis"),
        obs=OBS_PIVOT,
        plans=PLAN_ATTRIBUTES,
    )


def log_entries() -> str:
    """Entries of the event log; their detail lines are known from the events themselves."""
    details = with_entities(
        "log_line",
        """SELECT g.file, CAST(row_number() OVER (PARTITION BY g.file ORDER BY g.pos) + coalesce(sum(x.more)
                      OVER (PARTITION BY g.file ORDER BY g.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                      AS BIGINT) AS pos,
                  g.timestamp, g.ip, g.username, g.log_level, g.message, x.details, g.function, g.file_info,
                  g.clean_message, g.date, g.hour, g.minute, g.time_diff_seconds
           FROM gaps g JOIN extra x ON x.event_id = g.pos""",
        heads=HEADS,
        parsed=PARSED,
        gaps=GAPS,
        extra="""SELECT event_id,
                        CASE WHEN event_type = 'click' THEN '' ELSE 'props ' || props END ||
                        CASE WHEN event_type = 'error' THEN chr(10) || 'caused by user' || CAST(user_id AS VARCHAR)
                             ELSE '' END AS details,
                        CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 3 ELSE 1 END AS more
                 FROM events""",
    )
    return details


def log_stats() -> str:
    def top(metric: str, column: str) -> str:
        return f"""SELECT '{metric}' AS metric, {column} AS key, CAST(n AS VARCHAR) AS value FROM (
            SELECT {column}, count(*) AS n FROM parsed GROUP BY {column} ORDER BY n DESC, {column} LIMIT 10) AS t"""

    return from_log(
        f"""SELECT 'total_logs' AS metric, '' AS key, CAST(count(*) AS VARCHAR) AS value FROM parsed
            UNION ALL SELECT 'date_range', 'min', CAST(min(date) AS VARCHAR) FROM parsed
            UNION ALL SELECT 'date_range', 'max', CAST(max(date) AS VARCHAR) FROM parsed
            UNION ALL SELECT 'log_levels', lower(log_level), CAST(count(*) AS VARCHAR) FROM parsed GROUP BY lower(log_level)
            UNION ALL {top('top_functions', 'function')}
            UNION ALL {top('top_usernames', 'username')}
            UNION ALL {top('top_ips', 'ip')}
            UNION ALL SELECT 'avg_logs_per_hour', '', CAST(CAST(sum(n) / CAST(count(*) AS DOUBLE) AS DECIMAL(18,6)) AS VARCHAR)
                      FROM hours
            UNION ALL SELECT 'max_logs_per_hour', '', CAST(max(n) AS VARCHAR) FROM hours""",
        hours="SELECT date, hour, count(*) AS n FROM parsed GROUP BY date, hour",
    )


def log_format_scores() -> str:
    cells = "\nUNION ALL ".join(
        f"""SELECT file, '{name}' AS pattern,
                   CAST(sum(CASE WHEN regexp_matches(line, '^{rx.removeprefix("^")}') THEN 1 ELSE 0 END) AS BIGINT) AS matches,
                   count(*) AS lines FROM head GROUP BY file"""
        for name, rx in CANDIDATE_FORMATS.items()
    )
    return with_entities(
        "log_text",
        cells,
        head="""SELECT file, trim(line, chr(9) || ' ') AS line FROM (
                  SELECT file, line, row_number() OVER (PARTITION BY file ORDER BY pos) AS nth FROM log_text) AS t
                WHERE nth <= 10""",
    )


STRICT_NAMES = "ip username log_level function file_info".split()

FIRST_20 = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY pos) AS nth FROM parsed) AS t
              WHERE nth <= 20"""

SPACE = "chr(9) || chr(10) || chr(13) || ' '"

ORACLES: dict[str, str] = {
    "claim_fact_filtered": with_entities(
        "claim_fact",
        f"""SELECT {wide_select()} FROM claim_fact f
            WHERE f.org_sub_seq = 1 AND f.center_id {IN_CENTERS} AND {in_days('f.submission_date')}""",
    ),
    "claims_by_registration_day": with_entities(
        "claim_fact",
        f"""SELECT activityid, claimid, center_id, registration_date, gross FROM claim_fact
            WHERE center_id {IN_CENTERS} AND {in_days('registration_date')}""",
    ),
    "visits_in_period": with_entities(
        "visit", f"SELECT patient_id AS patientid, visit_id FROM visit WHERE {in_days('visit_date')}"
    ),
    "filtered_count": with_entities(
        "claim_fact", "SELECT count(*) AS record_count FROM extracted", extracted=EXTRACTED
    ),
    "claims_union_open": with_entities(
        "claim_fact open_claim",
        f"""SELECT DISTINCT claimid, CAST(NULL AS VARCHAR) AS insurancecompany, CAST(NULL AS VARCHAR) AS tpa_name,
                   patientid, CAST(NULL AS VARCHAR) AS patientname, CAST(NULL AS VARCHAR) AS patientbirthdate,
                   primary_icd AS encounterdiagnosisprincipal, visit_id, insurance_co_id,
                   CAST(NULL AS VARCHAR) AS admitting_dr_id, CAST(NULL AS VARCHAR) AS doctorname, tpa_id, center_id,
                   plan_id, registration_date, CAST(NULL AS VARCHAR) AS centername,
                   CAST(NULL AS VARCHAR) AS insurance_plan
            FROM claim_fact WHERE org_sub_seq = 1 AND center_id {IN_CENTERS} AND {in_days('registration_date')}
            UNION ALL
            SELECT DISTINCT claim_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), patient_id, CAST(NULL AS VARCHAR),
                   CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), visit_id, CAST(NULL AS VARCHAR),
                   CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), tpa_id, center_id, CAST(NULL AS VARCHAR),
                   CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
            FROM open_claim WHERE center_id {IN_CENTERS}""",
    ),
    "fact_with_center": with_entities(
        "claim_fact dim_center",
        """SELECT f.activityid, f.claimid, f.center_id, f.netclaim FROM claim_fact f
           JOIN dim_center m ON CAST(m.center_id AS VARCHAR) = f.center_id""",
    ),
    "stage_patients": with_entities(
        f"{STAGED} patient",
        "SELECT DISTINCT p.* FROM visits v JOIN patient p ON p.mr_no = v.mr_no",
        visits=STAGED_VISITS,
    ),
    "stage_diagnoses": with_entities(
        f"{STAGED} diagnosis",
        "SELECT d.* FROM visits v JOIN diagnosis d ON d.visit_id = v.patient_id",
        visits=STAGED_VISITS,
    ),
    "stage_registrations": with_entities(
        STAGED,
        """SELECT mr_no, patient_id, reg_date, reg_time, doctor, dept_name, transfer_source, transfer_destination
           FROM visits""",
        visits=STAGED_VISITS,
    ),
    "stage_obs_by_bill": with_entities(
        "observation bill bill_charge",
        f"""SELECT o.* FROM observation o JOIN bill_charge c ON c.charge_id = o.charge_id
            JOIN bill b ON b.bill_no = c.bill_no WHERE {in_days('b.finalized_date')}""",
    ),
    "diagnoses_by_keys": with_entities(
        "claim_fact diagnosis",
        "SELECT * FROM diagnosis WHERE visit_id IN (SELECT visit_id FROM extracted)",
        extracted=EXTRACTED,
    ),
    "observations_by_keys": with_entities(
        "claim_fact observation",
        "SELECT * FROM observation WHERE charge_id IN (SELECT charge_id FROM extracted)",
        extracted=EXTRACTED,
    ),
    "claims_per_param_row": with_entities(
        "claim_fact run_params",
        """SELECT p.param_id, f.activityid, f.claimid, f.center_id, f.submission_date, f.gross
           FROM claim_fact f JOIN run_params p
             ON CAST(f.submission_date AS DATE) BETWEEN p.from_date AND p.to_date
            AND (p.centers = '' OR list_contains(string_split(p.centers, ','), f.center_id))
           WHERE f.org_sub_seq = 1""",
    ),
    "partitioned_scan": """SELECT CAST(l_orderkey % 8 AS INTEGER) AS slice, count(*) AS row_count,
                                  CAST(sum(l_orderkey) AS BIGINT) AS key_sum
                           FROM lineitem GROUP BY 1""",
    "param_query": """SELECT o_orderstatus AS status, count(*) AS order_count FROM orders
                      WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'
                      GROUP BY o_orderstatus""",
    "master_refresh": with_entities(
        "dim_department dim_doctor dim_center dim_insurance_category dim_insurance_company dim_plan "
        "dim_organization dim_tpa",
        """SELECT 'department' AS master, dept_id AS id, dept_name AS name FROM dim_department
           UNION ALL SELECT 'doctor', doctor_id, doctor_name FROM dim_doctor
           UNION ALL SELECT 'hospital_center', CAST(center_id AS VARCHAR), center_name FROM dim_center
           UNION ALL SELECT 'insurance_category', category_id, category_name FROM dim_insurance_category
           UNION ALL SELECT 'insurance_company', insurance_co_id, insurance_co_name FROM dim_insurance_company
           UNION ALL SELECT 'insurance_plan', CAST(plan_id AS VARCHAR), plan_name FROM dim_plan
           UNION ALL SELECT 'organization', org_id, org_name FROM dim_organization
           UNION ALL SELECT 'tpa', tpa_id, tpa_name FROM dim_tpa""",
    ),
    "load_audit": with_entities(
        "claim_fact",
        "SELECT 'claim_load' AS table_name, count(*) AS record_count FROM extracted",
        extracted=EXTRACTED,
    ),
    "distinct_key_counts": with_entities(
        "claim_fact",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS key_column, count(DISTINCT {c}) AS id_count FROM extracted"
            for c in ("claimid", "charge_id", "patientid", "visit_id")
        ),
        extracted=EXTRACTED,
    ),
    "date_chunk_counts": with_entities(
        "claim_fact",
        f"""SELECT CAST(least(11, floor(date_diff('day', DATE '{PERIOD[0]}', CAST(submission_date AS DATE)) /
                       ((date_diff('day', DATE '{PERIOD[0]}', DATE '{PERIOD[1]}') + 1) // 12))) AS INTEGER) AS chunk,
                   count(*) AS claim_count, CAST(min(submission_date) AS DATE) AS first_day,
                   CAST(max(submission_date) AS DATE) AS last_day
            FROM claim_fact WHERE {in_days('submission_date')} GROUP BY 1""",
    ),
    "patient_scalars": with_entities("patient", PATIENT_ATTRIBUTES),
    "diagnosis_slot_labels": with_entities(
        "diagnosis",
        """SELECT visit_id, icd_code, CASE WHEN diag_type = 'S' THEN diag_type || CAST(rn AS VARCHAR) ELSE diag_type END
                  AS slot
           FROM (SELECT *, row_number() OVER (PARTITION BY visit_id, diag_type ORDER BY icd_code, id) AS rn
                 FROM diagnosis) AS r""",
    ),
    "diag_pivot_typed": with_entities("diagnosis", typed_pivot("diagnosis")),
    "diag_pivot_typed_by_patient": with_entities("diagnosis_by_patient", typed_pivot("diagnosis_by_patient")),
    "diag_pivot_positional": with_entities("diagnosis", positional_pivot("diagnosis")),
    "diag_pivot_positional_by_patient": with_entities("diagnosis_by_patient", positional_pivot("diagnosis_by_patient")),
    "diag_pivot_ordered": with_entities("patient_diagnosis", ordered_pivot("patient_diagnosis")),
    "obs_pivot": with_entities("observation", OBS_PIVOT),
    "pivot_first": with_entities(
        "patient_observation",
        "SELECT visit_id, "
        + ", ".join(
            f"""coalesce(max(CASE WHEN observation_code = '{k}' AND rn = 1 THEN observation_value END), '') AS "{k}\""""
            for k in ("click", "error", "purchase", "signup", "view")
        )
        + """ FROM (SELECT *, row_number() OVER (PARTITION BY visit_id, observation_code
                     ORDER BY observation_date, observation_value) AS rn FROM patient_observation) AS r
             GROUP BY visit_id""",
    ),
    "upd_patient": updated("patient", PATIENT_ATTRIBUTES, "patientid", "mr_no", same(PATIENT_COLUMNS)),
    "upd_insurer": updated(
        "dim_insurance_company",
        "SELECT * FROM dim_insurance_company",
        "insurance_co_id",
        "insurance_co_id",
        {"insurancecompany": "insurance_co_name"},
    ),
    "upd_rate_plan": updated(
        "dim_organization", "SELECT * FROM dim_organization", "rate_plan_id", "org_id", {"rate_plan": "org_name"}
    ),
    "upd_plan": updated(
        "dim_plan dim_insurance_category",
        PLAN_ATTRIBUTES,
        "plan_id",
        "plan_id",
        same(["insurance_plan", "insurance_plan_type"]),
    ),
    "upd_tpa": updated("dim_tpa", "SELECT * FROM dim_tpa", "tpa_id", "tpa_id", {"tpa_name": "tpa_name"}),
    "upd_center": updated(
        "dim_center",
        "SELECT CAST(center_id AS VARCHAR) AS center_id, center_name FROM dim_center",
        "center_id",
        "center_id",
        {"centername": "center_name"},
    ),
    "upd_doctor": updated(
        "registration dim_doctor dim_department", DOCTOR_ATTRIBUTES, "visit_id", "visit_id", same(DOCTOR_COLUMNS)
    ),
    "upd_diagnosis": updated(
        "diagnosis", typed_pivot("diagnosis"), "visit_id", "visit_id", dict(zip(DIAG_COLUMNS, DIAG_SLOTS))
    ),
    "upd_observations": updated("observation", OBS_PIVOT, "charge_id", "charge_id", OBS_PAIRS),
    "upd_visit_insurance": with_entities(
        "visit insurance_details",
        """SELECT v.patient_id AS patientid, v.visit_id, i.company_name AS insurance_company,
                  i.plan_name AS insurance_plan
           FROM visit v LEFT JOIN insurance_details i ON i.visit_id = v.visit_id""",
    ),
    "upd_visit_observation": with_entities(
        "visit patient_observation",
        """SELECT v.patient_id AS patientid, v.visit_id, o.observation_value AS observation_details
           FROM visit v LEFT JOIN latest o ON o.visit_id = v.visit_id AND o.rn = 1""",
        latest="""SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY observation_date DESC,
                         observation_code DESC, observation_value DESC) AS rn FROM patient_observation""",
    ),
    "claim_wide": claim_wide(),
    "log_entries": log_entries(),
    "log_header_fields": from_log(
        """SELECT file, pos, timestamp, ip, username, log_level, message, function, file_info, clean_message,
                  date, hour, minute FROM parsed"""
    ),
    "log_strict_fields": with_entities(
        "log_line",
        f"SELECT file, pos, CAST(regexp_extract(line, '^{STRICT_HEADER}', 1) AS TIMESTAMP) AS timestamp, "
        + ", ".join(f"regexp_extract(line, '^{STRICT_HEADER}', {i}) AS {n}" for i, n in enumerate(STRICT_NAMES, start=2))
        + f""", trim(regexp_extract(line, '^{STRICT_HEADER}', 7)) AS message
             FROM log_line WHERE regexp_matches(line, '^{STRICT_HEADER}')""",
    ),
    "log_time_gaps": from_log("SELECT file, pos, timestamp, time_diff_seconds FROM gaps"),
    "log_level_counts": from_log(
        """SELECT lower(log_level) AS log_level, function, count(*) AS count FROM parsed
           GROUP BY lower(log_level), function"""
    ),
    "log_error_functions": from_log(
        "SELECT function, count(*) AS count FROM parsed WHERE lower(log_level) = 'error' GROUP BY function"
    ),
    "log_hourly": from_log(
        """SELECT date, hour, count(*) AS log_count, avg(time_diff_seconds) AS avg_time_diff,
                  max(time_diff_seconds) AS max_time_diff FROM gaps GROUP BY date, hour"""
    ),
    "log_by_ip": from_log("SELECT ip, count(*) AS count FROM parsed GROUP BY ip"),
    "log_by_user": from_log("SELECT username, count(*) AS count FROM parsed GROUP BY username"),
    "log_stats": log_stats(),
    "log_top_functions": from_log(
        """SELECT function, count(*) AS count FROM parsed GROUP BY function
           ORDER BY count(*) DESC, function LIMIT 10"""
    ),
    "log_format_scores": log_format_scores(),
    "log_first_entries": from_log(
        "SELECT file, pos, CAST(nth AS INTEGER) AS nth, log_level, message FROM first_entries",
        first_entries=FIRST_20,
    ),
    "log_sample_distribution": from_log(
        """SELECT file, 'log_level' AS metric, log_level AS key, count(*) AS count FROM first_entries
           GROUP BY file, log_level
           UNION ALL SELECT file, 'component', function, count(*) FROM first_entries GROUP BY file, function""",
        first_entries=FIRST_20,
    ),
    "log_new_files": with_entities(
        "log_line", "SELECT DISTINCT '/logs/' || file AS path FROM log_line WHERE file >= 'app-2024-01-11'"
    ),
    "upsert_diag_pivot": with_entities(
        "diagnosis patient_diagnosis",
        """SELECT * FROM loaded WHERE visit_id NOT IN (SELECT visit_id FROM batch)
           UNION ALL SELECT * FROM batch""",
        loaded=typed_pivot("diagnosis"),
        batch=ordered_pivot("patient_diagnosis"),
    ),
    "upsert_observations": with_entities(
        "visit patient_observation",
        """SELECT visit_id, CAST(NULL AS TIMESTAMP) AS observation_date, 'none' AS observation_code,
                  CAST(NULL AS VARCHAR) AS observation_value
           FROM visit WHERE visit_id NOT IN (SELECT visit_id FROM patient_observation)
           UNION ALL
           SELECT visit_id, observation_date, observation_code, observation_value FROM (
               SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY observation_date DESC,
                      observation_code DESC, observation_value DESC) AS rn FROM patient_observation) AS r
           WHERE rn = 1""",
    ),
    "export_page": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000",
    "export_page_after": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
        FROM lineitem WHERE l_orderkey > 700 OR (l_orderkey = 700 AND l_linenumber > 3)
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate LIMIT 500""",
    "export_schema": """SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price_decimal,
        CAST(CAST(o_custkey AS SMALLINT) AS VARCHAR) AS small_key, CAST(o_orderdate AS DATE) AS order_day,
        o_orderstatus = 'O' AS is_open FROM orders""",
    "clean_frame": f"""SELECT conv_id, turn, CASE WHEN role = 'user' THEN role ELSE '' END AS role,
        trim(coalesce(text, ''), {SPACE}) AS text FROM conversations""",
    "export_csv_round_trip": with_entities(
        "claim_fact",
        f"""SELECT activityid, claimid, center_id, submission_date, gross FROM claim_fact
            WHERE center_id {IN_CENTERS} AND {in_days('submission_date')}""",
    ),
    "chunked_net_price": """SELECT l_orderkey, l_linenumber, (l_extendedprice - l_discount) * CAST(0.5 AS DOUBLE) AS net
                            FROM lineitem""",
    "ingest_new_logs": from_log(
        """SELECT lower(log_level) AS log_level, function, count(*) AS count FROM parsed
           GROUP BY lower(log_level), function"""
    ),
    "log_files_batch": from_log(
        """SELECT p.date, count(*) AS entry_count,
                  CAST(sum(CASE WHEN e.event_type <> 'click' THEN 1 ELSE 0 END) AS BIGINT) AS with_details,
                  CAST(sum(length(p.message)) AS BIGINT) AS message_chars
           FROM parsed p JOIN events e ON e.event_id = p.pos GROUP BY p.date"""
    ),
}

ALL_LOG_TABLES = from_log(
    f"""SELECT 'entries' AS part, strftime(date, '%Y-%m-%d') AS key, CAST(count(*) AS VARCHAR) AS value FROM parsed GROUP BY date
        UNION ALL SELECT 'hourly', concat_ws(' ', strftime(date, '%Y-%m-%d'), hour), CAST(count(*) AS VARCHAR)
        FROM parsed GROUP BY date, hour
        UNION ALL SELECT 'files', CAST(count(DISTINCT (date, hour)) AS VARCHAR), CAST(count(*) AS VARCHAR) FROM parsed
        UNION ALL SELECT 'avg_time_diff', concat_ws(' ', strftime(date, '%Y-%m-%d'), hour), CAST(CAST(avg(gap) AS DECIMAL(18,6)) AS VARCHAR) FROM by_hour GROUP BY date, hour
        UNION ALL SELECT 'max_time_diff', concat_ws(' ', strftime(date, '%Y-%m-%d'), hour), CAST(CAST(max(gap) AS DECIMAL(18,6)) AS VARCHAR) FROM by_hour GROUP BY date, hour
        UNION ALL SELECT 'user', username, CAST(count(*) AS VARCHAR) FROM parsed GROUP BY username
        UNION ALL SELECT 'ip', ip, CAST(count(*) AS VARCHAR) FROM parsed GROUP BY ip
        UNION ALL SELECT 'level', concat_ws(' ', lower(log_level), function), CAST(count(*) AS VARCHAR)
        FROM parsed GROUP BY lower(log_level), function
        UNION ALL SELECT 'stats', concat_ws(' ', metric, key), value FROM ({log_stats()}) AS s""",
    by_hour="""SELECT date, hour, CAST(date_diff('second', timestamp, lead(timestamp) OVER (PARTITION BY date, hour ORDER BY pos)) AS DOUBLE) AS gap
               FROM parsed""",
)
ORACLES["ingest_two_loads"] = ALL_LOG_TABLES
ORACLES["full_reload_logs"] = ALL_LOG_TABLES
ORACLES["replace_claims_rerun"] = with_entities(
    "claim_fact",
    """SELECT activityid, claimid, center_id, submission_date,
              CASE WHEN CAST(submission_date AS DATE) BETWEEN DATE '1996-01-15' AND DATE '1999-06-30'
                    AND center_id IN ('1', '2', '3', '5', '8', '13', '21') THEN gross + 1 ELSE gross END AS gross
       FROM claim_fact WHERE submission_date IS NOT NULL""",
)
ORACLES["append_claims"] = with_entities("claim_fact", "SELECT activityid, claimid, center_id, gross FROM claim_fact")
ORACLES["export_chunks_round_trip"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
ORACLES["log_component_fields"] = with_entities(
    "log_line",
    f"""SELECT file, pos, CAST(regexp_extract(line, '^{HEADER}', 1) AS TIMESTAMP) AS timestamp,
               regexp_extract(line, '^{HEADER}', 4) AS log_level, regexp_extract(line, '^{HEADER}', 3) AS component,
               trim(regexp_extract(line, '^{HEADER}', 5)) AS message
        FROM log_line WHERE regexp_matches(line, '^{HEADER}')""",
)
ORACLES["runs_from_csv"] = with_entities(
    "claim_fact run_params",
    """SELECT f.activityid, f.claimid, f.center_id, f.submission_date, f.gross
       FROM claim_fact f JOIN run_params p
         ON CAST(f.submission_date AS DATE) BETWEEN p.from_date AND p.to_date
        AND (p.centers = '' OR list_contains(string_split(p.centers, ','), f.center_id))
       WHERE f.org_sub_seq = 1""",
)

_BY_KEYS = with_entities(
    "claim_fact registration patient dim_center",
    f"""SELECT r.mr_no, r.patient_id, r.reg_date, r.reg_time, r.doctor, r.dept_name, r.transfer_source,
               r.transfer_destination, p.patient_name, p.middle_name, p.last_name, p.dateofbirth, p.expected_dob,
               p.patient_gender, p.custom_list1_value, p.passport_no, p.custom_field2
        FROM registration r LEFT JOIN patient p ON p.mr_no = r.mr_no
        JOIN dim_center m ON CAST(m.center_id AS VARCHAR) = r.center_id
        WHERE CAST(m.center_id AS VARCHAR) {IN_CENTERS}
          AND (r.mr_no IN (SELECT patientid FROM extracted) OR r.patient_id IN (SELECT visit_id FROM extracted))""",
    extracted=EXTRACTED,
)
ORACLES["patients_by_keys"] = _BY_KEYS
ORACLES["patient_extract_split"] = f"""
    WITH both_parts AS ({_BY_KEYS})
    SELECT 'registration' AS part, mr_no, patient_id AS item FROM both_parts
    UNION ALL SELECT 'patient', mr_no, passport_no FROM both_parts
"""
ORACLES["upsert_ranged"] = ORACLES["upsert_diag_pivot"]
ORACLES["range_scan"] = """
    SELECT CAST(tile - 1 AS INTEGER) AS slice, count(*) AS row_count, min(l_returnflag) AS least, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
    FROM (SELECT *, ntile(10) OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber) AS tile FROM lineitem) AS t GROUP BY 1"""
ORACLES["export_page_deep"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 9000"

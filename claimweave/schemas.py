"""Column contracts of the entities and a projection that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def contract(columns: str) -> StructType:
    """A schema from "name type, ..." (StructType.fromDDL would need a running session)."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


def _text(names) -> str:
    return ", ".join(f"{n} string" for n in names)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the contract's columns, cast to its types; absent ones become typed nulls.

    The expressions are text: a wide contract then costs the driver one call, not one per column.
    """
    have = {c.lower(): f"`{c}`" for c in df.columns}
    return df.selectExpr(
        *[f"CAST({have.get(f.name.lower(), 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    )


SECONDARY_SLOTS = 15
OBSERVATION_SLOTS = 5

DIAG_SLOTS = ["p1"] + [f"s{i}" for i in range(1, SECONDARY_SLOTS + 1)]
DIAG_COLUMNS = ["encounterdiagnosisprincipal"] + [
    f"encounterdiagnosissecondary{i}" for i in range(1, SECONDARY_SLOTS + 1)
]

# pivot column prefix -> (source column, wide-table prefix)
OBS_ATTRIBUTES = {
    "code": ("code", "obscode"),
    "obstype": ("observation_type", "obstype"),
    "value": ("value", "obsvalue"),
    "valuetype": ("value_type", "obsvaluetype"),
}
OBS_COLUMNS = [
    f"{wide}{i}"
    for i in range(1, OBSERVATION_SLOTS + 1)
    for wide in ("obstype", "obscode", "obsvalue", "obsvaluetype")
]

CLAIM_FACT = contract(
    "claimid string, memberid string, payerid string, providerid string, receiverid string, "
    "transactiondate string, emiratesidnumber string, gross double, patientshare double, "
    "netclaim double, encountertype string, patientid string, encounterstart string, "
    "encounterend string, encounterstarttype string, encounterendtype string, primary_icd string, "
    "activityid string, activitystart string, activitytype string, activitycode string, "
    "activityquantity double, activitynet double, orderingclinician string, prior_auth_id string, "
    "clinician string, visit_id string, charge_id string, insurance_co_id string, "
    "admitting_dr_id string, category string, submission_date timestamp_ntz, tpa_id string, "
    "center_id string, act_description string, plan_id string, registration_date timestamp_ntz, "
    "org_id string, insurance_category_id string, patient_type string, org_sub_seq int"
)

OPEN_CLAIM = contract(
    _text(
        "claim_id patient_id visit_id insurance_co_id admitting_dr_id tpa_id center_id plan_id".split()
    )
)

# Names and order of the wide claim table.
CLAIM_WIDE = contract(
    "insurancecompany string, tpa_name string, receiverid string, transactiondate string, "
    "claimid string, memberid string, payerid string, providerid string, emiratesidnumber string, "
    "gross double, patientshare double, netclaim double, encountertype string, patientid string, "
    "patientname string, patientbirthdate string, age int, gender string, encounterstart string, "
    "encounterend string, encounterstarttype string, encounterendtype string, "
    "encountertransfersource string, encountertransferdestination string, "
    + _text(DIAG_COLUMNS)
    + ", activityid string, activitystart string, activitytype string, activitycode string, "
    "activityquantity double, activitynet double, orderingclinician string, "
    "priorauthorizationid string, "
    + _text(OBS_COLUMNS)
    + ", clinician string, visit_id string, charge_id string, insurance_co_id string, "
    "admitting_dr_id string, doctorname string, doctorsdepartment string, category string, "
    "submission_date timestamp_ntz, tpa_id string, center_id string, act_description string, "
    "plan_id string, registration_date timestamp_ntz, rate_plan_id string, "
    "insurance_category_id string, centername string, rate_plan string, insurance_plan string, "
    "insurance_plan_type string, patient_type string, nationality string, passport_no string"
)

REGISTRATION = contract(
    "mr_no string, patient_id string, center_id string, reg_date date, reg_time string, "
    "doctor string, dept_name string, transfer_source string, transfer_destination string"
)
PATIENT = contract(
    "mr_no string, patient_name string, middle_name string, last_name string, dateofbirth date, "
    "expected_dob date, patient_gender string, custom_list1_value string, passport_no string, "
    "custom_field2 string"
)
DIAGNOSIS = contract(_text("visit_id id description icd_code code_type diag_type".split()))
OBSERVATION = contract(_text("charge_id observation_type code value value_type".split()))
DIAG_PIVOT = contract(_text(["visit_id", *DIAG_SLOTS]))
OBS_PIVOT = contract(
    _text(
        ["charge_id"]
        + [f"{a}{i}" for a in OBS_ATTRIBUTES for i in range(1, OBSERVATION_SLOTS + 1)]
    )
)
LOG_ENTRY = contract(
    "file string, pos long, timestamp timestamp_ntz, ip string, username string, "
    "log_level string, message string, details string, function string, file_info string, "
    "clean_message string, date date, hour int, minute int, time_diff_seconds double"
)

# The parameter file's column names, in file order. All are text.
RUN_PARAMS_FILE = contract(
    _text(
        "PRI_SOURCE_HOST SEC_SOURCE_HOST SOURCE_DB SOURCE_SCHEMA SOURCE_USER SOURCE_PWD "
        "BI_SOURCE_HOST BI_SOURCE_DB BI_SOURCE_SCHEMA BI_SOURCE_USER BI_SOURCE_PWD TARGET_HOST "
        "TARGET_DB TARGET_SCHEMA TARGET_USER TARGET_PWD CenterID FromDate ToDate".split()
    )
)

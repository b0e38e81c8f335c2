"""Column projections: wide fact layout, frame cleaning, export types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
    ArrayType,
    MapType,
    StructType,
)

from claimweave.functions.scalars import strip
from claimweave.schemas import CLAIM_FACT, CLAIM_WIDE, conform

# Source column -> name in the wide layout.
RENAMED = {
    "primary_icd": "encounterdiagnosisprincipal",
    "prior_auth_id": "priorauthorizationid",
    "org_id": "rate_plan_id",
}


def project_claim_fact(fact: DataFrame) -> DataFrame:
    """Facts in the wide layout; attributes that are filled later are typed nulls."""
    return conform(conform(fact, CLAIM_FACT).withColumnsRenamed(RENAMED), CLAIM_WIDE)


REGISTRATION_PART = "mr_no patient_id reg_date reg_time doctor dept_name transfer_source transfer_destination".split()
PATIENT_PART = (
    "mr_no patient_name middle_name last_name dateofbirth expected_dob patient_gender "
    "custom_list1_value passport_no custom_field2"
).split()


def split_registration_and_patient(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One extracted frame as its two target tables. Persist the input if both are written."""
    return joined.select(*REGISTRATION_PART), joined.select(*PATIENT_PART)


def registration_and_patient_rows(joined: DataFrame) -> DataFrame:
    """Both target tables of an extracted frame from one pass over it: (part, registration, patient), of which one struct is null."""
    registration, patient = F.struct(*REGISTRATION_PART), F.struct(*PATIENT_PART)
    tagged = F.array(
        F.struct(F.lit("registration").alias("part"), registration.alias("registration"), F.when(F.lit(False), patient).alias("patient")),
        F.struct(F.lit("patient").alias("part"), F.when(F.lit(False), registration).alias("registration"), patient.alias("patient")),
    )
    return joined.select(F.explode(tagged).alias("row")).select("row.*")


def clean_frame(df: DataFrame) -> DataFrame:
    """Lower-case column names; text columns without nulls and without outer whitespace."""
    return df.select(
        *[
            (strip(F.coalesce(F.col(f.name), F.lit(""))) if isinstance(f.dataType, StringType) else F.col(f.name)).alias(
                f.name.lower()
            )
            for f in df.schema.fields
        ]
    )


def export_type(t: DataType) -> DataType:
    """The export's column type; types the export does not know become text."""
    if isinstance(t, (DecimalType, DoubleType, FloatType)):
        return DoubleType()
    known = (IntegerType, LongType, BooleanType, DateType, TimestampType, TimestampNTZType)
    return t if isinstance(t, known) else StringType()


def export_schema(df: DataFrame) -> DataFrame:
    def column(f):
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.to_json(f.name).alias(f.name)
        return F.col(f.name).cast(export_type(f.dataType)).alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])

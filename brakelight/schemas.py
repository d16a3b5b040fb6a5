"""Schemas and fixed values of the complaint data model.

Everything under "Fixed values" must stay equal to the published complaint
file layout and the corpus table definition for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw complaint file layout (51 positional fields, in order).
# ---------------------------------------------------------------------------
RAW_FIELDS = [
    "CMPLID", "ODINO", "MFR_NAME", "MAKETXT", "MODELTXT", "YEARTXT",
    "CRASH", "FAILDATE", "FIRE", "INJURED", "DEATHS", "COMPDESC",
    "CITY", "STATE", "VIN", "DATEA", "LDATE", "MILES", "OCCURENCES",
    "CDESCR", "CMPL_TYPE", "POLICE_RPT_YN", "PURCH_DT", "ORIG_OWNER_YN",
    "ANTI_BRAKES_YN", "CRUISE_CONT_YN", "NUM_CYLS", "DRIVE_TRAIN",
    "FUEL_SYS", "FUEL_TYPE", "TRANS_TYPE", "VEH_SPEED", "DOT",
    "TIRE_SIZE", "LOC_OF_TIRE", "TIRE_FAIL_TYPE", "ORIG_EQUIP_YN",
    "MANUF_DT", "SEAT_TYPE", "RESTRAINT_TYPE", "DEALER_NAME",
    "DEALER_TEL", "DEALER_CITY", "DEALER_STATE", "DEALER_ZIP",
    "PROD_TYPE", "REPAIRED_YN", "MEDICAL_ATTN", "VEHICLES_TOWED_YN",
    "STATE_OF_INCIDENT", "VEHICLE_OPERATOR",
]
# Column groups with a typing rule.
NUMERIC_FIELDS = ["INJURED", "DEATHS", "MILES", "OCCURENCES", "NUM_CYLS", "VEH_SPEED"]
DATE_FIELDS = ["FAILDATE", "DATEA", "LDATE", "PURCH_DT", "MANUF_DT"]
FLAG_FIELDS = [
    "CRASH", "FIRE", "POLICE_RPT_YN", "ORIG_OWNER_YN", "ANTI_BRAKES_YN",
    "CRUISE_CONT_YN", "ORIG_EQUIP_YN", "REPAIRED_YN", "MEDICAL_ATTN", "VEHICLES_TOWED_YN",
]
LINK_TEXT_FIELDS = ["COMPDESC", "CDESCR"]
SUMMARY_PIPE_FIELDS = ["MAKETXT", "MODELTXT", "YEARTXT", "COMPDESC", "CDESCR"]
INVALID_SUFFIX = "_RAW_INVALID"
# Date range accepted by the cleaning step.
DATE_LOW = "1886-01-01"
DATE_HIGH = "2026-09-08"
# Text markers.
NO_DESCRIPTION = "NO_DESCRIPTION_AVAILABLE"
PIPE_SEP = " | "
DOC_PREFIX = "search_document: "
QUERY_PREFIX = "search_query: "
MIN_COMPDESC_LEN = 5  # rows keep when length(COMPDESC) > 5
DEFAULT_K = 20
MAX_REVISION = 3
# Bounded text columns of the corpus table (name, max length).
BOUNDED_LENGTHS = [
    ("cmplid", 9), ("odino", 9), ("mfr_name", 40), ("maketxt", 25), ("modeltxt", 256),
    ("yeartxt", 4), ("city", 30), ("state", 2), ("vin", 11), ("cmpl_type", 4),
    ("drive_train", 4), ("fuel_sys", 4), ("fuel_type", 4), ("trans_type", 4),
    ("dot", 20), ("tire_size", 30), ("loc_of_tire", 4), ("tire_fail_type", 4),
    ("seat_type", 4), ("restraint_type", 4), ("dealer_name", 40), ("dealer_tel", 20),
    ("dealer_city", 30), ("dealer_state", 2), ("dealer_zip", 10), ("prod_type", 4),
    ("state_of_incident", 2), ("vehicle_operator", 40),
]
# Columns the loader writes (the rest of the corpus row is left empty).
LOADER_COLUMNS = [
    "cmplid", "odino", "mfr_name", "maketxt", "modeltxt", "yeartxt", "crash",
    "faildate", "faildate_raw_invalid", "fire", "injured", "deaths", "compdesc",
    "city", "state", "vin", "datea", "datea_raw_invalid", "ldate", "ldate_raw_invalid",
    "miles", "occurences", "cdescr", "cmpl_type", "police_rpt_yn", "purch_dt",
    "purch_dt_raw_invalid", "orig_owner_yn", "summary", "embedding",
]
UPSERT_UPDATE_COLUMNS = ["summary", "embedding"]

# Lower-case names are used inside every DataFrame (Spark resolves names
# case-insensitively; the processed files carry lower-case headers).
RAW_COLUMNS = [c.lower() for c in RAW_FIELDS]
NUMERIC_COLUMNS = [c.lower() for c in NUMERIC_FIELDS]
DATE_COLUMNS = [c.lower() for c in DATE_FIELDS]
FLAG_COLUMNS = [c.lower() for c in FLAG_FIELDS]
LINK_TEXT_COLUMNS = [c.lower() for c in LINK_TEXT_FIELDS]
SUMMARY_PIPE_COLUMNS = [c.lower() for c in SUMMARY_PIPE_FIELDS]
INVALID_COLUMNS = [c + INVALID_SUFFIX.lower() for c in DATE_COLUMNS]
CLEAN_COLUMNS = RAW_COLUMNS + INVALID_COLUMNS + ["summary"]
PROCESSED_COLUMNS = CLEAN_COLUMNS + ["embedding"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
CORRUPT_COLUMN = "_corrupt_record"
RAW_SCHEMA_WITH_CORRUPT = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
PROCESSED_STRING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in PROCESSED_COLUMNS])

VECTOR_TYPE = T.ArrayType(T.FloatType(), containsNull=False)

RETRIEVED_DOC = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("cmplid", T.StringType()),
    T.StructField("odino", T.StringType()),
    T.StructField("mfr_name", T.StringType()),
    T.StructField("modeltxt", T.StringType()),
    T.StructField("compdesc", T.StringType()),
    T.StructField("cdescr", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

JOB_MESSAGE = T.StructType([
    T.StructField("jobId", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("resultKey", T.StringType()),
])
CLEAN_JOB_IN = T.StructType([
    T.StructField("jobId", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("rawKey", T.StringType()),
])
QUEUE_JOB = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("total_row", T.LongType()),
    T.StructField("is_done", T.BooleanType()),
    T.StructField("queue_at", T.TimestampType()),
    T.StructField("time_received", T.TimestampType()),
])
EVAL_CASE = T.StructType([
    T.StructField("case_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("targets", T.StringType()),
    T.StructField("expected_component", T.StringType()),
    T.StructField("incident_text", T.StringType()),
])
GRADE = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("critique", T.StringType()),
])
GRADE_STATUSES = ["pass", "fail"]

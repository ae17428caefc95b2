"""Input schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The 26 columns of a raw record, in load order.
RAW_COLUMNS = [
    "camis", "dba", "boro", "building", "street", "zipcode", "phone",
    "cuisine_description", "inspection_date", "action", "violation_code",
    "violation_description", "critical_flag", "score", "grade", "grade_date",
    "record_date", "inspection_type", "latitude", "longitude",
    "community_board", "council_district", "census_tract", "bin", "bbl", "nta",
]
LOADED_AT = "_loaded_at"

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

FEEDBACK_SCHEMA = T.StructType([
    T.StructField("feedback_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("turn_index", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# A result-set event: rows are arrays of cells, or blocks of such rows.
RESULT_EVENT_DDL = (
    "struct<event:string,data:struct<result_set:struct<"
    "resultSetMetaData:struct<numRows:bigint,rowType:array<struct<name:string>>>,"
    "data:array<string>>>>"
)

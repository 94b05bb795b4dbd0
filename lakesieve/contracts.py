"""Declared schemas of the tables this library writes. Names and types are a contract."""

from pyspark.sql import types as T

RULE_RESULT = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("rule_description", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("validated_time", T.StringType()),
    T.StructField("ingestion_time", T.StringType()),
    T.StructField("rule_status", T.StringType()),
    T.StructField("failed_count", T.LongType()),
    T.StructField("total_count", T.LongType()),
    T.StructField("failure_rate", T.DoubleType()),
    T.StructField("validity_score", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
])

SCORECARD = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("check_timestamp", T.StringType()),
    T.StructField("processing_time_seconds", T.DoubleType()),
    T.StructField("is_empty", T.BooleanType()),
    T.StructField("total_null_record", T.LongType()),
    T.StructField("percentage_of_null_values", T.DoubleType()),
    T.StructField("total_duplicated_records", T.LongType()),
    T.StructField("number_of_records", T.LongType()),
    T.StructField("table_size_mb", T.DoubleType()),
    T.StructField("completeness_score", T.DoubleType()),
    T.StructField("uniqueness_score", T.DoubleType()),
    T.StructField("data_score", T.DoubleType()),
    T.StructField("processing_status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("total_cell_nulls", T.LongType()),
])

CHECKPOINT = T.StructType([
    T.StructField("group_name", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("data_upto_ts", T.TimestampNTZType()),
    T.StructField("note", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("created_by", T.StringType()),
    T.StructField("updated_by", T.StringType()),
])

COPY_OUTCOME = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("target_before", T.LongType()),
    T.StructField("target_after", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("deleted", T.LongType()),
    T.StructField("appended", T.LongType()),
])

SHEET_REJECT = T.StructType([
    T.StructField("sheet", T.StringType()),
    T.StructField("reason", T.StringType()),
])

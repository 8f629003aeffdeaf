"""Readers for logical tables kept in files.

Any DataFrame with the columns of the logical table can stand in for these readers,
whatever store it is from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import children
from .scans import DAY

SCHEMAS = {
    "heartbeat": (
        "c_time string, device_id string, ext string, extra_id string, fr string, "
        "ip string, is_online string, logtime timestamp, p_uid string, "
        "record_type string, refer string, source string, type string, "
        "u_type string, uid string, second string"),
    "api_log": (
        "log_time timestamp, deviceId string, action string, data string, "
        "params string, uid string, client_ip string"),
    "session": (
        "id bigint, circle_id string, u_type int, uid bigint, title string, "
        "start_time timestamp, end_time timestamp, live_status int, type int, "
        "audit int, status int"),
    "comment": (
        "u_type int, uid bigint, discussion_type int, is_robot int, reply_id int, "
        "c_time timestamp, relation_id string"),
    "income": "p_uid bigint, divide_money double, status int, c_time timestamp",
    "room_comment": (
        "uid string, name string, relation_id string, content string, "
        "c_time string, title string"),
}


def read_files(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
               **options: str) -> DataFrame:
    """A logical table from parquet, ORC, JSON lines or CSV, with its fixed schema, and its
    day partition if it is kept by day."""
    by_day = any(c.startswith(f"{DAY}=") for c in children(spark, path))
    schema = SCHEMAS[table] + (f", {DAY} date" if by_day else "")
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def stream_files(spark: SparkSession, schema: str, path: str, fmt: str = "parquet",
                 max_files: int | None = None, **options: str) -> DataFrame:
    """New files under `path` as a stream; `max_files` per trigger is the back-pressure."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)

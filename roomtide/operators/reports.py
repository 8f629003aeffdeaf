"""PV/UV reports from API logs: one row per day and key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.jsonx import descend
from ..sources import scans


def _pv_uv(logs: DataFrame, key: str) -> DataFrame:
    return logs.groupBy(F.to_date("log_time").alias("date"), key).agg(
        F.countDistinct(F.coalesce("deviceId", F.lit(""))).alias("uv"), F.count("*").alias("pv"))


def planner_pages(api_log: DataFrame, start, end) -> DataFrame:
    """Visits of host pages: date, puid, uv, pv."""
    logs = scans.api_logs_with_token(
        api_log, start, end, ((fixed.PLANNER_PAGE_ACTION, "data", "p_uid"),),
        columns=("log_time", "deviceId", "data"))
    path = ("data", "planner", "planner_info", "p_uid")
    return _pv_uv(descend(logs, "data", path, "puid"), "puid")


def view_details(api_log: DataFrame, start, end) -> DataFrame:
    """Visits of article pages: date, v_id, uv, pv."""
    logs = scans.api_logs_with_token(
        api_log, start, end, ((fixed.VIEW_DETAIL_ACTION, "params", "v_id"),),
        columns=("log_time", "deviceId", "params"))
    return _pv_uv(descend(logs, "params", ("get", "v_id"), "v_id"), "v_id")


def dynamic_details(api_log: DataFrame, start, end) -> DataFrame:
    """Visits of dynamic pages: date, dynamic_id, count."""
    logs = scans.api_logs_with_token(
        api_log, start, end, ((fixed.DYNAMIC_DETAIL_ACTION, "params", "dynamic_id"),),
        columns=("log_time", "params"))
    keyed = descend(logs, "params", ("post", "dynamic_id"), "dynamic_id")
    return keyed.groupBy(F.to_date("log_time").alias("date"), "dynamic_id").agg(
        F.count("*").alias("count"))

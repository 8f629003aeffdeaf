"""Small column expressions shared by the batch and streaming operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def blank_to(value: Column, other: Column) -> Column:
    """`value` unless it is NULL or empty, else `other`."""
    return F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(other)


def live_type_code(label: Column) -> Column:
    code = F.lit(fixed.OTHER_LIVE_TYPE_CODE)
    for text, number in fixed.LIVE_TYPE_CODES.items():
        code = F.when(label == text, number).otherwise(code)
    return code


def identity(uid: Column, device_id: Column) -> Column:
    return blank_to(uid, F.coalesce(device_id, F.lit("")))


def online_flag(is_online: Column) -> Column:
    return blank_to(is_online, F.lit("0"))


def beat_seconds(second: Column) -> Column:
    """Seconds a heartbeat stands for; anything but a plain integer counts as the default."""
    plain = second.rlike("^[+-]?[0-9]+$")
    return F.coalesce(
        F.when(plain, second.try_cast("int")), F.lit(fixed.DEFAULT_BEAT_SECONDS)
    )


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def micro_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def cut_to_second(text: Column) -> Column:
    """First 19 characters of a timestamp text: the part up to the second."""
    return F.substring(text, 1, 19)


def iso_text(ts: Column) -> Column:
    """ISO text of an instant with the offset that the session's zone has then."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def local_to_iso(text: Column, offset: str = "+08:00") -> Column:
    """Wall-clock text of a place whose offset is known, marked with that offset."""
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit(offset))


def iso_to_local(text: Column, zone: str) -> Column:
    """ISO text with an offset to wall-clock text in `zone`; NULL if it does not parse."""
    wall = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(None, F.lit(zone), wall), SECOND_FORMAT)


def span_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)

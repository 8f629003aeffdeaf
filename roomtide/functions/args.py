"""Validation of job arguments."""

from __future__ import annotations

import re
from datetime import datetime

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_DATE_OR_TIME = re.compile(r"\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?")


def date_arg(text: str | None) -> str:
    """First yyyy-MM-dd inside `text`."""
    found = _DATE.search(text or "")
    if not found:
        raise ValueError(f"expected an argument like yyyy-MM-dd, got {text!r}")
    datetime.strptime(found.group(), "%Y-%m-%d")
    return found.group()


def date_range_args(args: list[str]) -> tuple[str, str]:
    if len(args) != 2:
        raise ValueError("expected two arguments: start date and end date")
    return date_arg(args[0]), date_arg(args[1])


def date_or_time_arg(text: str | None) -> str:
    """A whole argument that is a date or a date and time; returns its date."""
    if not _DATE_OR_TIME.fullmatch((text or "").strip()):
        raise ValueError(
            f"expected yyyy-MM-dd or yyyy-MM-dd HH:mm:ss, got {text!r}")
    return date_arg(text)

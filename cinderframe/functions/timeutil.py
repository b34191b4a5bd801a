"""Timestamp literals that do not depend on the Python process's local time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime | None) -> Column:
    """A ``timestamp`` literal: the instant of a value with a zone; a value without one is read
    in the session time zone (like casting a stored wall-clock timestamp).  None is NULL."""
    if value is None:
        return F.lit(None).cast("timestamp")
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc)
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f") + "Z").cast("timestamp")
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

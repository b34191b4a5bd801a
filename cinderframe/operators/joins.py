"""Broadcasts of tables built from configuration.

Only a side whose rows come from a configuration list is broadcast by hint.  All other joins
are left to the optimizer, which broadcasts by measured size and splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def config_table(df: DataFrame) -> DataFrame:
    """Broadcast a table that was built from a configuration list (a handful of rows)."""
    return F.broadcast(df)

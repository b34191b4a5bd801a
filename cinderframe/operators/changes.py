"""What a run has to rebuild: plant-months that loads changed, the months that row-based windows reach
from there, and the window state (the last reading days before each month).

A month is the unit of replacement.  A changed reading day of a plant changes the windows of the plant's
next reading days, which may lie in a later month, and no other ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .scopes import plant_day_window
from .sinks import reading_month

# Reading days before a day that its windows need; as many after it see a change of it.
WINDOW_DAYS = max(C.ROLLING_LONG_ROWS - 1, C.CHANGE_LAG_ROWS)
OPEN_END = "9999-12"  # the last month of a stretch without an end
Spans = list[tuple[str, str]]


def _next_month(month: str) -> str:
    year, number = map(int, month.split("-"))
    return f"{year + number // 12:04d}-{number % 12 + 1:02d}"


def spans(months: Iterable[str], since: str | None = None) -> Spans:
    """Stretches of consecutive months (first, last), in order; with ``since`` the last one has no end."""
    out: Spans = []
    for month in sorted({m for m in months if since is None or m < since}):
        if out and _next_month(out[-1][1]) == month:
            out[-1] = (out[-1][0], month)
        else:
            out.append((month, month))
    if since is not None:
        start = out.pop()[0] if out and _next_month(out[-1][1]) == since else since
        out.append((start, OPEN_END))
    return out


def within(stretches: Spans, month: str = "reading_month") -> F.Column:
    """Whether a row's month lies in one of the stretches: a predicate on directories."""
    return reduce(or_, [F.col(month).between(a, b) for a, b in stretches], F.lit(False))


def span_of(stretches: Spans, month: F.Column) -> F.Column:
    """The first month of the stretch that a month lies in."""
    return F.coalesce(*[F.when(month.between(a, b), F.lit(a)) for a, b in stretches])


def _month_of(day) -> F.Column:
    return F.trunc(day, "month")


def touched_months(daily: DataFrame, changed: DataFrame, end: dt.date) -> DataFrame:
    """The months that changes touch, as (reading_month, reached).

    ``daily`` is the new daily aggregate from the first changed month on, ``changed`` has plant_id, first
    and last changed day of a plant-month, ``end`` lies in the table's last month.  ``reached``: the month
    has reading days whose windows hold a changed (or gone) day.  The others only have a window
    state that does.  The readings of changed plants alone are numbered, each plant by itself."""
    readings = (daily.where(F.col("reading_count") > 0)
                .join(changed.select("plant_id").distinct(), "plant_id", "left_semi")
                .select("plant_id", "reading_date", F.lit(False).alias("mark"), F.col("reading_date").alias("first")))
    marks = changed.select("plant_id", F.col("last").alias("reading_date"), F.lit(True).alias("mark"), "first")
    order = Window.partitionBy("plant_id").orderBy("reading_date", "mark")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = (readings.unionByName(marks)
            .withColumn("at", F.count_if(~F.col("mark")).over(upto))
            .withColumn("since", F.max(F.when(F.col("mark"), F.col("at"))).over(upto))
            .withColumn("next", F.lead("reading_date").over(order))
            .where(F.col("at") - F.col("since") <= WINDOW_DAYS))
    until = F.greatest("reading_date", F.coalesce("next", F.lit(end)))
    months = F.sequence(_month_of("first"), _month_of(until), F.expr("interval 1 month"))
    return (rows.select("reading_date", F.explode(months).alias("month"))
            .groupBy(F.date_format("month", "yyyy-MM").alias("reading_month"))
            .agg(F.bool_or(F.col("month") == _month_of("reading_date")).alias("reached")))


def window_state(days: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
    """The last reading days of each plant up to the end of each month from ``first`` to ``last``:
    (reading_month, reading_date, plant_id, scope1_intensity_avg).

    ``days`` are the reading days of these months and the state of the month before.  A day belongs to the
    state of its month and the following ones until ``WINDOW_DAYS`` others have come after it, so a month has
    at most that many rows a plant.  Without ``first``, all months from a plant's first on."""
    start = _month_of("reading_date")
    if first is not None:
        start = F.greatest(start, F.lit(first))
    gone = F.add_months(_month_of(F.lead("reading_date", WINDOW_DAYS).over(plant_day_window())), -1)
    rows = (days.withColumn("start", start).withColumn("stop", F.least(F.lit(last), F.coalesce(gone, F.lit(last))))
            .where(F.col("start") <= F.col("stop")))
    months = F.sequence("start", "stop", F.expr("interval 1 month"))
    return rows.select("reading_date", "plant_id", "scope1_intensity_avg", F.explode(months).alias("month")).select(
        reading_month("month").alias("reading_month"), "reading_date", "plant_id", "scope1_intensity_avg")

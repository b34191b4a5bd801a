"""Report queries over the marts (the data behind each dashboard figure).

``as_of`` replaces the current date so results are reproducible.  "Latest" is per plant:
one row per plant via ``max_by`` -- a partial aggregate that keeps one candidate row per
plant per task before the shuffle, so even a plant with a third of all rows sends only a
handful of rows across the network.
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions import kpi_band, round_half_up, safe_div

TREND_COLUMNS = ["reading_date", "plant_id", "scope1_kg_per_t", "scope1_7d_avg", "scope1_30d_avg",
                 "total_co2_kg_per_t"]
PROGRESS_COLUMNS = ["reading_date", "plant_id", "current_intensity", "target_2030", "target_2050",
                    "progress_pct_to_2030", "progress_pct_to_2050", "gap_vs_2030_target",
                    "status_2030", "required_annual_reduction"]
BENCHMARK_COLUMNS = ["reading_date", "plant_id", "scg_intensity", "global_avg", "asean_avg",
                     "scg_2030_target", "gap_vs_global", "gap_vs_asean", "industry_position"]
SCOPE_COLUMNS = ["reading_date", "plant_id", "scope1_kg_per_t", "scope2_kg_per_t", "scope3_kg_per_t",
                 "total_co2_kg_per_t"]


def window_days(label: str) -> int:
    """Days of a named report window ("30 days", "90 days", "180 days", "1 year")."""
    return C.REPORT_WINDOWS_DAYS[label]


def latest_per_plant(df: DataFrame, order_col: str = "reading_date") -> DataFrame:
    """The newest row of every plant (``reading_date`` is unique per plant in the marts)."""
    others = [c for c in df.columns if c != "plant_id"]
    picked = df.groupBy("plant_id").agg(
        F.max_by(F.struct(*others), F.col(order_col)).alias("r"))
    return picked.select(*[F.col(f"r.{c}").alias(c) if c != "plant_id" else F.col("plant_id")
                           for c in df.columns])


def in_window(df: DataFrame, as_of: dt.date, days: int, columns: list[str]) -> DataFrame:
    """Rows with ``reading_date >= as_of - days`` (inclusive, no upper bound)."""
    kept = df.where(F.col("reading_date") >= F.date_sub(F.lit(as_of), days))
    return kept.select(*columns)


def recent(df: DataFrame, as_of: dt.date, days: int, columns: list[str]) -> DataFrame:
    """The window's rows, oldest first (the order a report presents)."""
    return in_window(df, as_of, days, columns).orderBy("reading_date", "plant_id")


def trend(co2: DataFrame, as_of: dt.date, days: int = C.DEFAULT_REPORT_DAYS) -> DataFrame:
    return recent(co2, as_of, days, TREND_COLUMNS)


def date_extent(report: DataFrame) -> DataFrame:
    """First and last day of a report's rows per plant (the trend chart's x range)."""
    return report.groupBy("plant_id").agg(F.min("reading_date").alias("first_day"),
                                          F.max("reading_date").alias("last_day"))


def progress(net_zero: DataFrame, as_of: dt.date, days: int = C.DEFAULT_REPORT_DAYS) -> DataFrame:
    return recent(net_zero, as_of, days, PROGRESS_COLUMNS)


def benchmark(bgap: DataFrame, as_of: dt.date, days: int = C.DEFAULT_REPORT_DAYS) -> DataFrame:
    return recent(bgap, as_of, days, BENCHMARK_COLUMNS)


def scope_breakdown(co2: DataFrame, as_of: dt.date, days: int = C.DEFAULT_REPORT_DAYS) -> DataFrame:
    return recent(co2, as_of, days, SCOPE_COLUMNS)


def pipeline_log_recent(log: DataFrame, rows: int = C.PIPELINE_LOG_ROWS,
                        tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """The newest run records with ``run_at`` shown in local time (a top-k, not a sort).

    ``run_at`` is an instant (TIMESTAMP); its UTC wall clock is taken from the instant itself, so
    the session's time zone plays no part.  A zone-less ``run_at`` is read as UTC."""
    at = F.col("run_at")
    if isinstance(log.schema["run_at"].dataType, T.TimestampType):
        seconds = (F.unix_micros(at) / F.lit(1_000_000)).cast("decimal(18,6)")
        at = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), at)
    top = log.orderBy(F.desc("run_at"), "dag_id", "source", "status", "rows_loaded",
                      "message").limit(rows)
    return top.select(local.alias("run_at"), "dag_id", "source", "rows_loaded", "status", "message")


def kpi(co2: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Headline KPIs per plant from its latest row (NULL read as 0, as the page does)."""
    last = latest_per_plant(co2)
    cur = F.coalesce(F.col("scope1_kg_per_t"), F.lit(0.0))
    t30 = float(cfg.target_2030)
    base = float(cfg.baseline_intensity)
    pct = (F.lit(base) - cur) / F.lit(base - t30) * F.lit(100.0)
    return last.select(
        "plant_id", "reading_date",
        cur.alias("current_intensity"),
        F.coalesce(F.col("scope1_30d_avg"), cur).alias("rolling_30d_or_current"),
        F.coalesce(F.col("total_co2_kg_per_t"), F.lit(0.0)).alias("total_co2"),
        F.coalesce(F.col("anomaly_count"), F.lit(0)).cast("bigint").alias("anomalies"),
        (cur - F.lit(t30)).alias("gap_vs_2030_target"),
        F.greatest(F.lit(0.0), pct).alias("progress_pct_to_2030"),
        kpi_band(cur, cfg.target_2030).alias("gauge_band"),
        F.when(cur <= F.lit(t30), "on_track").otherwise("off_track").alias("status_2030"),
    )


def scope_share(co2: DataFrame) -> DataFrame:
    """Latest Scope 1/2/3 split per plant, one row per scope with its share in percent."""
    last = latest_per_plant(co2)
    s = [F.coalesce(F.col(f"scope{i}_kg_per_t"), F.lit(0.0)) for i in (1, 2, 3)]
    total = s[0] + s[1] + s[2]
    parts = F.array(*[
        F.struct(F.lit(f"Scope {i + 1}").alias("scope"), s[i].alias("kg_per_t"),
                 round_half_up(safe_div(s[i], total) * 100, 2).alias("share_pct"))
        for i in range(3)
    ])
    return last.select("plant_id", "reading_date", F.inline(parts))


def benchmark_latest(bgap: DataFrame, as_of: dt.date, days: int = C.DEFAULT_REPORT_DAYS) -> DataFrame:
    """Latest benchmark comparison per plant inside the window: one (category, value) row per
    bar, with the position label (unknown codes pass through) and the two gaps."""
    last = latest_per_plant(in_window(bgap, as_of, days, BENCHMARK_COLUMNS))
    labels = F.create_map(*[F.lit(x) for x in chain.from_iterable(C.POSITION_LABELS.items())])
    pos = F.col("industry_position")
    cats = C.BENCHMARK_CATEGORIES
    bars = F.array(*[
        F.struct(F.lit(cat).alias("category"), F.col(col).alias("value"))
        for cat, col in zip(cats, ["scg_intensity", "asean_avg", "global_avg", "scg_2030_target"])
    ])
    return last.select(
        "plant_id", "reading_date", F.inline(bars),
        F.coalesce(labels[pos], pos).alias("position_label"),
        F.coalesce(F.col("gap_vs_global"), F.lit(0.0)).alias("gap_vs_global"),
        F.coalesce(F.col("gap_vs_asean"), F.lit(0.0)).alias("gap_vs_asean"),
    )

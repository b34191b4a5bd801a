"""Column-level building blocks (all built-in Spark expressions; no UDFs)."""

from .numeric import as_decimal, dec, round_half_up, safe_div
from .units import (co2_kg_per_t, coal_t_per_day, global_status, heat_mj_per_t,
                    industry_position, kpi_band, out_of_limits, status_2030)

__all__ = [
    "as_decimal", "dec", "round_half_up", "safe_div", "co2_kg_per_t", "coal_t_per_day",
    "global_status", "heat_mj_per_t", "industry_position", "kpi_band", "out_of_limits",
    "status_2030",
]

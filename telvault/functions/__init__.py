"""Column expressions (JVM-side built-ins only; no Python UDFs)."""

from telvault.functions.hashing import dv_hash, dv_hashdiff, stable_uuid
from telvault.functions.scoring import (
    exact_avg, health_score, money, risk_band, round_half_up, severity_weight,
)
from telvault.functions.windows import trailing_date_window, trailing_window

__all__ = [
    "dv_hash", "dv_hashdiff", "stable_uuid", "exact_avg", "health_score", "money", "risk_band",
    "round_half_up", "severity_weight", "trailing_date_window", "trailing_window",
]

"""Support-health scoring expressions.

Money is summed and scored as exact decimals; rounding is half-up on the
decimal value, never on a double (mrc/8 lands on exact .005 ties).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: scoring constants of the support-health satellite -------
SEVERITY_WEIGHTS = {"critical": 4, "high": 3, "medium": 2}   # anything else (and NULL) weighs 1
OPEN_TICKET_PENALTY, OPEN_TICKET_CAP = 12, 36
INTERACTION_PENALTY, INTERACTION_CAP = 5, 25
CHARGE_DIVISOR, CHARGE_BONUS_CAP = 8, 15
CRITICAL_OPEN_TICKETS = 3
HIGH_INTERACTIONS = 5


def money(c, precision: int = 18, scale: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},{scale})")


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Round half-up on an exact decimal (cast first if the input is not one)."""
    return F.round(c.cast("decimal(38,10)"), digits)


def severity_weight(severity) -> Column:
    s = F.col(severity) if isinstance(severity, str) else severity
    expr = F.lit(1)
    for name, w in reversed(list(SEVERITY_WEIGHTS.items())):
        expr = F.when(s == name, F.lit(w)).otherwise(expr)
    return expr


def risk_band(open_tickets: Column, interactions: Column, data_mb: Column, service_status: Column) -> Column:
    """Searched CASE, first match wins: critical, high, watch, healthy."""
    return (F.when(open_tickets >= CRITICAL_OPEN_TICKETS, "critical")
            .when(interactions >= HIGH_INTERACTIONS, "high")
            .when((data_mb == 0) & (service_status == "active"), "watch")
            .otherwise("healthy"))


def health_score(open_tickets: Column, interactions: Column, recurring_charge: Column) -> Column:
    """100 - min(12*open, 36) - min(5*interactions, 25) + min(mrc/8, 15), 2 digits half-up."""
    mrc = recurring_charge.cast("decimal(18,2)")
    raw = (F.lit(100)
           - F.least(open_tickets * OPEN_TICKET_PENALTY, F.lit(OPEN_TICKET_CAP))
           - F.least(interactions * INTERACTION_PENALTY, F.lit(INTERACTION_CAP))
           + F.least(mrc / F.lit(CHARGE_DIVISOR), F.lit(CHARGE_BONUS_CAP).cast("decimal(18,2)")))
    return F.round(raw.cast("decimal(24,6)"), 2).cast("decimal(18,2)")


def exact_avg(c, digits: int = 2) -> Column:
    """Average as exact decimal division, rounded half-up to ``digits``.

    ``avg`` over decimals rounds the quotient to scale 6 before any
    presentation rounding; sum/count at scale 10 avoids that double rounding.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.try_divide(F.sum(col.cast("decimal(38,10)")), F.count(col)), digits)

"""Banding and scoring expressions (CASE chains, arithmetic).

All NULL inputs fall to the ELSE branch, as a SQL searched CASE does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from towerlens.functions.geo import _c

# Distance bands of the coverage summaries.
DISTANCE_BANDS_GOLD = [(200, "1: < 200m"), (500, "2: 200-500m"), (1000, "3: 500m-1km"), (2000, "4: 1-2km")]
DISTANCE_BANDS_GOLD_ELSE = "5: > 2km"
DISTANCE_BANDS_DESIGNER = [(500, "0-500m"), (1000, "500-1000m"), (2000, "1000-2000m"), (3000, "2000-3000m")]
DISTANCE_BANDS_DESIGNER_ELSE = "3000m+"
PROXIMITY_BANDS = [(200, "Very Close (<200m)"), (500, "Close (200-500m)"), (1000, "Moderate (500m-1km)")]
PROXIMITY_BANDS_ELSE = "Far (>1km)"


def band(col, cuts: Sequence[tuple[float, str]], else_: str) -> Column:
    """``CASE WHEN col < u1 THEN l1 WHEN col < u2 THEN l2 ... ELSE e END``."""
    c = _c(col)
    expr = None
    for upper, label in cuts:
        expr = F.when(c < upper, F.lit(label)) if expr is None else expr.when(c < upper, F.lit(label))
    return expr.otherwise(F.lit(else_)) if expr is not None else F.lit(else_)


def band_desc(col, cuts: Sequence[tuple[float, str]], else_: str) -> Column:
    """``CASE WHEN col >= c1 THEN l1 WHEN col >= c2 ... ELSE e END`` (descending cut-points)."""
    c = _c(col)
    expr = None
    for lower, label in cuts:
        expr = F.when(c >= lower, F.lit(label)) if expr is None else expr.when(c >= lower, F.lit(label))
    return expr.otherwise(F.lit(else_)) if expr is not None else F.lit(else_)


def band_sql(col: str, cuts: Sequence[tuple[float, str]], else_: str) -> str:
    whens = " ".join(f"WHEN {col} < {u} THEN '{lab}'" for u, lab in cuts)
    return f"CASE {whens} ELSE '{else_}' END"


def coverage_quality(tech, down) -> Column:
    """No Coverage (no technology row) / Strong >= 35 / Moderate >= 7 / Weak."""
    t, d = _c(tech), _c(down)
    # Quality class labels and thresholds.
    return (F.when(t.isNull(), F.lit("No Coverage"))
            .when(d >= 35, F.lit("Strong (35+ Mbps)"))
            .when(d >= 7, F.lit("Moderate (7+ Mbps)"))
            .otherwise(F.lit("Weak")))


def health_band(util, latency, loss) -> Column:
    """Tower health: critical / watch / healthy."""
    u, l, p = _c(util), _c(latency), _c(loss)
    # Critical at util >= 85, latency >= 120 ms, loss >= 3 %;
    # watch at 70 / 90 / 1.5.
    return (F.when((u >= 85) | (l >= 120) | (p >= 3), F.lit("critical"))
            .when((u >= 70) | (l >= 90) | (p >= 1.5), F.lit("watch"))
            .otherwise(F.lit("healthy")))


def risk_band(health, load) -> Column:
    """Building service risk; missing telemetry (NULL) falls to 'healthy'."""
    h, s = _c(health), _c(load)
    # Critical at load >= 45, watch at load >= 28.
    return (F.when((h == "critical") | (s >= 45), F.lit("critical"))
            .when((h == "watch") | (s >= 28), F.lit("watch"))
            .otherwise(F.lit("healthy")))


def load_score(users, penetration) -> Column:
    """``ROUND(users * (1.1 - penetration / 2.0), 2)``."""
    return F.round(_c(users) * (F.lit(1.1) - _c(penetration) / F.lit(2.0)), 2)


def signal_score(towers, down, buildings) -> Column:
    """``LEAST(100, GREATEST(0, 50 + 20*towers + down/10 - 0.5*buildings))`` rounded to 1 place."""
    raw = F.lit(50.0) + F.lit(20.0) * _c(towers) + _c(down) / F.lit(10.0) - F.lit(0.5) * _c(buildings)
    return F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw)), 1)


# Signal-quality categories by score.
SIGNAL_CATEGORIES = [(80, "Excellent (80-100)"), (60, "Good (60-79)"), (40, "Fair (40-59)")]
SIGNAL_CATEGORIES_ELSE = "Poor (0-39)"
# Map colour classes by download speed.
SPEED_COLOURS = [(100, "green"), (35, "orange")]
SPEED_COLOURS_ELSE = "red"


def label_map(col, mapping: dict, default: Column | None = None) -> Column:
    """Simple CASE: ``CASE col WHEN k1 THEN v1 ... ELSE default END``."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


# Mobile network codes -> carrier names for MCC 310.
CARRIER_NAMES = {260: "T-Mobile", 410: "AT&T"}


def carrier_name(net) -> Column:
    """Carrier label with computed default ``CONCAT('MNC-', net)``."""
    return label_map(net, CARRIER_NAMES, F.concat(F.lit("MNC-"), _c(net).cast("string")))


def traffic_mix(ts) -> Column:
    """Hour 18-23 video_heavy, 7-9 commute, else balanced."""
    h = F.hour(_c(ts))
    return (F.when(h.between(18, 23), F.lit("video_heavy"))
            .when(h.between(7, 9), F.lit("commute"))
            .otherwise(F.lit("balanced")))


def hour_weight(ts) -> Column:
    """Time-of-day multiplier (7-10: 2.2, 16-20: 2.6, 0-5: 0.45, else 1) x 0.7 on weekends."""
    t = _c(ts)
    h = F.hour(t)
    base = (F.when(h.between(7, 10), F.lit(2.2))
            .when(h.between(16, 20), F.lit(2.6))
            .when(h.between(0, 5), F.lit(0.45))
            .otherwise(F.lit(1.0)))
    return base * F.when(F.weekday(t) >= 5, F.lit(0.7)).otherwise(F.lit(1.0))


def clip(col, lo: float, hi: float) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), _c(col)))


def hour_floor(ts) -> Column:
    return F.date_trunc("hour", _c(ts))

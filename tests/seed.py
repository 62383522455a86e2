"""A small metric table made by rule, with planted faults, and plain-Python versions of the maths."""

from __future__ import annotations

import datetime as dt
import math
import statistics

START = dt.date(2026, 1, 1)
LEVELS = {  # metric, segment -> usual level
    ("revenue", "all"): 50_000.0,
    ("revenue", "product"): 25_000.0,
    ("conversion_rate", "all"): 0.034,
    ("conversion_rate", "product"): 0.028,
    ("active_users", "all"): 12_000.0,
    ("active_users", "product"): 6_500.0,
}
DAYS = [d for d in range(95) if not 73 <= d <= 77]  # five dates are missing
PLANTED = {
    ("revenue", "all", dt.date(2026, 3, 5)): -500.0,
    ("conversion_rate", "product", dt.date(2026, 3, 1)): 1.15,
    ("active_users", "all", dt.date(2026, 3, 10)): 0.0,
}


def rows():
    """(metric_date, metric_name, metric_value, segment)"""
    result = []
    for k, ((metric, segment), level) in enumerate(LEVELS.items()):
        for d in DAYS:
            date = START + dt.timedelta(days=d)
            wobble = ((d * 7 + k * 3) % 11 - 5) / 100
            factor = {30: 0.63, 44: 1.22}.get(d, 1 + wobble)
            value = PLANTED.get((metric, segment, date), round(level * factor, 4))
            result.append((date, metric, value, segment))
    result += [(dt.date(2026, 4, 5), "sessions", 900.0, s) for s in ("all", "product")]
    return result


def half_up(x, digits):
    if x is None:
        return None
    scaled = abs(x) * 10**digits
    return math.copysign(math.floor(scaled + 0.5 + 1e-9) / 10**digits, x) if scaled else 0.0


def drift_by_hand(data, window=14, min_rows=7):
    """One dict per input row, in plain Python."""
    series = {}
    for date, metric, value, segment in data:
        series.setdefault((metric, segment), []).append((date, value))
    result = []
    for (metric, segment), points in series.items():
        points.sort()
        for i, (date, value) in enumerate(points):
            frame = [v for _, v in points[max(0, i - window + 1) : i + 1]]
            average = sum(frame) / len(frame)
            deviation = statistics.stdev(frame) if len(frame) > 1 else None
            z = None
            if deviation and len(frame) >= min_rows:
                z = (value - average) / deviation
            result.append(
                {
                    "metric_date": date, "metric_name": metric, "segment": segment,
                    "metric_value": value, "avg": average, "std": deviation, "n": len(frame),
                    "z": z,
                    "severity": None if z is None else severity(z),
                }
            )
    return result


def severity(z):
    z = abs(z)
    return "critical" if z >= 3 else "warning" if z >= 2 else "watch" if z >= 1.5 else "normal"

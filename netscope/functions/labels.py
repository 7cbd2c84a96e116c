"""Labelling rules as native ``when`` chains (no row-at-a-time Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules).
# SLO tier defaults: delay threshold 150 ms, throughput 100 Mbps, loss 1 %.
SLO_LIMITS = {"delay_limit": 150.0, "tput_limit": 100.0, "loss_limit": 1.0}
# Tier -> share of each limit that must be met; the best tier must stay below its delay share.
SLO_TIERS = {3: (0.5, 1.5, 0.25), 2: (1.0, 1.0, 1.0), 1: (1.5, 0.5, 2.0)}
# Performance-class score thresholds.
DELAY_STEPS = (100.0, 200.0, 300.0)          # delay < 100 -> 4, < 200 -> 3, < 300 -> 2
BANDWIDTH_STEPS = (1.5e9, 1e9, 5e8)          # target_bwd > 1.5e9 -> 4, > 1e9 -> 3, > 5e8 -> 2
GRANULARITY_STEPS = (0.5, 0.8, 1.0)          # granularity <= 0.5 -> 4, <= 0.8 -> 3, <= 1.0 -> 2
CLASS_CUTS = (3.5, 2.5, 1.5)                 # mean score >= 3.5 Excellent, >= 2.5 Good, >= 1.5 Fair, else Poor
CLASS_NAMES = ("Excellent", "Good", "Fair", "Poor")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slo_tier(delay, tput, loss, delay_limit: float = 150.0, tput_limit: float = 100.0,
             loss_limit: float = 1.0, tiers=None) -> Column:
    """Highest tier whose shares of the limits hold, 0 if none does; NULL when any KPI is missing.

    ``tiers`` maps a tier to its (delay, throughput, loss) shares of the limits.
    """
    tiers = tiers or SLO_TIERS
    kpis = [_c(delay), _c(tput), _c(loss)]
    held = []
    for tier, (d, t, p) in tiers.items():
        ceiling = F.lit(d * delay_limit)
        in_time = kpis[0] < ceiling if tier == max(tiers) else kpis[0] <= ceiling
        held.append(F.when(in_time & (kpis[1] >= t * tput_limit) & (kpis[2] <= p * loss_limit), F.lit(tier)))
    best = F.greatest(*held, F.lit(0)) if held else F.lit(0)
    known = kpis[0].isNotNull() & kpis[1].isNotNull() & kpis[2].isNotNull()
    return F.when(known, best).cast("int")


def _score_lt(x: Column, steps) -> Column:
    a, b, c = steps
    return F.when(x < a, 4).when(x < b, 3).when(x < c, 2).otherwise(1)


def _score_gt(x: Column, steps) -> Column:
    a, b, c = steps
    return F.when(x > a, 4).when(x > b, 3).when(x > c, 2).otherwise(1)


def _score_le(x: Column, steps) -> Column:
    a, b, c = steps
    return F.when(x <= a, 4).when(x <= b, 3).when(x <= c, 2).otherwise(1)


def performance_class(delay, bandwidth, gran_snd, gran_rcv,
                      delay_steps=DELAY_STEPS, bandwidth_steps=BANDWIDTH_STEPS,
                      granularity_steps=GRANULARITY_STEPS, cuts=CLASS_CUTS) -> Column:
    """Mean of three 1-4 scores; a missing input scores 1 (``when`` on NULL is false)."""
    gran = F.least(_c(gran_snd), _c(gran_rcv))  # least() skips NULLs: min of the non-null sides
    total = (_score_lt(_c(delay), delay_steps) + _score_gt(_c(bandwidth), bandwidth_steps)
             + _score_le(gran, granularity_steps)) / F.lit(3.0)
    a, b, c = cuts
    return (F.when(total >= a, CLASS_NAMES[0]).when(total >= b, CLASS_NAMES[1])
            .when(total >= c, CLASS_NAMES[2]).otherwise(CLASS_NAMES[3]))

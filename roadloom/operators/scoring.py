"""A weighted score of bounded components, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Component weights (their sum is 1), tiers by least score, casualty weights, time scales.
WEIGHTS = {"casualties": 0.30, "frequency": 0.25, "recency": 0.15, "vulnerable": 0.15, "severity": 0.10, "evidence": 0.05}
TIERS = [("critical", 75), ("high", 50), ("medium", 25), ("watch", 0)]
FATALITY_WEIGHT, INJURY_WEIGHT, CASUALTY_SCALE, FREQUENCY_SCALE, DECAY_DAYS, FULL_SEVERITY, FULL_SOURCES = 5, 1, 10, 3.0, 90.0, 5, 3.0


def score_components(raw: DataFrame) -> DataFrame:
    """raw with one column per component, each in 0..1; undated rows have no recency, future dates full recency."""
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    days = F.greatest(F.col("days_since_last"), F.lit(0)).cast("double")
    return raw.withColumns({
        "casualties": 1 - F.exp(-(FATALITY_WEIGHT * n("fatalities") + INJURY_WEIGHT * n("injuries")) / CASUALTY_SCALE),
        "frequency": 1 - F.exp(-n("inc_6mo") / FREQUENCY_SCALE),
        "recency": F.when(F.col("days_since_last").isNull(), 0.0).otherwise(F.exp(-days / DECAY_DAYS)),
        "vulnerable": n("vulnerable_share"),
        "severity": F.least(F.lit(1.0), n("max_severity") / FULL_SEVERITY),
        "evidence": F.least(F.lit(1.0), n("n_sources") / FULL_SOURCES) * n("avg_conf"),
    })


def total_score(parts: DataFrame) -> DataFrame:
    total = None
    for c, w in WEIGHTS.items():
        total = F.lit(w) * F.col(c) if total is None else total + F.lit(w) * F.col(c)
    return parts.withColumn("score", F.round(100 * total, 1))


def tier(score: Column) -> Column:
    """Name of the tier; a null score is in the lowest."""
    out = None
    for name, least in TIERS[:-1]:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(TIERS[-1][0])

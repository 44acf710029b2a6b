"""A fixed scoring rule over engineered features, written for Spark and SQL.

Used where a check needs a score that both engines compute identically (the
metric, calibration and counterfactual oracles); models produce real scores.
The score is rounded to 4 places, which also produces ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed weights of the probe rule (feature, centre, weight).
PROBE_TERMS = (
    ("Wealth_log", 12.9, 1.5),
    ("RiskPropensity", 2.5, 0.3),
    ("FinancialEducation", 2.5, -0.2),
    ("Income_per_person", 60000.0, 0.00001),
)
PROBE_DIGITS = 4


def probe_logit(prefix: str = "") -> Column:
    z = F.lit(0.0)
    for name, centre, weight in PROBE_TERMS:
        z = z + F.lit(weight) * (F.coalesce(F.col(prefix + name), F.lit(centre)) - F.lit(centre))
    return z


def probe_score(prefix: str = "") -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-probe_logit(prefix))), PROBE_DIGITS)


def probe_score_sql(alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    z = " + ".join(f"({w}) * (coalesce({pre}{n}, {c}) - {c})" for n, c, w in PROBE_TERMS)
    return f"round(1.0 / (1.0 + exp(-({z}))), {PROBE_DIGITS})"

"""Scalar building blocks of the engineered features.

Guards follow the rules that keep Spark (ANSI mode) and SQL engines equal:
divide by ``nullif(d, 0)``, ``log1p`` only above -1, clip with ``when``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from propensio.config import AGE_BRACKETS


def lit_double(value) -> Column:
    return F.lit(None).cast("double") if value is None else F.lit(float(value))


def safe_divide(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    return num / F.nullif(den, F.lit(0))


def log1p_guarded(x: Column) -> Column:
    """log(1 + x) for x > -1, else NULL (numpy would give NaN or -inf)."""
    return F.when(x > -1, F.log1p(x))


def clip_upper(x: Column, upper) -> Column:
    """min(x, upper) keeping NULL (``least`` would turn NULL into upper)."""
    if upper is None:
        return x
    bound = lit_double(upper)
    return F.when(x > bound, bound).otherwise(x)


def clip_lower(x: Column, lower) -> Column:
    bound = F.lit(lower)
    return F.when(x < bound, bound).otherwise(x)


def age_bracket_flags(age: Column) -> dict[str, Column]:
    """One 0/1 int column per right-closed age bin; outside all bins → all 0."""
    return {
        f"Age_bracket_{label}": F.coalesce(((age > lo) & (age <= hi)).cast("int"), F.lit(0))
        for label, lo, hi in AGE_BRACKETS
    }


def stratum_key(cols: list[str]) -> Column:
    """'<t0>_<t1>' text of the label values (the stratification key); a null label is a value of its own."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])

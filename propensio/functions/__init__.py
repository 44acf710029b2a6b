"""Column expressions (all JVM-side built-ins, no Python UDF)."""

from propensio.functions.hashing import md5_order_key, md5_uniform
from propensio.functions.features import (
    age_bracket_flags,
    clip_upper,
    log1p_guarded,
    safe_divide,
    stratum_key,
)

__all__ = [
    "md5_order_key",
    "md5_uniform",
    "age_bracket_flags",
    "clip_upper",
    "log1p_guarded",
    "safe_divide",
    "stratum_key",
]

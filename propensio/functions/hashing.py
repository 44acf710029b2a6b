"""Seeded, partition-independent pseudo-randomness from md5.

``rand()`` depends on partitioning and ``monotonically_increasing_id`` on the
physical layout; an md5 of ``seed:key`` gives the same number for the same row
wherever it lands, and the same text in Spark and in SQL engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(part) -> Column:
    if isinstance(part, Column):
        return part.cast("string")
    return F.lit(str(part))


def md5_text(*parts) -> Column:
    """md5 hex of the parts joined by ':'."""
    return F.md5(F.concat_ws(":", *[_as_col(p) for p in parts]))


def md5_order_key(seed: int, id_col: str) -> Column:
    """Sort key of a seeded shuffle: md5('<seed>:<id>')."""
    return md5_text(seed, F.col(id_col))


def md5_uniform(*parts) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of md5(parts)."""
    head = F.substring(md5_text(*parts), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def md5_uniform_sql(*parts: str) -> str:
    """The DuckDB twin of :func:`md5_uniform`; parts are SQL expressions."""
    joined = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(('0x' || substr(md5({joined}), 1, 8))::BIGINT / 4294967296.0)"

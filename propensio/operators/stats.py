"""Fitted column statistics: exact quantiles that stay distributed.

Spark's exact ``percentile``/``median`` keep every distinct value of a column in
one aggregate buffer, which a global aggregate merges in a single task. For a
high-cardinality column over billions of rows that does not fit. The exact
method here looks for the values at the two ranks around (n-1)·p and narrows a
bracket around each rank until few values are left:

1. one aggregate: count, min, max and ``percentile_approx`` just below and just
   above each wanted probability;
2. one aggregate counts, for every bracket, the rows below it, on its lower end,
   strictly inside and on its upper end. A rank on an end is found. A rank inside with more than
   ``FEW`` rows (and distinct values) is narrowed: ``percentile_approx`` of the rows strictly inside, just
   below and above the rank, and step 2 again. The rows inside shrink to
   about 6/accuracy of their number each time, whatever the values' distribution,
   and a value that many rows share becomes an end and is found there. A rank outside (the sketch missed)
   moves the bracket to that side;
3. the at most ``FEW`` values left inside are counted per value, and a running count
   over them picks the rank. No window or buffer grows with the rows.

The driver interpolates linearly at position (n-1)·p, the same rule as SQL
``quantile_cont`` and Spark ``percentile``; the result equals the latter. One row
per pass and one per rank reach the driver. Null and NaN-free input is the caller's affair: nulls are
left out, a column without values gives None.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns of a numeric type (the reference's ``numeric_only``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _interpolate(lo_v: float | None, hi_v: float | None, lo_i: int, hi_i: int, pos: float) -> float | None:
    if lo_v is None or hi_v is None:
        return None
    if lo_i == hi_i:
        return float(lo_v)
    # Spark's percentile interpolation rule
    return float((hi_i - pos) * lo_v + (pos - lo_i) * hi_v)


#: Values that a bracket may hold when it is sorted.
FEW = 50_000


@dataclass
class _Rank:
    """The search for the value at a 0-based rank of a column; lo <= value <= hi."""

    column: str
    rank: int
    lo: float
    hi: float
    below: int = 0  # rows up to and with lo, once counted
    inside: int = 0
    value: float | None = None


def exact_quantiles(df: DataFrame, requests: dict[str, list[float]], accuracy: int = 100_000, summary: dict | None = None) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles for several columns at once.

    ``requests`` maps column → probabilities. Returns {(column, p): value};
    None for a column with no non-null value. ``summary``, if given, receives
    {(column, "count"|"min"|"max"): value} from the first pass.
    """
    cols = list(requests)
    if not cols:
        return {}
    margin = 3.0 / accuracy
    probes = {c: sorted({min(1.0, max(0.0, p + d)) for p in requests[c] for d in (-margin, margin)}) for c in cols}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.percentile_approx(x, probes[c], accuracy).alias(f"pa{i}")]
    head = df.agg(*aggs).collect()[0]
    ranks: dict[tuple[str, int], _Rank] = {}
    for i, c in enumerate(cols):
        n = head[f"n{i}"]
        if summary is not None:
            summary |= {(c, "count"): n, (c, "min"): head[f"mn{i}"], (c, "max"): head[f"mx{i}"]}
        if not n:
            continue
        near = dict(zip(probes[c], head[f"pa{i}"]))
        for p in requests[c]:
            bracket = near[min(1.0, max(0.0, p - margin))], near[min(1.0, max(0.0, p + margin))]
            for r in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                ranks.setdefault((c, r), _Rank(c, r, *bracket))
    ends = {c: (head[f"mn{i}"], head[f"mx{i}"]) for i, c in enumerate(cols)}
    _search(df, list(ranks.values()), ends, accuracy)
    out: dict[tuple[str, float], float | None] = {}
    for i, c in enumerate(cols):
        for p in requests[c]:
            pos = (head[f"n{i}"] - 1) * p
            if not head[f"n{i}"]:
                out[(c, p)] = None
            else:
                lo, hi = math.floor(pos), math.ceil(pos)
                out[(c, p)] = _interpolate(ranks[(c, lo)].value, ranks[(c, hi)].value, lo, hi, pos)
    return out


def _search(df: DataFrame, open_ranks: list[_Rank], ends: dict[str, tuple[float, float]], accuracy: int) -> None:
    """Fill in ``value`` of every rank."""
    few: list[_Rank] = []
    while open_ranks:
        narrow = []
        for q, (below, at_lo, inside, at_hi) in zip(open_ranks, _count_brackets(df, open_ranks)):
            if q.rank < below:
                q.lo, q.hi = ends[q.column][0], q.lo
            elif q.rank < below + at_lo:
                q.value = q.lo
            elif q.rank < below + at_lo + inside:
                q.below, q.inside = below + at_lo, inside
                (few if inside <= FEW else narrow).append(q)
            elif q.rank < below + at_lo + inside + at_hi:
                q.value = q.hi
            else:
                q.lo, q.hi = q.hi, ends[q.column][1]
        if narrow:
            few += _narrow(df, narrow, accuracy)
        open_ranks = [q for q in open_ranks if q.value is None and not any(q is f for f in few)]
    if few:
        _pick(df, few)


def _count_brackets(df: DataFrame, ranks: list[_Rank]) -> list[tuple[int, int, int, int]]:
    """Rows below each bracket, on its lower end, strictly inside, on its upper end (0 if the ends are equal): one aggregate."""
    aggs = []
    for i, q in enumerate(ranks):
        x, lo, hi = F.col(q.column).cast("double"), F.lit(q.lo), F.lit(q.hi)
        wanted = x < lo, x == lo, (x > lo) & (x < hi), (x == hi) & (hi > lo)
        aggs += [F.count_if(w).alias(f"c{i}_{k}") for k, w in enumerate(wanted)]
    row = df.agg(*aggs).collect()[0]
    return [tuple(row[f"c{i}_{k}"] for k in range(4)) for i in range(len(ranks))]


def _narrow(df: DataFrame, ranks: list[_Rank], accuracy: int) -> list[_Rank]:
    """New brackets from a sketch of the rows strictly inside; returns the ranks whose bracket holds few distinct values."""
    aggs = []
    for i, q in enumerate(ranks):
        x = F.col(q.column).cast("double")
        inside = F.when((x > F.lit(q.lo)) & (x < F.lit(q.hi)), x)
        at = (q.rank - q.below) / q.inside
        probe = [max(0.0, at - 3.0 / accuracy), min(1.0, at + 3.0 / accuracy)]
        aggs += [F.percentile_approx(inside, probe, accuracy).alias(f"p{i}"), F.approx_count_distinct(inside).alias(f"d{i}")]
    row = df.agg(*aggs).collect()[0]
    few = [q for i, q in enumerate(ranks) if row[f"d{i}"] <= FEW // 2]
    for i, q in enumerate(ranks):
        if row[f"d{i}"] > FEW // 2:
            q.lo, q.hi = row[f"p{i}"]
    return few


def _pick(df: DataFrame, ranks: list[_Rank]) -> None:
    """The value at each rank among the few values strictly inside its bracket."""
    entries = []
    for i, q in enumerate(ranks):
        x = F.col(q.column).cast("double")
        entries.append(F.when((x > F.lit(q.lo)) & (x < F.lit(q.hi)), F.struct(F.lit(i).alias("i"), x.alias("v"))))
    inside = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
    counts = inside.groupBy(F.col("e.i").alias("i"), F.col("e.v").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    upto = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.element_at(F.lit([q.rank - q.below for q in ranks]), F.col("i") + 1)
    ranked = counts.withColumn("cum", F.sum("k").over(upto)).where((F.col("cum") > place) & (F.col("cum") - F.col("k") <= place))
    for r in ranked.collect():  # one row a rank
        ranks[r["i"]].value = r["v"]


def spark_exact_quantiles(df: DataFrame, requests: dict[str, list[float]]) -> dict[tuple[str, float], float | None]:
    """Spark's single-buffer exact ``percentile`` (small tables, tests)."""
    aggs = []
    keys = []
    for c, ps in requests.items():
        for p in ps:
            keys.append((c, p))
            aggs.append(F.percentile(F.col(c).cast("double"), F.lit(p)).alias(f"q{len(aggs)}"))
    row = df.agg(*aggs).collect()[0]
    return {k: row[i] for i, k in enumerate(keys)}


def approx_quantiles(df: DataFrame, requests: dict[str, list[float]], accuracy: int = 10_000) -> dict[tuple[str, float], float | None]:
    aggs = []
    keys = []
    for c, ps in requests.items():
        for p in ps:
            keys.append((c, p))
            aggs.append(F.percentile_approx(F.col(c).cast("double"), p, accuracy).alias(f"q{len(aggs)}"))
    row = df.agg(*aggs).collect()[0]
    return {k: (None if row[i] is None else float(row[i])) for i, k in enumerate(keys)}


def quantiles(df: DataFrame, requests: dict[str, list[float]], method: str = "exact", accuracy: int = 100_000):
    if method == "exact":
        return exact_quantiles(df, requests, accuracy)
    if method == "spark_exact":
        return spark_exact_quantiles(df, requests)
    if method == "approx":
        return approx_quantiles(df, requests, accuracy)
    raise ValueError(f"Unknown quantile method '{method}'.")

"""Exact-size stratified hold-out and balanced k-fold assignment.

Contract (the reference draws with seeded numpy shuffles, which no engine can
reproduce; we keep its contract instead of its rows):

* exactly ``test_size`` rows get fold -1, spread over the strata by largest
  remainder (ties by stratum key);
* the other rows get folds 0..k-1, per stratum the counts differ by at most 1;
* the same seed gives the same folds under any partitioning.

Plan shape. A seeded random order inside a stratum is "sort by md5(seed:id),
then id". A plain window over a stratum would run in as many tasks as there are
strata (four), so the rank is assembled from buckets: the first hex digits of
the md5 (an order-preserving prefix) split every stratum into up to 16**B
buckets; a tiny ``(stratum, bucket) → count`` table gives each bucket its rank
offset, and ``row_number`` runs inside ``(stratum, bucket)`` only. The tiny
table is joined back by key; adaptive execution turns that join into a
broadcast when its runtime size is under the threshold (it has at most
strata × 16**B rows).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensio.config import DataSpec, TEST_FOLD
from propensio.functions.features import stratum_key
from propensio.functions.hashing import md5_order_key

_STRATUM = "_stratum"
_OKEY = "_okey"
_BUCKET = "_bucket"


def test_fraction(spec: DataSpec) -> tuple[int, int, bool]:
    """(numerator, denominator, is_fraction) of the hold-out size."""
    if isinstance(spec.test_size, bool):
        raise ValueError("test_size must be a number")
    if isinstance(spec.test_size, int):
        return int(spec.test_size), 1, False
    frac = Fraction(str(spec.test_size))
    if not 0 < frac < 1:
        raise ValueError(f"test_size fraction must be in (0, 1), got {spec.test_size}")
    return frac.numerator, frac.denominator, True


def _n_test_sql(spec: DataSpec) -> str:
    """Hold-out row count as a SQL expression over ``_n`` (all rows)."""
    num, den, is_fraction = test_fraction(spec)
    if not is_fraction:
        return f"CAST({num} AS BIGINT)"
    # ceil(n * num / den) in exact integers (0.2 * 150 is 30.000000000000004 in floats)
    return f"CAST((CAST(_n AS DECIMAL(38,0)) * {num} + {den - 1}) div {den} AS BIGINT)"


def bucket_counts(keyed: DataFrame, partition_col: str = _STRATUM) -> DataFrame:
    """Rows per (stratum, md5 bucket): at most strata × 16**B rows."""
    return keyed.groupBy(partition_col, _BUCKET).agg(F.count(F.lit(1)).alias("_bc"))


def stratum_plan(buckets: DataFrame, spec: DataSpec) -> DataFrame:
    """Per stratum: count, hold-out quota and the offset of its k-fold block.

    Runs on the tiny bucket-count table, re-aggregated to one row per stratum.
    """
    counts = buckets.groupBy(_STRATUM).agg(F.sum("_bc").alias("_c"))
    whole = Window.partitionBy()
    n = F.sum("_c").over(whole)
    t = counts.withColumn("_n", n).withColumn("_ntest", F.expr(_n_test_sql(spec)))
    # c * ntest can pass 2**63 on a very large table: multiply in decimal(38,0)
    prod = "CAST(_c AS DECIMAL(38,0)) * _ntest"
    t = t.withColumn("_base", F.expr(f"CAST(({prod}) div _n AS BIGINT)"))
    t = t.withColumn("_rem", F.expr(f"CAST(({prod}) % _n AS BIGINT)"))
    t = t.withColumn("_extra", F.col("_ntest") - F.sum("_base").over(whole))
    by_rem = Window.orderBy(F.col("_rem").desc(), F.col(_STRATUM))
    t = t.withColumn("_quota", F.col("_base") + F.when(F.row_number().over(by_rem) <= F.col("_extra"), 1).otherwise(0))
    before = Window.orderBy(_STRATUM).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_fold_off", F.coalesce(F.sum(F.col("_c") - F.col("_quota")).over(before), F.lit(0)))
    return t.select(_STRATUM, "_c", "_n", "_ntest", "_quota", "_fold_off")


def _with_keys(df: DataFrame, spec: DataSpec) -> DataFrame:
    okey = md5_order_key(spec.seed, spec.id_col)
    return (
        df.withColumn(_STRATUM, stratum_key(list(spec.target_cols)))
        .withColumn(_OKEY, okey)
        .withColumn(_BUCKET, F.substring(F.col(_OKEY), 1, spec.rank_buckets_hex))
    )


def seeded_rank(df: DataFrame, spec: DataSpec, partition_col: str = _STRATUM, buckets: DataFrame | None = None) -> DataFrame:
    """Add ``_rank``: 1-based position in md5(seed:id), id order within a stratum.

    Computed per (stratum, bucket) plus a bucket offset, so the work spreads
    over up to strata × 16**B tasks instead of one per stratum.
    """
    if buckets is None:
        buckets = bucket_counts(df, partition_col)
    earlier = Window.partitionBy(partition_col).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_boff", F.coalesce(F.sum("_bc").over(earlier), F.lit(0))).drop("_bc")
    joined = df.join(offsets, [partition_col, _BUCKET], "inner")
    inside = Window.partitionBy(partition_col, _BUCKET).orderBy(_OKEY, spec.id_col)
    return joined.withColumn("_rank", F.col("_boff") + F.row_number().over(inside)).drop("_boff")


def assign_folds(df: DataFrame, spec: DataSpec = DataSpec()) -> DataFrame:
    """Add the fold column: -1 = blind test, 0..k-1 = cross-validation folds.

    The helper columns (stratum key, md5 key, bucket, rank) never leave this
    function. Output keeps the input columns and order, plus the fold column.
    """
    if spec.n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    cols = [c for c in df.columns if c != spec.fold_col]
    keyed = _with_keys(df.select(*cols), spec)
    buckets = bucket_counts(keyed)
    plan = stratum_plan(buckets, spec)
    ranked = seeded_rank(keyed, spec, buckets=buckets)
    with_plan = ranked.join(plan.select(_STRATUM, "_quota", "_fold_off"), _STRATUM, "inner")
    k = spec.n_splits
    fold = (
        F.when(F.col("_rank") <= F.col("_quota"), F.lit(TEST_FOLD))
        .otherwise((F.col("_fold_off") + F.col("_rank") - F.col("_quota") - 1) % k)
        .cast("int")
    )
    return with_plan.select(*[F.col(c) for c in cols], fold.alias(spec.fold_col))


def assign_label_folds(df: DataFrame, label_col: str, n_splits: int = 5, seed: int = 42, id_col: str = "ID") -> DataFrame:
    """Stratified k-fold on one label (trial scoring), no hold-out: ``_cv_fold``."""
    spec = DataSpec(id_col=id_col, target_cols=(label_col,), test_size=0, n_splits=n_splits, seed=seed)
    keyed = _with_keys(df, spec)
    buckets = bucket_counts(keyed)
    ranked = seeded_rank(keyed, spec, buckets=buckets)
    counts = buckets.groupBy(_STRATUM).agg(F.sum("_bc").alias("_c"))
    before = Window.orderBy(_STRATUM).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_fold_off", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    out = ranked.join(offs, _STRATUM, "inner")
    fold = ((F.col("_fold_off") + F.col("_rank") - 1) % n_splits).cast("int")
    return out.withColumn("_cv_fold", fold).drop(_STRATUM, _OKEY, _BUCKET, "_rank", "_fold_off")


# ---------------------------------------------------------------------------
# Views over the frozen table
# ---------------------------------------------------------------------------

def train_val_block(df: DataFrame, spec: DataSpec = DataSpec()) -> DataFrame:
    return df.where(F.col(spec.fold_col) >= 0)


def test_block(df: DataFrame, spec: DataSpec = DataSpec()) -> DataFrame:
    return df.where(F.col(spec.fold_col) == TEST_FOLD)


def splits(df: DataFrame, spec: DataSpec = DataSpec()) -> tuple[DataFrame, DataFrame]:
    return train_val_block(df, spec), test_block(df, spec)


def cv_fold(df: DataFrame, fold_id: int, spec: DataSpec = DataSpec()) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of one CV fold; fold_id outside [0, k) is an error."""
    if fold_id not in range(spec.n_splits):
        raise ValueError(f"fold_id must be in [0, {spec.n_splits}), got {fold_id}.")
    f = F.col(spec.fold_col)
    return df.where((f >= 0) & (f != fold_id)), df.where(f == fold_id)


def split_xy(df: DataFrame, target: str, spec: DataSpec = DataSpec(), keep_id: bool = True) -> DataFrame:
    """Features + ``label`` in one frame: drop fold and every target present.

    Spark rows have no position, so the id stays as the row key (outside the
    feature list). Unknown target → KeyError.
    """
    if target not in df.columns:
        raise KeyError(f"no label column {target}")
    drop = [c for c in (spec.fold_col, *spec.target_cols) if c in df.columns]
    keep = [c for c in df.columns if c not in drop and (keep_id or c != spec.id_col)]
    return df.select(*keep, F.col(target).cast("int").alias("label"))

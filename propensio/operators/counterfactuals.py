"""Counterfactual recourse by seeded random search.

For every query client (e.g. every rejected one), ``n_candidates`` candidates
are drawn: each varied feature is either kept or replaced by a uniform value
inside the training range (rounded like the column). The engineered features
are recomputed with the fitted feature model, the candidates are scored, those
reaching the wanted class are kept and the best ``k`` per client are chosen by
(number of changed features, range-scaled L1 distance, candidate number).

Plan: ``explode(sequence(1, n))`` is a narrow, per-row expansion; the only
shuffle is the top-k window, partitioned by client id with exactly
``n_candidates`` rows per client, so no group can grow with the data. The
randomness is md5(seed:kind:id:candidate:feature), independent of
partitioning.

``generate`` is one such round and leaves out clients without a flip. ``generate_complete``
draws further rounds (the next candidate numbers) for the clients still open, at
most ``MAX_ROUNDS`` in all, and keeps those that stay open with ``n_found`` = 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensio.functions.hashing import md5_uniform
from propensio.session import materialize

# What the reference lets vary and treats as continuous.
FEATURES_TO_VARY = ("Income", "Wealth", "FamilyMembers")
CONTINUOUS_FEATURES = ("Age", "Income", "Wealth", "FamilyMembers")
INTEGER_FEATURES = {"Age", "FamilyMembers", "Gender", "FinancialEducation", "RiskPropensity"}
VALUE_DIGITS = 2
#: Rounds of n_candidates draws after which a client is reported as open.
MAX_ROUNDS = 10


def training_ranges(train: DataFrame, features: tuple[str, ...] = FEATURES_TO_VARY) -> dict[str, tuple[float, float]]:
    """Min and max of each varied feature on the training rows (one aggregate)."""
    aggs = []
    for c in features:
        aggs += [F.min(F.col(c).cast("double")).alias(f"mn_{c}"), F.max(F.col(c).cast("double")).alias(f"mx_{c}")]
    row = train.agg(*aggs).collect()[0]
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in features}


def candidates(queries: DataFrame, ranges: dict[str, tuple[float, float]], n_candidates: int = 200,
               seed: int = 42, id_col: str = "ID", features: tuple[str, ...] | None = None, first: int = 1) -> DataFrame:
    """Query rows × candidates (numbers from ``first``) with varied base columns, #changed and distance."""
    feats = tuple(features or ranges)
    out = queries.select("*", F.explode(F.sequence(F.lit(first), F.lit(first + n_candidates - 1))).alias("cand"))
    n_changed: Column = F.lit(0)
    distance: Column = F.lit(0.0)
    new_cols = {}
    for f in feats:
        lo, hi = ranges[f]
        old = F.col(f)
        if lo is None:
            new_cols[f] = old
            continue
        u_mask = md5_uniform(seed, "m", F.col(id_col), F.col("cand"), f)
        u_val = md5_uniform(seed, "v", F.col(id_col), F.col("cand"), f)
        drawn = F.lit(float(lo)) + u_val * F.lit(float(hi - lo))
        if f in INTEGER_FEATURES:
            drawn = F.round(drawn).cast(queries.schema[f].dataType)
        else:
            drawn = F.round(drawn, VALUE_DIGITS).cast(queries.schema[f].dataType)
        new = F.when(u_mask < 0.5, drawn).otherwise(old)
        new_cols[f] = new
        changed = ~new.eqNullSafe(old)
        span = float(hi - lo)
        step = F.abs(new.cast("double") - old.cast("double")) / F.lit(span) if span > 0 else F.lit(None).cast("double")
        n_changed = n_changed + changed.cast("int")
        distance = distance + F.when(changed, F.coalesce(step, F.lit(1.0))).otherwise(F.lit(0.0))
    keep = [F.col(c) for c in out.columns if c not in new_cols]
    return out.select(*keep, *[e.alias(f) for f, e in new_cols.items()], n_changed.alias("n_changed"), distance.alias("distance"))


def score_keeping_inputs(cand: DataFrame, transform: Callable[[DataFrame], DataFrame], base_cols: list[str]) -> DataFrame:
    """Apply ``transform`` (features → score) but keep the candidate's raw values.

    The feature model imputes and replaces the base columns; a counterfactual
    reports the values a client would have, so the raw ones are carried over.
    """
    present = [c for c in base_cols if c in cand.columns]
    carried = cand.select("*", *[F.col(c).alias(f"_raw_{c}") for c in present])
    out = transform(carried)
    keep = [c for c in out.columns if c not in present and not c.startswith("_raw_")]
    return out.select(*keep, *[F.col(f"_raw_{c}").alias(c) for c in present])


def best_counterfactuals(scored: DataFrame, desired: Column, k: int = 3, id_col: str = "ID") -> DataFrame:
    """X8 + X9: keep candidates of the wanted class, best k per query row."""
    kept = scored.where(desired)
    order = Window.partitionBy(id_col).orderBy("n_changed", "distance", "cand")
    ranked = kept.withColumn("cf_rank", F.row_number().over(order))
    return ranked.where(F.col("cf_rank") <= k)


def desired_mask(desired_class, score_col: str = "score", original_col: str | None = "orig_prediction", threshold: float = 0.5) -> Column:
    """'opposite' (flip the original prediction), 0 or 1."""
    pred = (F.col(score_col) >= F.lit(threshold)).cast("int")
    if desired_class == "opposite":
        return pred != F.col(original_col)
    return pred == F.lit(int(desired_class))


def generate(queries: DataFrame, ranges: dict, score_fn: Callable[[DataFrame], DataFrame], k: int = 3,
             n_candidates: int = 200, desired_class="opposite", seed: int = 42, id_col: str = "ID",
             threshold: float = 0.5, features: tuple[str, ...] | None = None, first: int = 1) -> DataFrame:
    """X7-X9 end to end, one round of candidates (numbers from ``first``). ``score_fn`` recomputes features and adds ``score``.

    ``queries`` must carry ``orig_prediction`` when desired_class='opposite'.
    """
    cand = candidates(queries, ranges, n_candidates, seed, id_col, features, first)
    scored = score_fn(cand)
    return best_counterfactuals(scored, desired_mask(desired_class, "score", "orig_prediction", threshold), k, id_col)


def generate_complete(queries: DataFrame, ranges: dict, score_fn: Callable[[DataFrame], DataFrame], k: int = 3,
                      n_candidates: int = 200, desired_class="opposite", seed: int = 42, id_col: str = "ID",
                      threshold: float = 0.5, features: tuple[str, ...] | None = None, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Every query client: its best k of the first round that flips any, else one row of nulls.

    Adds ``n_found`` (counterfactuals of the client, 0 when open) and ``n_drawn`` (candidates
    drawn for it).
    """
    feats = tuple(features or ranges)
    columns = [id_col, "cf_rank", "cand", *feats, "n_changed", "distance", "score"]
    open_ids = materialize(queries.select(id_col), "cf-open")
    rounds = []
    for done in range(max_rounds):
        left = queries.join(open_ids, id_col, "left_semi")
        best = generate(left, ranges, score_fn, k, n_candidates, desired_class, seed, id_col, threshold, feats, done * n_candidates + 1)
        best = materialize(best.select(*columns).withColumn("n_drawn", F.lit((done + 1) * n_candidates)), "cf-round")
        rounds.append(best)
        open_ids = materialize(open_ids.join(best.select(id_col), id_col, "left_anti"), "cf-open")
        if open_ids.isEmpty():
            break
    found = rounds[0]
    for part in rounds[1:]:
        found = found.unionByName(part)
    found = found.withColumn("n_found", F.count(F.lit(1)).over(Window.partitionBy(id_col)))  # at most k rows each
    nothing = open_ids.withColumn("n_drawn", F.lit(max_rounds * n_candidates)).withColumn("n_found", F.lit(0).cast("long"))
    return found.unionByName(nothing, allowMissingColumns=True)

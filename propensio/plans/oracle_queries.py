"""Oracle SQL text per registered query name."""

from __future__ import annotations

from propensio.functions.hashing import md5_uniform_sql
from propensio.functions.scores import PROBE_TERMS, probe_score_sql
from propensio.plans.oracle import (
    BASE,
    features_select,
    matrix2_cte,
    metrics_sql,
    FEATURES,
    INT_FEATURES,
    R,
    folds_ctes,
    matrix_cte,
    rounded,
    stats_cte,
)
from propensio.sources.tables import CLIENTS_SQL

_TV = "stratified_fold >= 0"
_TEST = "stratified_fold = -1"

ORACLE: dict[str, str] = {}

ORACLE["clients_view"] = "WITH " + CLIENTS_SQL + "\nSELECT * FROM clients"

ORACLE["typed_csv_clients"] = ORACLE["clients_view"]

ORACLE["label_folds"] = folds_ctes() + """,
_l AS (SELECT ID, CAST(IncomeInvestment AS INTEGER) AS label, _okey FROM folded JOIN (SELECT ID, _okey FROM _k) USING (ID) WHERE stratified_fold >= 0),
_lr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY _okey, ID) AS _rank FROM _l),
_lc AS (SELECT label, count(*) AS _c FROM _l GROUP BY label),
_lo AS (SELECT label, coalesce(sum(_c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _off FROM _lc)
SELECT ID, label, CAST((_off + _rank - 1) % 5 AS INTEGER) AS fold FROM _lr JOIN _lo USING (label)"""

ORACLE["freeze_folds"] = folds_ctes() + "\nSELECT * FROM folded"

ORACLE["fold_counts"] = folds_ctes() + """
SELECT stratified_fold, count(*) AS n,
       CAST(sum(AccumulationInvestment) AS BIGINT) AS n_pos_AccumulationInvestment,
       CAST(sum(IncomeInvestment) AS BIGINT) AS n_pos_IncomeInvestment
FROM folded GROUP BY stratified_fold"""

ORACLE["split_counts"] = folds_ctes() + """
SELECT count(*) AS n_total,
       count(*) FILTER (WHERE stratified_fold = -5) AS n_unassigned,
       count(*) FILTER (WHERE stratified_fold = -1) AS n_test,
       count(*) FILTER (WHERE stratified_fold >= 0) AS n_train_val
FROM folded"""

ORACLE["parity_report"] = folds_ctes() + f""",
rates AS (
  SELECT stratified_fold AS fold, 'AccumulationInvestment' AS target, avg(AccumulationInvestment) AS rate FROM folded GROUP BY 1
  UNION ALL
  SELECT stratified_fold AS fold, 'IncomeInvestment' AS target, avg(IncomeInvestment) AS rate FROM folded GROUP BY 1),
t AS (SELECT target, rate AS test_rate FROM rates WHERE fold = -1)
SELECT r.target, CAST(r.fold AS INTEGER) AS fold, round(r.rate, {R}) AS rate, round(t.test_rate, {R}) AS test_rate,
       round(abs(r.rate - t.test_rate), {R}) AS delta, abs(r.rate - t.test_rate) < 0.05 AS ok
FROM rates r LEFT JOIN t USING (target) WHERE r.fold >= 0"""

ORACLE["duplicate_ids"] = "WITH " + CLIENTS_SQL + """,
per_id AS (SELECT ID, count(*) AS n FROM clients GROUP BY ID)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_ids, count(*) FILTER (WHERE n > 1) AS n_duplicated_ids FROM per_id"""

_XY = "ID, " + ", ".join(BASE) + ", CAST(IncomeInvestment AS INTEGER) AS label"
ORACLE["train_block"] = folds_ctes() + f"\nSELECT {_XY} FROM folded WHERE {_TV}"
ORACLE["test_block"] = folds_ctes() + f"\nSELECT {_XY} FROM folded WHERE {_TEST}"

ORACLE["cv_fold_2"] = folds_ctes() + """
SELECT ID, CASE WHEN stratified_fold = 2 THEN 'val' ELSE 'train' END AS role, CAST(IncomeInvestment AS INTEGER) AS label
FROM folded WHERE stratified_fold >= 0"""

ORACLE["fitted_stats"] = folds_ctes() + stats_cte() + "\nSELECT " + ", ".join(
    f"round(med_{c}, {R}) AS med_{c}" for c in BASE
) + f", round(p99_inc, {R}) AS p99_inc, round(p99_wth, {R}) AS p99_wth, round(inc_max, {R}) AS inc_max FROM st"

_FM_COLS = "ID, " + rounded(FEATURES, INT_FEATURES) + ", label"
ORACLE["feature_matrix_train"] = matrix_cte() + f"\nSELECT {_FM_COLS} FROM fm WHERE {_TV}"
ORACLE["feature_matrix_test"] = matrix_cte() + f"\nSELECT {_FM_COLS} FROM fm WHERE {_TEST}"

ORACLE["age_brackets"] = "WITH " + CLIENTS_SQL + """
SELECT ID, Age,
       CAST(coalesce(CAST((Age > 17 AND Age <= 35) AS INTEGER), 0) AS INTEGER) AS Age_bracket_Young,
       CAST(coalesce(CAST((Age > 35 AND Age <= 55) AS INTEGER), 0) AS INTEGER) AS Age_bracket_Mid,
       CAST(coalesce(CAST((Age > 55 AND Age <= 100) AS INTEGER), 0) AS INTEGER) AS Age_bracket_Senior
FROM clients"""

ORACLE["metrics_by_target"] = matrix2_cte() + f""",
_sc AS (SELECT *, {probe_score_sql()} AS score FROM fm2 WHERE stratified_fold = -1),
scored AS (
  SELECT 'AccumulationInvestment' AS target, score, CAST(AccumulationInvestment AS INTEGER) AS label FROM _sc
  UNION ALL
  SELECT 'IncomeInvestment' AS target, score, CAST(IncomeInvestment AS INTEGER) AS label FROM _sc)""" + metrics_sql("scored", "target")

ORACLE["auc_by_fold"] = matrix_cte() + f""",
scored AS (SELECT stratified_fold AS fold, {probe_score_sql()} AS score, label FROM fm WHERE stratified_fold >= 0)""" + metrics_sql(
    "scored", "fold"
)

_SCALE = ", ".join(
    f"CAST(min({c}) AS DOUBLE) AS mn_{c}, CAST(max({c}) AS DOUBLE) AS mx_{c}" for c in FEATURES
)
_SCALED = ", ".join(
    f"round((CAST(fm.{c} AS DOUBLE) - mm.mn_{c}) / (CASE WHEN mm.mx_{c} = mm.mn_{c} THEN 1.0 ELSE mm.mx_{c} - mm.mn_{c} END), {R}) AS {c}"
    for c in FEATURES
)
ORACLE["minmax_scaled"] = matrix_cte() + f""",
mm AS (SELECT {_SCALE} FROM fm WHERE stratified_fold >= 0)
SELECT fm.ID, {_SCALED}, fm.label FROM fm CROSS JOIN mm WHERE fm.stratified_fold = -1"""

ORACLE["isotonic_calibration"] = matrix_cte() + f""",
g AS (SELECT round({probe_score_sql()}, 2) AS raw_score, sum(label) AS pos, count(*) AS cnt
      FROM fm WHERE stratified_fold >= 0 GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY raw_score) AS i,
             sum(pos) OVER (ORDER BY raw_score) AS cpos, sum(cnt) OVER (ORDER BY raw_score) AS ccnt FROM g),
ab AS (SELECT a.i AS a, b.i AS b, CAST(b.cpos - a.cpos + a.pos AS DOUBLE) / CAST(b.ccnt - a.ccnt + a.cnt AS DOUBLE) AS m
       FROM o a JOIN o b ON a.i <= b.i),
per AS (SELECT o.i, o.raw_score, a, min(m) AS mn FROM o JOIN ab ON ab.a <= o.i AND ab.b >= o.i GROUP BY o.i, o.raw_score, a)
SELECT round(raw_score, {R}) AS raw_score, round(max(mn), {R}) AS score FROM per GROUP BY raw_score"""

_LOGIT = " + ".join(f"({w}) * (coalesce({n}, {c}) - {c})" for n, c, w in PROBE_TERMS)

# every distinct score: the largest over a <= i of the smallest over b >= i of the mean label of scores a to b
ORACLE["isotonic_calibration_unrounded"] = matrix_cte() + f""",
g AS (SELECT 1.0 / (1.0 + exp(-({_LOGIT}))) AS raw_score, sum(label) AS pos, count(*) AS cnt FROM fm WHERE stratified_fold >= 0 GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY raw_score) AS i,
             sum(pos) OVER (ORDER BY raw_score) AS cpos, sum(cnt) OVER (ORDER BY raw_score) AS ccnt FROM g),
ab AS (SELECT a.i AS a, b.i AS b, CAST(b.cpos - a.cpos + a.pos AS DOUBLE) / CAST(b.ccnt - a.ccnt + a.cnt AS DOUBLE) AS m
       FROM o a JOIN o b ON a.i <= b.i),
low AS (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS m FROM ab),
fit AS (SELECT b AS i, max(m) AS score FROM low GROUP BY b)
SELECT round(raw_score, {R}) AS raw_score, round(score, {R}) AS score FROM o JOIN fit USING (i)"""

_ST_TEST = folds_ctes() + stats_cte() + f""",
tb AS (SELECT * FROM folded WHERE stratified_fold = -1),
tf AS (SELECT f.ID, {features_select('f')} FROM tb f CROSS JOIN st),
ts AS (SELECT tb.ID, {', '.join('tb.' + c for c in BASE)}, {probe_score_sql('tf')} AS score FROM tb JOIN tf USING (ID))"""

ORACLE["rejected_clients"] = _ST_TEST + "\nSELECT ID, " + ", ".join(BASE) + " , score FROM ts WHERE score < 0.5"

ORACLE["hard_predictions"] = _ST_TEST + """
SELECT ID, score, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM ts"""

_VARY = ("Income", "Wealth", "FamilyMembers")


def _cf_value(c: str) -> str:
    u_mask = md5_uniform_sql("42", "'m'", "r.ID", "t.cand", f"'{c}'")
    u_val = md5_uniform_sql("42", "'v'", "r.ID", "t.cand", f"'{c}'")
    drawn = f"(rg.mn_{c} + {u_val} * (rg.mx_{c} - rg.mn_{c}))"
    if c == "FamilyMembers":
        drawn = f"CAST(round({drawn}) AS INTEGER)"
    else:
        drawn = f"CAST(round({drawn}, 2) AS DOUBLE)"
    return f"CASE WHEN {u_mask} < 0.5 THEN {drawn} ELSE r.{c} END"


def _cf_base(last: int) -> str:
    """Candidates 1 to ``last`` of every rejected client, scored."""
    return _ST_TEST + f""",
rg AS (SELECT {', '.join(f'CAST(min({c}) AS DOUBLE) AS mn_{c}, CAST(max({c}) AS DOUBLE) AS mx_{c}' for c in _VARY)}
       FROM folded WHERE stratified_fold >= 0),
r AS (SELECT * FROM ts WHERE score < 0.5),
c0 AS (SELECT r.ID, CAST(t.cand AS INTEGER) AS cand, {', '.join('r.' + c for c in BASE if c not in _VARY)},
              {', '.join(f'{_cf_value(c)} AS {c}' for c in _VARY)},
              {', '.join(f'r.{c} AS old_{c}' for c in _VARY)},
              {', '.join(f'rg.mx_{c} - rg.mn_{c} AS span_{c}' for c in _VARY)}
       FROM r CROSS JOIN range(1, {last + 1}) t(cand) CROSS JOIN rg),
c1 AS (SELECT *,
              {' + '.join(f'CAST({c} IS DISTINCT FROM old_{c} AS INTEGER)' for c in _VARY)} AS n_changed,
              {' + '.join(f'(CASE WHEN {c} IS DISTINCT FROM old_{c} THEN coalesce(abs(CAST({c} AS DOUBLE) - CAST(old_{c} AS DOUBLE)) / nullif(span_{c}, 0), 1.0) ELSE 0.0 END)' for c in _VARY)} AS distance
       FROM c0),
cf AS (SELECT f.ID, f.cand, f.Income AS v_Income, f.Wealth AS v_Wealth, f.FamilyMembers AS v_FamilyMembers, f.n_changed, f.distance,
              {features_select('f')}
       FROM c1 f CROSS JOIN st),
cs AS (SELECT ID, cand, v_Income AS Income, v_Wealth AS Wealth, v_FamilyMembers AS FamilyMembers, n_changed, distance,
              {probe_score_sql('cf')} AS score
       FROM cf)"""

_CF_BASE = _cf_base(200)

ORACLE["cf_candidates"] = _CF_BASE + f"""
SELECT ID, cand, round(Income, {R}) AS Income, round(Wealth, {R}) AS Wealth, FamilyMembers, n_changed,
       round(distance, {R}) AS distance, round(score, {R}) AS score
FROM cs WHERE score >= 0.5"""

ORACLE["counterfactuals"] = _CF_BASE + f""",
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY ID ORDER BY n_changed, distance, cand) AS INTEGER) AS cf_rank FROM cs WHERE score >= 0.5)
SELECT ID, cf_rank, cand, round(Income, {R}) AS Income, round(Wealth, {R}) AS Wealth, FamilyMembers, n_changed,
       round(distance, {R}) AS distance, round(score, {R}) AS score
FROM rk WHERE cf_rank <= 3"""

# ten rounds of 200; a client's counterfactuals come from the first round that flips any
ORACLE["counterfactuals_complete"] = _cf_base(2000) + f""",
hits AS (SELECT *, CAST((cand - 1) // 200 AS INTEGER) AS rnd FROM cs WHERE score >= 0.5),
firsts AS (SELECT *, min(rnd) OVER (PARTITION BY ID) AS first_rnd FROM hits),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY ID ORDER BY n_changed, distance, cand) AS INTEGER) AS cf_rank FROM firsts WHERE rnd = first_rnd),
best AS (SELECT *, count(*) OVER (PARTITION BY ID) AS n_found FROM rk WHERE cf_rank <= 3)
SELECT ID, cf_rank, cand, round(Income, {R}) AS Income, round(Wealth, {R}) AS Wealth, FamilyMembers, n_changed, round(distance, {R}) AS distance,
       round(score, {R}) AS score, CAST((rnd + 1) * 200 AS INTEGER) AS n_drawn, n_found FROM best
UNION ALL
SELECT ID, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 2000, 0 FROM r WHERE ID NOT IN (SELECT ID FROM hits)"""

import itertools as _it

_PAIR = {}
for _a, _b in _it.combinations(BASE, 2):
    _PAIR[f"{_a}_plus_{_b}"] = f"(CAST({_a} AS DOUBLE) + CAST({_b} AS DOUBLE))"
    _PAIR[f"{_a}_times_{_b}"] = f"(CAST({_a} AS DOUBLE) * CAST({_b} AS DOUBLE))"
for _a, _b in _it.permutations(BASE, 2):
    _PAIR[f"{_a}_div_{_b}"] = f"(CAST({_a} AS DOUBLE) / nullif(CAST({_b} AS DOUBLE), 0.0))"

ORACLE["pairwise_features"] = matrix_cte() + "\nSELECT ID, " + ", ".join(
    f"CASE WHEN abs({e}) >= 1e9 THEN {e} ELSE round({e}, {R}) END AS {n}" for n, e in _PAIR.items()) + f" FROM fm WHERE {_TEST}"


def _pct(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE round((rank() OVER (ORDER BY {c}) - 1 + "
            f"(count(*) OVER (PARTITION BY {c}) + 1) / 2.0) / count({c}) OVER (), {R}) END AS {c}_percentile")


ORACLE["percentile_feature"] = matrix_cte() + f"""
SELECT ID, {_pct('Income')}, {_pct('Wealth')} FROM fm WHERE {_TV}"""

_ENGINEERED = FEATURES[len(BASE):]
_CORR_PAIRS = [(g, r) for g in _PAIR for r in _ENGINEERED]
_GEN = ", ".join(f"{e} AS {n}" for n, e in _PAIR.items())


def _corr(g: str, r: str) -> str:
    return (f"covar_pop(CAST({g} AS DOUBLE), CAST({r} AS DOUBLE)) / nullif(stddev_pop(CAST({g} AS DOUBLE)) * "
            f"stddev_pop(CAST({r} AS DOUBLE)), 0.0)")


_CORR_AGG = ", ".join(f"{_corr(g, r)} AS c{i}" for i, (g, r) in enumerate(_CORR_PAIRS))
_CORR_ROWS = "\nUNION ALL\n".join(
    "SELECT '{g}' AS feature, greatest({cols}) AS m FROM cc".format(
        g=g, cols=", ".join(f"abs(c{i})" for i, (gg, _r) in enumerate(_CORR_PAIRS) if gg == g))
    for g in _PAIR)
ORACLE["corr_dedup"] = matrix_cte() + f""",
gen AS (SELECT *, {_GEN} FROM fm WHERE {_TV}),
cc AS (SELECT {_CORR_AGG} FROM gen),
mx AS ({_CORR_ROWS})
SELECT feature, round(m, {R}) AS max_abs_corr, CASE WHEN m IS NOT NULL AND m > 0.9 THEN false ELSE true END AS kept FROM mx"""

"""The oracle side: the same queries as plain SQL (DuckDB dialect).

Each text runs on the driver tables registered as views. They restate the
semantics independently of the DataFrame code, in the simplest form (global
windows, exact aggregates), so a difference points at a planning bug.
"""

from __future__ import annotations

from propensio.sources.tables import CLIENTS_SQL

SEED = 42
K = 5
TEST_NUM, TEST_DEN = 1, 5
R = 6  # report precision of double columns

BASE = ["Age", "Gender", "FamilyMembers", "FinancialEducation", "RiskPropensity", "Income", "Wealth"]


def folds_ctes(seed: int = SEED, k: int = K, num: int = TEST_NUM, den: int = TEST_DEN) -> str:
    return "WITH " + CLIENTS_SQL + f""",
_k AS (SELECT *, md5('{seed}:' || CAST(ID AS VARCHAR)) AS _okey,
              CAST(AccumulationInvestment AS VARCHAR) || '_' || CAST(IncomeInvestment AS VARCHAR) AS _stratum
       FROM clients),
_r AS (SELECT *, row_number() OVER (PARTITION BY _stratum ORDER BY _okey, ID) AS _rank FROM _k),
_s AS (SELECT _stratum, count(*) AS _c FROM _k GROUP BY _stratum),
_t AS (SELECT _stratum, _c, sum(_c) OVER () AS _n FROM _s),
_t2 AS (SELECT *, (_n * {num} + {den - 1}) // {den} AS _ntest FROM _t),
_t3 AS (SELECT *, (_c * _ntest) // _n AS _base, (_c * _ntest) % _n AS _rem FROM _t2),
_t4 AS (SELECT *, _ntest - sum(_base) OVER () AS _extra,
               row_number() OVER (ORDER BY _rem DESC, _stratum) AS _rr FROM _t3),
_q AS (SELECT _stratum, _c, _base + CASE WHEN _rr <= _extra THEN 1 ELSE 0 END AS _quota FROM _t4),
_q2 AS (SELECT _stratum, _quota,
               coalesce(sum(_c - _quota) OVER (ORDER BY _stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _fold_off
        FROM _q),
folded AS (
  SELECT ID, Age, Gender, FamilyMembers, FinancialEducation, RiskPropensity, Income, Wealth,
         AccumulationInvestment, IncomeInvestment,
         CAST(CASE WHEN _rank <= _quota THEN -1 ELSE (_fold_off + _rank - _quota - 1) % {k} END AS INTEGER) AS stratified_fold
  FROM _r JOIN _q2 USING (_stratum))"""


def stats_cte(source: str = "folded", where: str = "stratified_fold >= 0") -> str:
    meds = ",\n         ".join(f"CAST(median({c}) AS DOUBLE) AS med_{c}" for c in BASE)
    return f""",
st AS (
  SELECT {meds},
         CAST(quantile_cont(Income, 0.99) AS DOUBLE) AS p99_inc,
         CAST(quantile_cont(Wealth, 0.99) AS DOUBLE) AS p99_wth,
         CAST(max(Income) AS DOUBLE) AS inc_max
  FROM {source} WHERE {where})"""


def log1p(x: str) -> str:
    return f"(CASE WHEN ({x}) > -1 THEN ln(1 + ({x})) END)"


def features_select(src_alias: str = "f") -> str:
    """The 16 feature expressions over a row of ``f`` joined with ``st``."""
    imp = {c: f"coalesce(CAST({src_alias}.{c} AS DOUBLE), st.med_{c})" for c in BASE}
    ci = f"(CASE WHEN {imp['Income']} > st.p99_inc THEN st.p99_inc ELSE {imp['Income']} END)"
    cw = f"(CASE WHEN {imp['Wealth']} > st.p99_wth THEN st.p99_wth ELSE {imp['Wealth']} END)"
    age = imp["Age"]
    adult = f"(CASE WHEN {age} - 17 < 1 THEN 1.0 ELSE {age} - 17 END)"
    safe_fm = f"coalesce(nullif({imp['FamilyMembers']}, 0.0), coalesce(st.med_FamilyMembers, 1.0))"
    exprs = [f"{imp[c]} AS {c}" for c in BASE]
    exprs += [
        f"{log1p(imp['Wealth'])} AS Wealth_log",
        f"{log1p(imp['Income'])} AS Income_log",
        f"{log1p(f'{cw} / {adult}')} AS Wealth_Age_Ratio_log",
        f"{cw} / nullif({safe_fm}, 0) AS Wealth_per_person",
        f"{ci} / nullif({safe_fm}, 0) AS Income_per_person",
        f"{log1p(f'coalesce({ci} / nullif({cw}, 0), st.inc_max)')} AS Income_Wealth_Ratio_log",
    ]
    for label, lo, hi in (("Young", 17, 35), ("Mid", 35, 55), ("Senior", 55, 100)):
        exprs.append(f"CAST(coalesce(CAST(({age} > {lo} AND {age} <= {hi}) AS INTEGER), 0) AS INTEGER) AS Age_bracket_{label}")
    return ",\n       ".join(exprs)


FEATURES = BASE + [
    "Wealth_log", "Income_log", "Wealth_Age_Ratio_log", "Wealth_per_person", "Income_per_person",
    "Income_Wealth_Ratio_log", "Age_bracket_Young", "Age_bracket_Mid", "Age_bracket_Senior",
]
INT_FEATURES = {"Age_bracket_Young", "Age_bracket_Mid", "Age_bracket_Senior"}


def rounded(cols: list[str], ints: set[str] = frozenset(), digits: int = R) -> str:
    return ", ".join(c if c in ints else f"round({c}, {digits}) AS {c}" for c in cols)


def matrix_cte(target: str = "IncomeInvestment") -> str:
    """``fm``: ID, fold, the 16 features and the label, for every row."""
    return folds_ctes() + stats_cte() + f""",
fm AS (
  SELECT f.ID, f.stratified_fold, {features_select('f')},
         CAST(f.{target} AS INTEGER) AS label
  FROM folded f CROSS JOIN st)"""


def matrix2_cte() -> str:
    """``fm2``: like ``fm`` with both labels kept (no ``label`` column)."""
    return folds_ctes() + stats_cte() + f""",
fm2 AS (
  SELECT f.ID, f.stratified_fold, {features_select('f')},
         f.AccumulationInvestment, f.IncomeInvestment
  FROM folded f CROSS JOIN st)"""


def metrics_sql(scored: str, group: str) -> str:
    """Five metrics per ``group`` over a CTE ``scored`` (group, score, label)."""
    return f""",
_per AS (SELECT {group}, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM {scored} GROUP BY {group}, score),
_pb AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM _per),
_auc AS (SELECT {group},
                CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                     THEN CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) END AS auc
         FROM _pb GROUP BY {group}),
_conf AS (SELECT {group}, avg(power(score - label, 2)) AS brier,
                 count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
                 count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
                 count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn
          FROM {scored} GROUP BY {group})
SELECT {group},
       round(_auc.auc, 4) AS ROC_AUC,
       round(brier, 4) AS Brier_Score,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 4) AS Precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 4) AS Recall,
       round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS F1_Score
FROM _auc JOIN _conf USING ({group})"""

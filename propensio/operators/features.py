"""Leak-free feature transform as a Spark ML Estimator / Model pair.

``FeatureEngineer.fit`` reads only the rows it is given (the train block) and
stores a handful of numbers: the median of every numeric input column, the
99th percentile of Income and Wealth and the maximum Income. The fitted
``FeatureModel`` inlines them as literals, so applying it to any split is a
pure projection (whole-stage codegen, no shuffle, no Python).

Output: the non-feature columns of the input (id, label, fold, ...) followed by
7 base columns (imputed, double) and 9 engineered columns, in the fixed order.
"""

from __future__ import annotations

import json
import logging

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.config import (
    BASE_COLS,
    ENGINEERED_COLS,
    FOLD_COL,
    ID_COL,
    TARGET_COLS,
)
from propensio.functions.features import (
    age_bracket_flags,
    clip_upper,
    lit_double,
    log1p_guarded,
    safe_divide,
)
from propensio.operators.stats import numeric_columns, quantiles

log = logging.getLogger(__name__)


class _FeatureParams(Params):
    baseCols = Param(Params._dummy(), "baseCols", "raw feature columns", TypeConverters.toListString)
    engineeredCols = Param(Params._dummy(), "engineeredCols", "engineered columns to emit", TypeConverters.toListString)
    excludeCols = Param(Params._dummy(), "excludeCols", "key, fold, label columns (never statistics)", TypeConverters.toListString)
    quantileMethod = Param(Params._dummy(), "quantileMethod", "exact | spark_exact | approx", TypeConverters.toString)
    accuracy = Param(Params._dummy(), "accuracy", "quantile accuracy", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(
            baseCols=list(BASE_COLS),
            engineeredCols=list(ENGINEERED_COLS),
            excludeCols=[ID_COL, FOLD_COL, *TARGET_COLS, "label", "_cv_fold"],
            quantileMethod="exact",
            accuracy=20_000,
        )

    def featureCols(self) -> list[str]:
        return list(self.getOrDefault(self.baseCols)) + list(self.getOrDefault(self.engineeredCols))


class FeatureEngineer(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, baseCols=None, engineeredCols=None, excludeCols=None, quantileMethod=None, accuracy=None):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    @property
    def n_features_out(self) -> int:
        """Nothing comes out before the fit (the fitted model knows its width)."""
        return 0

    def _fit(self, df: DataFrame) -> "FeatureModel":
        for needed in ("Income", "Wealth"):
            if needed not in df.columns:
                raise KeyError(needed)
        excluded = set(self.getOrDefault(self.excludeCols))
        numeric = numeric_columns(df, tuple(excluded))
        requests = {c: [0.5] for c in numeric}
        requests["Income"] = sorted(set(requests.get("Income", []) + [0.99]))
        requests["Wealth"] = sorted(set(requests.get("Wealth", []) + [0.99]))
        method = self.getOrDefault(self.quantileMethod)
        summary: dict = {}
        if method == "exact":
            from propensio.operators.stats import exact_quantiles

            q = exact_quantiles(df, requests, self.getOrDefault(self.accuracy), summary=summary)
            inc_max = summary[("Income", "max")]
        else:
            q = quantiles(df, requests, method, self.getOrDefault(self.accuracy))
            inc_max = df.agg(F.max(F.col("Income").cast("double"))).collect()[0][0]
        stats = {
            "medians": {c: q[(c, 0.5)] for c in numeric if (c, 0.5) in q},
            "p99_inc": q[("Income", 0.99)],
            "p99_wth": q[("Wealth", 0.99)],
            "inc_max": None if inc_max is None else float(inc_max),
        }
        model = FeatureModel(stats=json.dumps(stats))
        for p in (self.baseCols, self.engineeredCols, self.excludeCols):
            model._set(**{p.name: self.getOrDefault(p)})
        return model


class FeatureModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    stats = Param(Params._dummy(), "stats", "fitted statistics as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, stats=None):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def get_params(self) -> dict:
        """The fitted numbers: medians, p99 of income and wealth, max income."""
        return json.loads(self.getOrDefault(self.stats))

    @property
    def n_features_out(self) -> int:
        return len(self.featureCols())

    def feature_exprs(self, df: DataFrame) -> dict:
        st = self.get_params()
        med = st["medians"]

        def imputed(c: str):
            x = F.col(c).cast("double")
            return F.coalesce(x, lit_double(med[c])) if med.get(c) is not None else x

        base = {c: imputed(c) for c in self.getOrDefault(self.baseCols) if c in df.columns}
        out = {c: e for c, e in base.items()}
        age, inc, wth, fam = base.get("Age"), base.get("Income"), base.get("Wealth"), base.get("FamilyMembers")
        if age is not None:
            out.update(age_bracket_flags(age))
        if inc is not None and wth is not None:
            ci = clip_upper(inc, st["p99_inc"])
            cw = clip_upper(wth, st["p99_wth"])
            out["Wealth_log"] = log1p_guarded(wth)
            out["Income_log"] = log1p_guarded(inc)
            if age is not None:
                adult_years = F.when(age - 17 < 1, F.lit(1.0)).otherwise(age - 17)
                out["Wealth_Age_Ratio_log"] = log1p_guarded(cw / adult_years)
            if fam is not None:
                fallback = med.get("FamilyMembers")
                safe_fm = F.coalesce(F.nullif(fam, F.lit(0.0)), lit_double(1.0 if fallback is None else fallback))
                out["Wealth_per_person"] = safe_divide(cw, safe_fm)
                out["Income_per_person"] = safe_divide(ci, safe_fm)
            out["Income_Wealth_Ratio_log"] = log1p_guarded(F.coalesce(safe_divide(ci, cw), lit_double(st["inc_max"])))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = self.feature_exprs(df)
        wanted = self.featureCols()
        present = [c for c in wanted if c in exprs]
        missing = [c for c in wanted if c not in exprs]
        if missing:
            log.warning("FeatureModel: %d expected feature(s) missing after transform: %s", len(missing), missing)
        feature_set = set(wanted) | set(self.getOrDefault(self.baseCols))
        passthrough = [F.col(f"`{c}`") for c in df.columns if c not in feature_set]
        return df.select(*passthrough, *[exprs[c].alias(c) for c in present])


def fit_transform(engineer: FeatureEngineer, df: DataFrame) -> DataFrame:
    return engineer.fit(df).transform(df)

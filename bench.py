"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to completion into the no-op sink (the whole
result is computed, nothing is collected to the driver). Times include the
eager fitting steps a query needs (quantiles, folds, models).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from propensio.plans.catalog import QUERIES  # noqa: E402
from propensio.session import local_session  # noqa: E402

HEADLINE = [
    "clients_view",
    "freeze_folds",
    "parity_report",
    "fitted_stats",
    "feature_matrix_train",
    "feature_matrix_test",
    "metrics_by_target",
    "isotonic_calibration",
    "counterfactuals",
    "percentile_feature",
    "train_xgboost",
    "shap_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="propensio-bench")
    QUERIES["age_brackets"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

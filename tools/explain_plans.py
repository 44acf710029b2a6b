"""Print the physical plans of registered queries (``explain("formatted")``).

Usage: python tools/explain_plans.py [sf_dir] [name ...]
Eager steps the query needs (freeze, fits) run first; the printed plan is the
one Spark would execute for the returned DataFrame.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from propensio.plans.catalog import QUERIES  # noqa: E402
from propensio.session import local_session  # noqa: E402

DEFAULT = ["freeze_folds", "feature_matrix_test", "metrics_by_target", "counterfactuals", "percentile_feature"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session()
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()

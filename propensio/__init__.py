"""propensio — propensity scoring over client tables, written as Spark plans.

The package reads a client table, checks it, assigns an exact-size stratified
hold-out and balanced cross-validation folds, fits leak-free feature statistics
on the training rows, trains and calibrates Spark ML classifiers, searches
their parameters, reports exact metrics, explains models and proposes
counterfactual changes. Every data step is a DataFrame plan.
"""

from propensio.config import DataSpec, FeatureSpec

__all__ = ["DataSpec", "FeatureSpec"]
__version__ = "0.1.0"

"""Plain settings objects (the reference keeps these in YAML files)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's for equal results:
# column names of the client table, the feature order and the defaults.
ID_COL = "ID"
FOLD_COL = "stratified_fold"
STRATIFY_COL = "stratify_combined"
TARGET_COLS = ("AccumulationInvestment", "IncomeInvestment")
PRIMARY_TARGET = "IncomeInvestment"
BASE_COLS = (
    "Age",
    "Gender",
    "FamilyMembers",
    "FinancialEducation",
    "RiskPropensity",
    "Income",
    "Wealth",
)
ENGINEERED_COLS = (
    "Wealth_log",
    "Income_log",
    "Wealth_Age_Ratio_log",
    "Wealth_per_person",
    "Income_per_person",
    "Income_Wealth_Ratio_log",
    "Age_bracket_Young",
    "Age_bracket_Mid",
    "Age_bracket_Senior",
)
AGE_BRACKETS = (("Young", 17, 35), ("Mid", 35, 55), ("Senior", 55, 100))
UNASSIGNED_FOLD = -5
TEST_FOLD = -1
PARITY_TOLERANCE = 0.05
DEFAULT_THRESHOLD = 0.5
DEFAULT_SEED = 42
DEFAULT_SPLITS = 5


@dataclass(frozen=True)
class DataSpec:
    """Where the keys, folds and labels live and how to split them.

    ``test_size`` is a row count (int) or a fraction of all rows (float,
    rounded up as a row count). ``train_val_size`` None means "the rest".
    """

    id_col: str = ID_COL
    fold_col: str = FOLD_COL
    target_cols: tuple[str, ...] = TARGET_COLS
    primary_target: str = PRIMARY_TARGET
    stratify_col: str = STRATIFY_COL
    test_size: float | int = 0.2
    train_val_size: int | None = None
    n_splits: int = DEFAULT_SPLITS
    seed: int = DEFAULT_SEED
    rank_buckets_hex: int = 3


@dataclass(frozen=True)
class FeatureSpec:
    """Feature list and fitting options."""

    base_cols: tuple[str, ...] = BASE_COLS
    engineered_cols: tuple[str, ...] = ENGINEERED_COLS
    quantile_method: str = "exact"
    quantile_accuracy: int = 20_000
    extra: dict = field(default_factory=dict)

    @property
    def feature_cols(self) -> list[str]:
        return list(self.base_cols) + list(self.engineered_cols)

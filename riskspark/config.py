"""Settings as small frozen dataclasses; the defaults are the shipped settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Names and domains of the transaction table.
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
BALANCES = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
REQUIRED_COLUMNS = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
)
NUMERIC_COLUMNS = ("step", "amount") + BALANCES + ("isFraud", "isFlaggedFraud")
STRING_COLUMNS = ("type", "nameOrig", "nameDest")
DROPPED_COLUMNS = ("nameOrig", "nameDest", "isFlaggedFraud", "step")
DERIVED_FEATURES = ("balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio")
NUMERIC_FEATURES = ("amount",) + BALANCES + DERIVED_FEATURES
CATEGORICAL_FEATURES = ("type",)
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
CORRELATED_COLUMNS = ("amount",) + BALANCES + ("isFraud", "isFlaggedFraud")

# Grids, bucket bounds and categories of the reports.
THRESHOLD_GRID = (0.50, 0.60, 0.70, 0.80, 0.90)
OPERATING_THRESHOLD = 0.90
PROBABILITY_BUCKETS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LATENCY_BUCKETS_MS = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0, 750.0,
                      1000.0, 2500.0, 5000.0, 7500.0, 10000.0)
QUALITY_CATEGORIES = ("missing_field", "invalid_type", "invalid_amount",
                      "invalid_balance", "invalid_numeric_value")
METRICS = ("precision", "recall", "f1_score", "roc_auc", "pr_auc")


@dataclass(frozen=True)
class ValidationRules:
    """What a raw table has to look like."""

    target: str = "isFraud"
    allowed_targets: tuple[int, ...] = (0, 1)
    required: tuple[str, ...] = REQUIRED_COLUMNS
    numeric: tuple[str, ...] = NUMERIC_COLUMNS
    string: tuple[str, ...] = STRING_COLUMNS
    # column -> smallest valid value; counted only where the column is numeric
    minimums: dict[str, float] = field(
        default_factory=lambda: {"amount": 0, "step": 1, **{b: 0 for b in BALANCES}}
    )


@dataclass(frozen=True)
class FeatureConfig:
    balance_diffs: bool = True
    amount_ratio: bool = True


@dataclass(frozen=True)
class SplitConfig:
    test_size: float = 0.3
    seed: int = 42
    stratify: bool = True


@dataclass(frozen=True)
class SmoteConfig:
    k: int = 5
    seed: int = 42
    block_rows: int = 2048
    max_pivots: int = 1_000_000


@dataclass(frozen=True)
class ModelConfig:
    trees: int = 200
    depth: int = 6
    learning_rate: float = 0.05
    row_subsample: float = 0.8
    column_subsample: float = 0.8
    seed: int = 42
    threshold: float = OPERATING_THRESHOLD


@dataclass(frozen=True)
class Experiment:
    name: str
    use_smote: bool
    use_class_weight: bool


EXPERIMENTS = (
    Experiment("baseline_smote_scale_weight", True, True),
    Experiment("smote_only", True, False),
    Experiment("scale_weight_only", False, True),
)


@dataclass(frozen=True)
class PromotionCriteria:
    min_recall_delta: float = 0.0
    min_pr_auc_delta: float = 0.0
    min_f1_delta: float = 0.001


@dataclass(frozen=True)
class DriftConfig:
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    distance_threshold: float = 0.1
    p_value_threshold: float = 0.05
    share_threshold: float = 0.5
    log_base: float = 2.718281828459045

    def __post_init__(self) -> None:
        if not 0 < self.share_threshold <= 1:
            raise ValueError("share_threshold must lie in (0, 1]")

"""Stage parameters as frozen dataclasses.

Fixed values: these defaults must equal the reference configuration so results agree.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

# ---- fixed values: column names and groups of the credit table ----
ID_COL = "ID"
RAW_TARGET = "default payment next month"
TARGET = "default"
DEMOGRAPHIC_COLS = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
PAY_COLS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL_COLS = ["BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6"]
PAYAMT_COLS = ["PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6"]
RAW_COLS = [ID_COL] + DEMOGRAPHIC_COLS + PAY_COLS + BILL_COLS + PAYAMT_COLS + [RAW_TARGET]
CLEAN_COLS = DEMOGRAPHIC_COLS + PAY_COLS + BILL_COLS + PAYAMT_COLS + [TARGET]
DERIVED_COLS = [
    "pay_delay_max", "pay_delay_mean", "n_months_delayed",
    "avg_bill", "max_bill", "bill_trend",
    "avg_pay_amt", "total_pay",
    "util_ratio", "pct_paid",
]
PRIMARY_KEY = "customer_id"
EVENT_TIME = "event_time"
FEATURE_COLS = DEMOGRAPHIC_COLS + PAY_COLS + BILL_COLS + PAYAMT_COLS + DERIVED_COLS  # 33 model features


def _ro(d):
    return MappingProxyType(d)


@dataclass(frozen=True)
class QualityParams:
    expected_column_count: int = 25
    target_column: str = RAW_TARGET
    # column -> (min, max); None = open bound
    ranges: tuple = (("AGE", 18, 100), ("LIMIT_BAL", 0, None))
    value_sets: tuple = (
        ("SEX", (1, 2)),
        ("EDUCATION", (0, 1, 2, 3, 4, 5, 6)),
        ("MARRIAGE", (0, 1, 2, 3)),
        (RAW_TARGET, (0, 1)),
    )
    not_null: tuple = ("ID", "LIMIT_BAL", "AGE", RAW_TARGET)


@dataclass(frozen=True)
class CleaningParams:
    id_column: str = ID_COL
    target_column_raw: str = RAW_TARGET
    target_column: str = TARGET
    # column -> (from codes, to code)
    category_merges: tuple = (("EDUCATION", (0, 5, 6), 4), ("MARRIAGE", (0,), 3))


@dataclass(frozen=True)
class FeatureParams:
    primary_key: str = PRIMARY_KEY
    event_time: str = EVENT_TIME
    event_time_value: str = "2024-01-01 00:00:00"
    feature_group_version: int = 1
    feature_groups: tuple = (
        ("credit_demographic", ("LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "default")),
        ("credit_payment_status", ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
                                   "pay_delay_max", "pay_delay_mean", "n_months_delayed")),
        ("credit_bill", ("BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6",
                         "avg_bill", "max_bill", "bill_trend", "util_ratio")),
        ("credit_payment_amt", ("PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6",
                                "avg_pay_amt", "total_pay", "pct_paid")),
    )


@dataclass(frozen=True)
class SplitParams:
    test_size: float = 0.20
    val_size: float = 0.10
    stratify: bool = True
    shuffle: bool = True
    random_seed: int = 42
    target_column: str = TARGET
    id_columns: tuple = (PRIMARY_KEY, EVENT_TIME)


@dataclass(frozen=True)
class TrainParams:
    candidate_models: tuple = ("LogisticRegression", "RandomForest", "GradientBoosting")
    trials: int = 15
    primary_metric: str = "roc_auc"
    random_seed: int = 42


@dataclass(frozen=True)
class SelectionParams:
    primary_metric: str = "roc_auc"
    higher_is_better: bool = True
    shap_max_samples: int = 1000
    registered_model_name: str = "credit_default_champion"


@dataclass(frozen=True)
class PredictParams:
    prediction_threshold: float = 0.5
    shap_sample: int = 200
    registered_model_name: str = "credit_default_champion"
    champion_alias: str = "Champion"


@dataclass(frozen=True)
class DriftParams:
    sample_size: int = 2000
    bias_column: str = "AGE"
    bias_quantile: float = 0.85
    psi_threshold: float = 0.20
    ks_p_value_threshold: float = 0.05
    js_threshold: float = 0.10
    pca_components: int = 5
    pca_drift_ratio: float = 1.5
    trigger_retrain_on_drift: bool = False
    buckets: int = 10
    epsilon: float = 1e-4
    sample_seed: int = 42


@dataclass(frozen=True)
class Params:
    quality: QualityParams = field(default_factory=QualityParams)
    cleaning: CleaningParams = field(default_factory=CleaningParams)
    features: FeatureParams = field(default_factory=FeatureParams)
    split: SplitParams = field(default_factory=SplitParams)
    train: TrainParams = field(default_factory=TrainParams)
    selection: SelectionParams = field(default_factory=SelectionParams)
    predict: PredictParams = field(default_factory=PredictParams)
    drift: DriftParams = field(default_factory=DriftParams)


DEFAULTS = Params()

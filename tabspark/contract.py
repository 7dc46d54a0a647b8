"""Data contracts: what a raw table must look like and how it is cleaned.

A contract is plain driver-side configuration. Checking it against
``df.schema`` runs no job; the row-level rules become column expressions that
the validation and cleaning operators fuse into single passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


class ContractError(ValueError):
    """A fatal contract rule failed (raised by validation)."""


@dataclass(frozen=True)
class RangeRule:
    """Closed valid range for one column.

    ``cast`` is the lenient cast applied before comparing (``double`` or
    ``bigint``); ``warning`` names the validation warning, ``reason`` the
    cleaning waterfall bucket.
    """

    column: str
    low: float
    high: float
    cast: str
    warning: str
    reason: str


@dataclass(frozen=True)
class DataContract:
    """Required columns, their clean types, and the row-level rules."""

    # column -> clean Spark SQL type; order is the output order
    columns: tuple[tuple[str, str], ...]
    code_column: str
    code_pattern: str
    max_null_rate: dict[str, float]
    optional_columns: tuple[str, ...] = ()
    min_rows: int = 1
    max_duplicate_rate: float = 0.20
    max_invalid_code_rate: float = 0.01
    # range rules in cleaning order
    ranges: tuple[RangeRule, ...] = ()
    # order in which range warnings are reported by validation
    warning_order: tuple[str, ...] = ()
    # columns carried through cleaning untouched (e.g. a row key)
    passthrough: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def output_columns(self) -> tuple[str, ...]:
        return self.required + tuple(c for c in self.passthrough if c not in self.required)

    def clean_type(self, name: str) -> str:
        return dict(self.columns)[name]

    def with_passthrough(self, *names: str) -> DataContract:
        return replace(self, passthrough=tuple(names))

    def range_rule(self, column: str) -> RangeRule:
        for rule in self.ranges:
            if rule.column == column:
                return rule
        raise KeyError(column)


# ---------------------------------------------------------------------------
# The census-income contract. Column names, clean types, null
# limits, gate thresholds, the STATE pattern and the valid ranges must equal
# the reference's so that the same rows pass and fail.
#   columns (in order): AGEP COW SCHL MAR OCCP POBP RELP WKHP SEX RAC1P STATE
#                       YEAR PINCP; clean type double except STATE string and
#                       YEAR bigint
#   optional column: __index_level_0__
#   null limits: AGEP 0.005, COW 0.02, SCHL 0.02, MAR 0.02, OCCP 0.05,
#                POBP 0.05, RELP 0.02, WKHP 0.01, SEX 0.01, RAC1P 0.01,
#                STATE 0.0, YEAR 0.0, PINCP 0.0
#   min rows 1; max duplicate rate 0.20; max invalid STATE rate 0.01
#   STATE pattern ^[A-Z]{2}$
#   ranges: AGEP 0..115, WKHP 0..168, YEAR 2010..2035
#   cleaning order: nulls, STATE, AGEP, WKHP, YEAR, duplicates
#   warning order: YEAR, AGEP, WKHP
# ---------------------------------------------------------------------------
CENSUS = DataContract(
    columns=(
        ("AGEP", "double"), ("COW", "double"), ("SCHL", "double"), ("MAR", "double"),
        ("OCCP", "double"), ("POBP", "double"), ("RELP", "double"), ("WKHP", "double"),
        ("SEX", "double"), ("RAC1P", "double"), ("STATE", "string"), ("YEAR", "bigint"),
        ("PINCP", "double"),
    ),
    code_column="STATE",
    code_pattern="^[A-Z]{2}$",
    max_null_rate={
        "AGEP": 0.005, "COW": 0.02, "SCHL": 0.02, "MAR": 0.02, "OCCP": 0.05,
        "POBP": 0.05, "RELP": 0.02, "WKHP": 0.01, "SEX": 0.01, "RAC1P": 0.01,
        "STATE": 0.0, "YEAR": 0.0, "PINCP": 0.0,
    },
    optional_columns=("__index_level_0__",),
    min_rows=1,
    max_duplicate_rate=0.20,
    max_invalid_code_rate=0.01,
    ranges=(
        RangeRule("AGEP", 0, 115, "double", "age_out_of_range_rows", "invalid_age"),
        RangeRule("WKHP", 0, 168, "double", "work_hours_out_of_range_rows", "invalid_hours"),
        RangeRule("YEAR", 2010, 2035, "bigint", "year_out_of_range_rows", "invalid_year"),
    ),
    warning_order=("YEAR", "AGEP", "WKHP"),
)

# Feature layout of the census preset: numeric block then one-hot STATE.
CENSUS_NUMERIC_FEATURES: tuple[str, ...] = (
    "AGEP", "COW", "SCHL", "MAR", "OCCP", "POBP", "RELP", "WKHP", "SEX", "RAC1P", "YEAR",
)
CENSUS_TARGET = "TARGET"
CENSUS_INCOME_COLUMN = "PINCP"
CENSUS_INCOME_THRESHOLD = 50_000


@dataclass(frozen=True)
class TrainingConfig:
    """Split, trainer and gate settings (defaults are the reference's)."""

    # Split fractions, seed, label threshold, gate limits and
    # boosted-tree defaults as the reference configures them.
    target_income_threshold: float = 50_000
    random_seed: int = 42
    train_fraction: float = 0.70
    validation_fraction: float = 0.15
    test_fraction: float = 0.15
    min_auc: float = 0.90
    min_f1: float = 0.85
    min_precision: float = 0.85
    min_recall: float = 0.85
    max_p95_latency_ms: float = 5.0
    min_throughput_rows_per_sec: float = 1000.0
    enable_performance_gate: bool = True
    learning_rate: float = 0.05
    num_leaves: int = 63
    feature_fraction: float = 0.80
    bagging_fraction: float = 0.80
    bagging_freq: int = 1
    min_data_in_leaf: int = 50
    num_boost_round: int = 500
    early_stopping_rounds: int = 50
    model_name: str = "acs_income_classifier"
    promotion_stage: str = "Staging"
    enable_model_registration: bool = False
    threshold: float = 0.5
    # further trainer options by name (max_depth, min_split_gain), and other names of the fields above
    # (n_estimators, min_child_samples, subsample, subsample_freq, colsample_bytree, random_state), which win
    extra: dict = field(default_factory=dict)

    @property
    def fractions(self) -> tuple[float, float, float]:
        return (self.train_fraction, self.validation_fraction, self.test_fraction)

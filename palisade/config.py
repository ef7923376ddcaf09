"""Default settings of every stage.  All of them are plain frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: the default contract -------------------------------------
RANDOM_SEED = 42
HOLDOUT_FRACTION = 0.2
CLASS_NAMES = {0: "Normal", 1: "Attack"}
NORMAL_LABEL = "normal"

VARIANCE_FLOOR = 0.0
PUBLIC_VARIANCE_FLOOR = 0.01
CORRELATION_LIMIT = 0.95
DERIVED_FEATURE_COLUMNS = 5

SIGNATURE_HIT_PROBABILITY = 0.99
THRESHOLD_GRID_SIZE = 50
THRESHOLD_GRID_LOW = 0.1
THRESHOLD_GRID_HIGH = 0.9
TOP_IMPORTANCES = 20
# The defaults of the dataclasses below are fixed values too.
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class PreprocessSettings:
    missing: str = "mean"  # mean | median | most_frequent
    outliers: str | None = None  # None | iqr | zscore
    iqr_multiplier: float = 1.5
    scale: bool = True
    scaling: str = "standard"  # standard | minmax | robust
    max_categories: int | None = None  # a bound that a user may set: one output column per category


@dataclass(frozen=True)
class FeatureSettings:
    k: int | str = "all"
    interactions: bool = False
    squares: bool = False


@dataclass(frozen=True)
class SignatureSettings:
    categorical_columns: tuple[str, ...] = ("protocol_type", "service", "flag")
    binary_columns: tuple[str, ...] = ("land", "root_shell", "su_attempted", "is_guest_login")
    max_combo_size: int = 2
    min_support: float = 0.002
    min_confidence: float = 0.98
    max_rules: int = 50
    prune_rare: bool = False  # for columns with very many values: one more pass, same rules


@dataclass(frozen=True)
class BoostedTreesSettings:
    """Row- and column-sampled boosted trees."""

    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    column_sample: float = 0.8
    max_bins: int = 64
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class FineBinnedTreesSettings:
    """Boosted trees on fine histograms with larger leaves and no row sampling."""

    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.1
    column_sample: float = 0.8
    max_bins: int = 255
    min_rows_per_leaf: int = 20
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    depth: int = 15
    min_rows_per_leaf: int = 2
    balanced: bool = True
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class KernelMachineSettings:
    c: float = 1.0
    fourier_features: int = 128
    folds: int = 5
    max_iterations: int = 100
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class LogisticSettings:
    c: float = 1.0
    max_iterations: int = 1000


@dataclass(frozen=True)
class LearnerSettings:
    boosted_trees: BoostedTreesSettings = field(default_factory=BoostedTreesSettings)
    fine_binned_trees: FineBinnedTreesSettings = field(default_factory=FineBinnedTreesSettings)
    random_forest: ForestSettings = field(default_factory=ForestSettings)
    kernel_machine: KernelMachineSettings = field(default_factory=KernelMachineSettings)
    logistic_regression: LogisticSettings = field(default_factory=LogisticSettings)


@dataclass(frozen=True)
class EnsembleSettings:
    voting: str = "soft"  # soft | hard
    weights: tuple[float, ...] | None = None


@dataclass(frozen=True)
class FusionSettings:
    use_signatures: bool = True
    threshold: float = 0.5


@dataclass(frozen=True)
class DetectorSettings:
    preprocess: PreprocessSettings = field(default_factory=PreprocessSettings)
    features: FeatureSettings = field(default_factory=FeatureSettings)
    signatures: SignatureSettings = field(default_factory=SignatureSettings)
    learners: LearnerSettings = field(default_factory=LearnerSettings)
    ensemble: EnsembleSettings = field(default_factory=EnsembleSettings)
    fusion: FusionSettings = field(default_factory=FusionSettings)

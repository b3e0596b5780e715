"""Job parameters, checked on the driver before any Spark job starts."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields
from typing import Any

from oddrow.errors import ConfigurationError
from oddrow.profiles import profile_names

PRECISIONS = ("float32", "float64")
DEALS = ("row", "rank")
LR_SCHEDULES = ("none", "step_decay", "cosine_annealing")
ACTIVATIONS = ("relu", "tanh", "sigmoid", "linear", "elu", "softplus")
RATIO_TOLERANCE = 1e-6


def _integer(key: str, value: Any, low: int | None = None, high: int | None = None) -> int:
    # bool is a subclass of int, and true is no layer size
    if isinstance(value, bool) or not isinstance(value, int):
        raise ConfigurationError(f"'{key}' must be an integer, got: {value!r}")
    if (low is not None and value < low) or (high is not None and value > high):
        bounds = f">= {low}" if high is None else f"in [{low}, {high}]"
        raise ConfigurationError(f"'{key}' must be {bounds}, got: {value}")
    return value


def _real(key: str, value: Any) -> float:
    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value):
        raise ConfigurationError(f"'{key}' must be a finite number, got: {value!r}")
    return float(value)


def _text(key: str, value: Any) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ConfigurationError(f"'{key}' must be a non-empty string, got: {value!r}")
    return value


def _one_of(key: str, value: Any, allowed: tuple[str, ...] | list[str]) -> str:
    if value not in allowed:
        raise ConfigurationError(f"'{key}' must be one of {sorted(allowed)}, got: {value!r}")
    return value


@dataclass(frozen=True)
class DatasetParams:
    path: str
    schema: str

    def __post_init__(self) -> None:
        _text("dataset.path", self.path)
        _one_of("dataset.schema", self.schema, profile_names())


@dataclass(frozen=True)
class SplitParams:
    train_ratio: float = 0.70
    val_ratio: float = 0.10
    test_ratio: float = 0.20
    random_seed: int = 42

    def __post_init__(self) -> None:
        ratios = ("train_ratio", "val_ratio", "test_ratio")
        for name in ratios:
            value = _real(f"splits.{name}", getattr(self, name))
            if not 0.0 < value < 1.0:
                raise ConfigurationError(
                    f"'splits.{name}' must lie strictly between 0 and 1, got: {value}"
                )
        total = sum(getattr(self, name) for name in ratios)
        if abs(total - 1.0) > RATIO_TOLERANCE:
            raise ConfigurationError(
                "'splits.train_ratio', 'splits.val_ratio' and 'splits.test_ratio' must sum "
                f"to 1.0, they sum to {total:.8f}"
            )
        _integer("splits.random_seed", self.random_seed)

    @property
    def train_fraction(self) -> float:
        """Share of the normal rows that trains; the rest validates."""
        return self.train_ratio / (self.train_ratio + self.val_ratio)


@dataclass(frozen=True)
class ArchitectureParams:
    """``max_categories`` is the most distinct values that a one-hot column may have: each is an
    input of the model."""

    encoder_layers: tuple[int, ...] = (128, 64, 32)
    bottleneck_dim: int = 16
    activation: str = "relu"
    dropout_rate: float = 0.2
    max_categories: int = 50_000

    def __post_init__(self) -> None:
        layers = self.encoder_layers
        if not isinstance(layers, list | tuple) or not layers:
            raise ConfigurationError("'architecture.encoder_layers' must be a non-empty list")
        for i, size in enumerate(layers):
            _integer(f"architecture.encoder_layers[{i}]", size, 1)
        object.__setattr__(self, "encoder_layers", tuple(layers))
        _integer("architecture.bottleneck_dim", self.bottleneck_dim, 1)
        if self.bottleneck_dim >= min(layers):
            raise ConfigurationError(
                f"'architecture.bottleneck_dim' ({self.bottleneck_dim}) must be smaller than "
                f"the smallest encoder layer ({min(layers)})"
            )
        _text("architecture.activation", self.activation)
        _one_of("architecture.activation", self.activation, ACTIVATIONS)
        rate = _real("architecture.dropout_rate", self.dropout_rate)
        if not 0.0 <= rate < 1.0:
            raise ConfigurationError(f"'architecture.dropout_rate' must be in [0, 1), got: {rate}")
        _integer("architecture.max_categories", self.max_categories, 1)


@dataclass(frozen=True)
class TrainingParams:
    """``shards`` is the number of data-parallel replicas, whatever the size of the table.

    One shard is plain sequential training; more spread the work over as many tasks, whose
    replicas are averaged by rows after every round of about ``round_rows`` training rows each.
    Larger rounds mean fewer jobs and fewer files, smaller ones keep many shards closer to
    sequential training. ``precision`` is the type of features and parameters. Rows are dealt
    over shards and rounds by a hash of the whole row (``deal_by`` "row"), or by the seeded rank
    of their key ("rank"), which other engines can repeat but needs a key that few rows share.
    """

    learning_rate: float = 0.001
    batch_size: int = 256
    max_epochs: int = 100
    patience: int = 10
    lr_schedule: str = "none"
    random_seed: int = 42
    shards: int = 8
    round_rows: int = 16_384
    precision: str = "float32"
    deal_by: str = "row"

    def __post_init__(self) -> None:
        if _real("training.learning_rate", self.learning_rate) <= 0.0:
            raise ConfigurationError(
                f"'training.learning_rate' must be > 0, got: {self.learning_rate}"
            )
        _integer("training.batch_size", self.batch_size, 1)
        _integer("training.max_epochs", self.max_epochs, 1)
        _integer("training.patience", self.patience, 1)
        _one_of("training.lr_schedule", self.lr_schedule, LR_SCHEDULES)
        _integer("training.random_seed", self.random_seed)
        _integer("training.shards", self.shards, 1)
        _integer("training.round_rows", self.round_rows, 1)
        _one_of("training.precision", self.precision, PRECISIONS)
        _one_of("training.deal_by", self.deal_by, DEALS)


@dataclass(frozen=True)
class ThresholdParams:
    percentile: int = 95

    def __post_init__(self) -> None:
        _integer("threshold.percentile", self.percentile, 1, 99)


@dataclass(frozen=True)
class OutputParams:
    artefact_dir: str = "runs"

    def __post_init__(self) -> None:
        _text("output.artefact_dir", self.artefact_dir)


@dataclass(frozen=True)
class JobParams:
    dataset: DatasetParams
    splits: SplitParams
    architecture: ArchitectureParams
    training: TrainingParams
    threshold: ThresholdParams
    output: OutputParams

    @classmethod
    def from_mapping(cls, raw: Any) -> JobParams:
        """Build parameters from nested mappings; every section and key must be present."""
        if not isinstance(raw, Mapping):
            raise ConfigurationError(
                f"parameters must be a mapping at the top level, got: {type(raw).__name__}"
            )
        for section in _SECTIONS:
            if section not in raw:
                raise ConfigurationError(f"parameters lack the section '{section}'")
        return cls(**{name: _section(name, kind, raw[name]) for name, kind in _SECTIONS.items()})

    def to_mapping(self) -> dict[str, Any]:
        return asdict(self)


_SECTIONS: dict[str, type] = {
    "dataset": DatasetParams,
    "splits": SplitParams,
    "architecture": ArchitectureParams,
    "training": TrainingParams,
    "threshold": ThresholdParams,
    "output": OutputParams,
}
_OPTIONAL = {"architecture.max_categories"} | {
    f"training.{name}" for name in ("shards", "round_rows", "precision", "deal_by")
}


def _section(name: str, kind: type, raw: Any) -> Any:
    if not isinstance(raw, Mapping):
        raise ConfigurationError(f"configuration section '{name}' must be a mapping")
    values = {}
    for entry in fields(kind):
        if entry.name in raw:
            values[entry.name] = raw[entry.name]
        elif f"{name}.{entry.name}" not in _OPTIONAL:
            raise ConfigurationError(f"parameters lack '{name}.{entry.name}'")
    return kind(**values)


def load_params(path: str) -> JobParams:
    """Read parameters from a YAML (or JSON) file next to the driver program."""
    try:
        import yaml
    except ImportError as exc:
        raise ConfigurationError("reading a parameter file needs the 'yaml' module") from exc
    with open(path, encoding="utf-8") as handle:
        return JobParams.from_mapping(yaml.safe_load(handle))

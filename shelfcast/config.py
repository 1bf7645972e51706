"""Driver-side settings; published ones that no operator here needs are kept, so that the published file loads."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass, replace
from pathlib import Path
from typing import Any

from shelfcast.schema import LAGS, WINDOWS


# The defaults below are the published settings of the pipeline.
@dataclass(frozen=True)
class SplitConfig:
    validation_days: int = 90
    test_days: int = 90


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple[int, ...] = tuple(LAGS)
    rolling_windows: tuple[int, ...] = tuple(WINDOWS)
    enable_hierarchical_features: bool = True
    enable_demand_pattern_features: bool = True
    history_mode: str = "pooled"


@dataclass(frozen=True)
class BoostingConfig:
    n_estimators: int = 250
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.9
    colsample: float = 0.9


@dataclass(frozen=True)
class BacktestConfig:
    folds: int = 3
    horizon_days: int = 28
    step_days: int = 28


@dataclass(frozen=True)
class RegistryConfig:
    primary_metric: str = "rmse"
    minimum_relative_improvement: float = 0.0
    required_backtest_folds: int = 1
    max_slice_rmse_regression: float = 0.10


@dataclass(frozen=True)
class MonitoringConfig:
    psi_threshold: float = 0.20
    mean_shift_threshold: float = 2.0
    missing_rate_shift_threshold: float = 0.05
    new_category_rate_threshold: float = 0.01


@dataclass(frozen=True)
class Config:
    data: SplitConfig = field(default_factory=SplitConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    boosting: BoostingConfig = field(default_factory=BoostingConfig)
    backtest: BacktestConfig = field(default_factory=BacktestConfig)
    registry: RegistryConfig = field(default_factory=RegistryConfig)
    monitoring: MonitoringConfig = field(default_factory=MonitoringConfig)
    forecast_horizon: int = 1
    random_state: int = 42


def _override(node: Any, values: dict[str, Any]) -> Any:
    known = {f.name: getattr(node, f.name) for f in fields(node)}
    unknown = sorted(set(values) - set(known))
    if unknown:
        raise ValueError(f"Unknown settings: {unknown}")
    changes = {}
    for name, value in values.items():
        current = known[name]
        if is_dataclass(current):
            changes[name] = _override(current, value or {})
        else:
            changes[name] = tuple(value) if isinstance(current, tuple) else value
    return replace(node, **changes)


def _published(values: dict[str, Any]) -> dict[str, Any]:
    """The published file's `model` block in the terms of this one: its trees are `boosting`."""
    values = dict(values)
    model = dict(values.pop("model", None) or {})
    unknown = sorted(set(model) - {"forecast_horizon", "random_state", "xgboost"})
    if unknown:
        raise ValueError(f"Unknown settings: {unknown}")
    if "xgboost" in model:
        names = {"colsample_bytree": "colsample"}
        trees = {names.get(k, k): v for k, v in (model["xgboost"] or {}).items()}
        values["boosting"] = trees | (values.get("boosting") or {})
    for name in ("forecast_horizon", "random_state"):
        if name in model:
            values[name] = model[name]
    return values


def load_config(source: str | Path | dict[str, Any] | None = None) -> Config:
    """Defaults, overridden by a mapping or by a JSON (or, where available, YAML) file."""
    if source is None:
        return Config()
    if isinstance(source, dict):
        return _override(Config(), _published(source))
    path = Path(source)
    text = path.read_text(encoding="utf-8")
    if path.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as exc:
            raise ValueError("YAML settings need a YAML reader; use JSON instead.") from exc
        return _override(Config(), _published(yaml.safe_load(text) or {}))
    return _override(Config(), _published(json.loads(text or "{}")))

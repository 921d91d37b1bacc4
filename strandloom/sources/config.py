"""Validated workflow configuration from TOML or JSON: command line over file over built-in values."""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any

from ..operators.cluster import METHODS
from ..schemas import VIEW_DEFAULTS


@dataclass(frozen=True)
class ViewOptions:
    min_comp_len: int = VIEW_DEFAULTS["min_comp_len"]
    impute_ani: float = VIEW_DEFAULTS["impute_ani"]
    max_null_fraction: float = VIEW_DEFAULTS["max_null_fraction"]
    max_null_samples: int | None = VIEW_DEFAULTS["max_null_samples"]
    linkage_method: str = VIEW_DEFAULTS["linkage_method"]
    neighbor_k: int = VIEW_DEFAULTS["neighbor_k"]
    clonal_cluster_threshold: float = VIEW_DEFAULTS["clonal_cluster_threshold"]
    strain_cluster_threshold: float = VIEW_DEFAULTS["strain_cluster_threshold"]

    def __post_init__(self) -> None:
        checks = {
            "min_comp_len": self.min_comp_len >= 0,
            "max_null_fraction": 0 <= self.max_null_fraction <= 1,
            "max_null_samples": self.max_null_samples is None or self.max_null_samples >= 0,
            "linkage_method": self.linkage_method in METHODS,
            "neighbor_k": self.neighbor_k >= 1,
        } | {n: 0 <= getattr(self, n) <= 100 for n in ("impute_ani", "clonal_cluster_threshold", "strain_cluster_threshold")}
        bad = [n for n, ok in checks.items() if not ok]
        if bad:
            raise ValueError(f"out of range: {', '.join(bad)}")


@dataclass(frozen=True)
class MatrixOptions:
    min_cov: int = 5
    storage_mode: str = "bitmask"
    ani_method: str = "popani"
    calculate: str = "ani"


@dataclass(frozen=True)
class Config:
    matrix: MatrixOptions = field(default_factory=MatrixOptions)
    view: ViewOptions = field(default_factory=ViewOptions)


#: Tables of the file and the part each fills.
TABLES = {"matrix_build": "matrix", "matrix_compare": "matrix", "genome_view": "view"}


def parse(raw: dict[str, Any]) -> Config:
    if not isinstance(raw, dict):
        raise ValueError("a configuration must be a table")
    out = Config()
    for table, part in TABLES.items():
        values = raw.get(table, {})
        if not isinstance(values, dict):
            raise ValueError(f"[{table}] must be a table")
        known = {f.name for f in fields(getattr(out, part))}
        out = replace(out, **{part: replace(getattr(out, part), **{k: v for k, v in values.items() if k in known})})
    return out


def load(path: str | None) -> Config:
    if path is None:
        return Config()
    raw = Path(path).read_bytes()
    if path.lower().endswith(".toml"):
        return parse(tomllib.loads(raw.decode()))
    if path.lower().endswith(".json"):
        return parse(json.loads(raw))
    raise ValueError("a configuration must be .toml or .json")


def over(config: Config, **options: Any) -> Config:
    """Command-line values, where given, replace those of the file; a given fraction clears a sample limit."""
    given = {k: v for k, v in options.items() if v is not None}
    if "max_null_fraction" in given and "max_null_samples" not in given:
        given["max_null_samples"] = None
    names = {f.name for f in fields(ViewOptions)}
    return replace(config, view=replace(config.view, **{k: v for k, v in given.items() if k in names}), matrix=replace(config.matrix, **{k: v for k, v in given.items() if k not in names}))

"""Nested settings: defaults, a file, overrides."""

from __future__ import annotations

import copy
from typing import Any


def merge(base: dict, over: dict | None) -> dict:
    """`over` on `base`, map by map; neither is changed."""
    out = copy.deepcopy(base)
    for k, v in (over or {}).items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def load(path: str | None, defaults: dict, overrides: dict[str, Any] | None = None) -> dict:
    """Defaults, then a YAML file, then dotted overrides; an override of None changes nothing."""
    import yaml

    found = {}
    if path:
        with open(path, encoding="utf-8") as f:
            found = yaml.safe_load(f) or {}
    out = merge(defaults, found)
    for dotted, v in (overrides or {}).items():
        if v is not None:
            put(out, dotted, v)
    return out


def get(config: dict, dotted: str, default: Any = None) -> Any:
    for part in dotted.split("."):
        if not isinstance(config, dict) or part not in config:
            return default
        config = config[part]
    return config


def put(config: dict, dotted: str, value: Any) -> None:
    *way, last = dotted.split(".")
    for part in way:
        config = config.setdefault(part, {})
    config[last] = value


def dump(config: dict) -> str:
    import yaml

    return yaml.safe_dump(config, allow_unicode=True, sort_keys=False)


def first_filled(config: dict, *paths: str) -> Any:
    """The first setting that isn't empty: of two spellings of one option either counts."""
    return next((v for v in (get(config, p) for p in paths) if v not in (None, "")), None)

"""Run settings: YAML files that extend others."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path
from typing import Any


def deep_merge(base: dict, override: dict) -> dict:
    """base with what override says; tables merge, anything else replaces."""
    out = dict(base)
    for key, value in override.items():
        out[key] = deep_merge(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load(path: str | Path, _above: tuple[Path, ...] = ()) -> dict[str, Any]:
    """A file over those that its `extends` names, left to right; a file that extends itself is an error."""
    import yaml

    path = Path(path).resolve()
    if path in _above:
        raise ValueError(f"{path} extends itself")
    own = yaml.safe_load(path.read_text()) or {}
    bases = own.pop("extends", [])
    out: dict = {}
    for base in [bases] if isinstance(bases, str) else bases:
        out = deep_merge(out, load(path.parent / base, (*_above, path)))
    return deep_merge(out, own)


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()

"""Configuration: composed YAML, lazy references, overrides, and a check for unknown keys."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from pathlib import Path
from typing import Any

import yaml

_REFERENCE = re.compile(r"\$\{([^${}]+)\}")
_REQUIRED = object()


def merge(base: dict, over: dict) -> dict:
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def select(cfg: dict, path: str, default: Any = None) -> Any:
    for part in path.split("."):
        if not isinstance(cfg, dict) or part not in cfg:
            return default
        cfg = cfg[part]
    return cfg


def assign(cfg: dict, path: str, value: Any) -> None:
    *folders, last = path.split(".")
    for part in folders:
        cfg = cfg.setdefault(part, {})
    cfg[last] = value


def load(root: str | Path, overrides: Iterable[str] = ()) -> dict:
    """The root file's own keys over its `includes` (name: file, each under its name), key=value overrides last."""
    root = Path(root)
    own = yaml.safe_load(root.read_text()) or {}
    out: dict = {}
    includes = own.pop("includes", {}) or {}
    for name, file in includes.items() if isinstance(includes, dict) else ((Path(f).stem, f) for f in includes):
        out = merge(out, {name: yaml.safe_load((root.parent / file).read_text()) or {}})
    out = merge(out, own)
    for item in overrides:
        key, _, value = item.partition("=")
        assign(out, key, yaml.safe_load(value))
    return out


def resolve(cfg: dict, value: Any = _REQUIRED) -> Any:
    """A copy with ${a.b} and ${oc.env:NAME,default} replaced; what isn't there is a KeyError."""
    value = cfg if value is _REQUIRED else value
    if isinstance(value, dict):
        return {k: resolve(cfg, v) for k, v in value.items()}
    if isinstance(value, list):
        return [resolve(cfg, v) for v in value]
    if not isinstance(value, str):
        return value

    def one(name: str) -> Any:
        if name.startswith("oc.env:"):
            var, comma, default = name[7:].partition(",")
            if var in os.environ:
                return os.environ[var]
            if comma:
                return yaml.safe_load(default)
            raise KeyError(f"environment variable {var}")
        found = select(cfg, name, _REQUIRED)
        if found is _REQUIRED:
            raise KeyError(name)
        return resolve(cfg, found)

    if m := _REFERENCE.fullmatch(value):
        return one(m[1])
    return _REFERENCE.sub(lambda m: str(one(m[1])), value)


def unknown_keys(cfg: dict, known: Iterable[str]) -> list[str]:
    """Dotted keys under which nothing is known; a known key covers all below it."""
    known = set(known)

    def walk(node: dict, at: str) -> list[str]:
        out = []
        for k, v in node.items():
            name = f"{at}{k}"
            if name in known:
                continue
            if isinstance(v, dict) and any(x.startswith(name + ".") for x in known):
                out += walk(v, name + ".")
            else:
                out.append(name)
        return out

    return walk(cfg, "")


def snapshot(cfg: dict, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    Path(path).write_text(yaml.safe_dump(cfg, sort_keys=False, allow_unicode=True))

"""Names to callables, strict options, and small helpers for nested options (driver side)."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable
from typing import Any


class Registry:
    """Case-insensitive; a name may be asked for with a suffix left out. A second registration is an error, a missing name a KeyError."""

    def __init__(self, name: str):
        self.name, self.items = name, {}

    def register(self, fn: Callable | None = None, suffix: str = ""):
        def add(fn):
            key = (fn.__name__ + (f"_{suffix}" if suffix else "")).lower()
            assert key not in self.items, f"{key} is already in {self.name}"
            self.items[key] = fn
            return fn

        return add if fn is None else add(fn)

    def get(self, name: str, suffix: str = "basic") -> Callable:
        for key in (name.lower(), f"{name}_{suffix}".lower()):
            if key in self.items:
                return self.items[key]
        raise KeyError(f"{name} is not in {self.name}")

    def __contains__(self, name: str) -> bool:
        return name.lower() in self.items


def strict(kind: type, values: dict) -> Any:
    """A dataclass from a dict; unknown fields are errors."""
    unknown = set(values) - {f.name for f in dataclasses.fields(kind)}
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return kind(**values)


def insert_nested(tree: dict, keys: list[str], value: Any) -> dict:
    at = tree
    for k in keys[:-1]:
        at = at.setdefault(k, {})
    at[keys[-1]] = value
    return tree


def build_tree(paths: list[tuple[str, Any]]) -> dict:
    out: dict = {}
    for path, value in paths:
        insert_nested(out, path.split("."), value)
    return out


def flatten(tree: dict, prefix: str = "") -> list[tuple[str, str]]:
    """(path, value as JSON) of each leaf; lists by index, unless their items have a type."""
    out = []
    for k, v in (tree.items() if isinstance(tree, dict) else ((str(i) if not isinstance(x, dict) or "type" not in x else x["type"], x) for i, x in enumerate(tree))):
        path = f"{prefix}.{k}" if prefix else str(k)
        out += flatten(v, path) if isinstance(v, (dict, list)) and v else [(path, json.dumps(v))]
    return out


def strip_common_prefix(keys: list[str], prefixes: list[str]) -> list[str]:
    for p in prefixes:
        if keys and all(k.startswith(p) for k in keys):
            return [k[len(p) :] for k in keys]
    return keys


def json_compatible(value: Any) -> bool:
    """Whether a value is of JSON's types all through; keys of objects must be texts."""
    if isinstance(value, dict):
        return all(isinstance(k, str) and json_compatible(v) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return all(map(json_compatible, value))
    return value is None or isinstance(value, (str, int, float, bool))


def dump_tree(tree: dict, depth: int = 1) -> str:
    """Nested options as indented text: a branch between key:[ and ]."""
    pad, out = "  " * depth, "\n"
    for k, v in tree.items():
        out += f"{pad}{k}:[{dump_tree(v, depth + 1)}{pad}]\n" if isinstance(v, dict) else f"{pad}{k}: {v}\n"
    return out

"""Options of a run (driver side): strict YAML, derived values, differences from a template, schemas and nested keys of states."""

from __future__ import annotations

import dataclasses
import inspect
import os
import random
import types
import typing
from collections.abc import Callable
from typing import Any

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructField, StructType

from pairloom.operators.registry import build_tree, strip_common_prefix


def typed(kind: Any, value: Any, path: str = "") -> Any:
    """value as kind (a dataclass, list, dict, union or plain type); unknown or missing fields and other types are errors that name the path."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if kind is Any:
        return value
    if origin in (typing.Union, types.UnionType):
        for one in args:
            try:
                return typed(one, value, path)
            except ValueError:
                continue
    elif dataclasses.is_dataclass(kind) and isinstance(value, dict):
        hints = typing.get_type_hints(kind)
        unknown = set(value) - {f.name for f in dataclasses.fields(kind) if f.init}
        if unknown:
            raise ValueError(f"{path or kind.__name__}: unknown fields {sorted(map(str, unknown))}")
        try:
            return kind(**{k: typed(hints[k], v, f"{path}.{k}".lstrip(".")) for k, v in value.items()})
        except TypeError as e:
            raise ValueError(f"{path or kind.__name__}: {e}") from e
    elif origin is list and isinstance(value, list):
        return [typed(args[0], v, f"{path}.{k}") for k, v in enumerate(value)]
    elif origin is dict and isinstance(value, dict):
        return {typed(args[0], k, path): typed(args[1], v, f"{path}.{k}") for k, v in value.items()}
    elif kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    elif kind in (types.NoneType, None) and value is None:
        return None
    elif isinstance(kind, type) and isinstance(value, kind) and (kind is bool or not isinstance(value, bool)):
        return value
    raise ValueError(f"{path}: {value!r} is no {kind}")


def load(text: str, kind: type) -> Any:
    """A dataclass from YAML text, strictly."""
    import yaml

    return typed(kind, yaml.safe_load(text))


def phase(name: str) -> str:
    """train, val or test of a dataset's name (val_2 is val)."""
    return name.split("_")[0]


def roots(value: str | list[str] | None) -> list[str] | None:
    """Always a list; ~ is the home folder."""
    return None if value is None else [os.path.expanduser(p) for p in ([value] if isinstance(value, str) else value)]


def seeded(configured: int | None, override: int | None = None) -> int:
    """The override, else what is configured, else a draw from 1024 to 10000; 0 counts as none."""
    return override or configured or random.randint(1024, 10000)


def derived_paths(root: str, name: str, training: bool) -> dict[str, str]:
    top = f"{root}/{'experiments' if training else 'results'}/{name}"
    shared = {"log": top, "visualization": f"{top}/visualization"}
    if not training:
        return {"results_root": top, **shared}
    return {"experiments_root": top, "models": f"{top}/models", "resume_models": f"{top}/models/resume_models", "training_states": f"{top}/training_states", **shared}


def differences(user: Any, template: Any, path: tuple[str, ...] = ()) -> list[tuple[str, Any]]:
    """(dotted path, the user's value) wherever it is not the template's; None for what the user left out. Lists of typed items are compared by type, other lists by place."""
    here = ".".join(path)
    if isinstance(user, dict) and isinstance(template, dict):
        own = [d for k, v in user.items() for d in (differences(v, template[k], (*path, str(k))) if k in template else [(".".join((*path, str(k))), v)])]
        return own + [(".".join((*path, str(k))), None) for k in template if k not in user]
    if not (isinstance(user, list) and isinstance(template, list)):
        return [] if user == template else [(here, user)]
    if all(isinstance(v, dict) and "type" in v for v in user + template):
        known = {v["type"]: v for v in template}
        changed = [v if v["type"] not in known else {"type": v["type"], **dict(differences(v, known[v["type"]]))} for v in user]
        changed = [c for c, v in zip(changed, user, strict=True) if v["type"] not in known or len(c) > 1]
        return [(here, changed)] if changed else []
    at = lambda v, k: v[k] if k < len(v) else None
    return [(f"{here}.{k}".lstrip("."), at(user, k)) for k in range(max(len(user), len(template))) if at(user, k) != at(template, k)]


def difference_text(user: str, template: str) -> str:
    """What a user's YAML has otherwise than a template, as YAML; empty where nothing differs."""
    import yaml

    tree = build_tree(differences(yaml.safe_load(user), yaml.safe_load(template)))
    return yaml.safe_dump(tree, sort_keys=False, allow_unicode=True) if tree else ""


def data_type(hint: Any) -> DataType | None:
    """Spark's type of a type hint; None for what is no plain value."""
    origin, args = typing.get_origin(hint), typing.get_args(hint)
    plain = {str: StringType(), bool: BooleanType(), int: LongType(), float: DoubleType()}
    if origin in (typing.Union, types.UnionType):
        found = [data_type(a) for a in args if a is not type(None)]
        return found[0] if len(found) == 1 else None
    if origin in (list, tuple) and args:
        inner = data_type(args[0])
        return inner and ArrayType(inner)
    if origin is dict:
        inner = data_type(args[1])
        return inner and MapType(StringType(), inner)
    return plain.get(hint)


def schema(fn: Callable) -> StructType:
    """Parameters of a function as fields; one without a default may not be null. Those of no plain type are left out."""
    hints = typing.get_type_hints(fn)
    fields = [(k, data_type(hints[k]), p.default is not inspect.Parameter.empty) for k, p in inspect.signature(fn).parameters.items() if k in hints]
    return StructType([StructField(k, t, optional) for k, t, optional in fields if t is not None])


#: Keys that a state may lie under, first come first served, and prefixes of its keys.
WRAPPERS = ("model_state_dict", "state_dict", "params_ema", "params-ema", "params", "model", "net")
PREFIXES = ("module.", "netG.")


def canonical(state: dict) -> tuple[dict, str | None]:
    """The inner state without shared prefixes, and the wrapper it lay under."""
    used = next((k for k in WRAPPERS if isinstance(state.get(k), dict)), None)
    state = state if used is None else state[used]
    if len(state) == 1 and isinstance(only := next(iter(state.values())), dict):
        state = only
    keys = list(state)
    for p in PREFIXES:
        keys = strip_common_prefix(keys, [p])
    return dict(zip(keys, state.values(), strict=True)), used

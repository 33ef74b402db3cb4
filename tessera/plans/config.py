"""Configurations as plain dictionaries turned into checked dataclasses."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import fields
from typing import TypeVar

from . import yaml_subset

T = TypeVar("T")


def find_config(name: str, folders: Sequence[str] = (".",)) -> str:
    """A configuration's file: a folder of its own with a pipeline in it, a path below a folder, a pipeline's name, each with or without ending; or any file."""
    endings = ("", ".json", ".yaml", ".yml")
    for folder in folders:
        for place in (os.path.join(name, "pipeline"), os.path.join(name, "config"), name, os.path.join("pipelines", name)):
            for ending in endings:
                if os.path.isfile(path := os.path.join(folder, place + ending)):
                    return path
    if os.path.isfile(name):
        return name
    raise FileNotFoundError(f"no configuration {name} in {', '.join(folders)}")


def load(path: str) -> dict:
    """A JSON or YAML file; without an installed parser YAML is read as far as configurations need it."""
    with open(path, encoding="utf-8") as file:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError:
                return yaml_subset.loads(file.read())
            return yaml.safe_load(file)
        return json.load(file)


def make(kind: type[T], values: Mapping) -> T:
    """The dataclass from a mapping; unknown names are errors."""
    known = {f.name for f in fields(kind)}  # type: ignore[arg-type]
    if unknown := set(values) - known:
        raise ValueError(f"{kind.__name__} has no {', '.join(sorted(unknown))}")
    return kind(**values)


def load_pipeline(name: str, kinds: Mapping[str, type], folders: Sequence[str] = (".",)) -> list[tuple[str, object]]:
    """The components of a pipeline's file, in order; a component's own values may lie in a file that it names."""
    out = []
    for entry in load(find_config(name, folders))["components_configs"]:
        ((kind, values),) = entry.items()
        if kind not in kinds:
            raise ValueError(f"no component {kind}; there are {', '.join(sorted(kinds))}")
        values = load(find_config(values, folders)) if isinstance(values, str) else values
        out.append((kind, make(kinds[kind], values)))
    return out


def without_finished(components: Sequence[tuple[str, dict]], finished: Sequence[str]) -> list[tuple[str, dict]]:
    """The components after the last finished one: how a run resumes."""
    at = max((i for i, (name, _) in enumerate(components) if name in finished), default=-1)
    return list(components[at + 1 :])

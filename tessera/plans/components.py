"""Components with declared inputs and outputs, checked before anything runs, and the pipeline that chains them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ..operators.merging import merge_result
from .storage import settle


class ContractError(ValueError):
    """What a component needs isn't there."""


@dataclass(frozen=True)
class Contract:
    requires_state: frozenset[str] = frozenset()
    requires_columns: frozenset[str] = frozenset()
    produces_state: frozenset[str] = frozenset()
    produces_columns: frozenset[str] = frozenset()

    def missing(self, state: Iterable[str], columns: Iterable[str]) -> list[str]:
        return [f"state {x}" for x in sorted(self.requires_state - set(state))] + [f"column {x}" for x in sorted(self.requires_columns - set(columns))]


@dataclass(frozen=True)
class State:
    """What components hand on: tables by name, among them objects."""

    tables: Mapping[str, DataFrame] = field(default_factory=dict)

    def with_table(self, name: str, df: DataFrame) -> State:
        return replace(self, tables={**self.tables, name: df})

    @property
    def columns(self) -> set[str]:
        return set(self.tables["objects"].columns) if "objects" in self.tables else set()


@dataclass(frozen=True)
class Result:
    """A component's outcome: a table for the objects, other tables, and whether the objects are new ones."""

    objects: DataFrame | None = None
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    objects_are_new: bool = False


@dataclass(frozen=True)
class Component:
    name: str
    contract: Contract
    run: Callable[[State], Result]
    number: int | None = None


def simulate(components: Sequence[Component], state: Iterable[str], columns: Iterable[str]) -> list[str]:
    """What would be missing where, from the contracts alone; no job runs."""
    have, there, out = set(state), set(columns), []
    for c in components:
        out += [f"{c.name}: {m}" for m in c.contract.missing(have, there)]
        have |= c.contract.produces_state
        there |= c.contract.produces_columns
    return out


@dataclass
class Pipeline:
    """Runs components in order and merges what they return; ``persist`` writes each stage, so that a run can resume."""

    components: Sequence[Component]
    persist: bool = False
    sinks: list[Callable[[str, State], None]] = field(default_factory=list)

    def __post_init__(self):
        self.components = [c if c.number is not None else replace(c, number=i) for i, c in enumerate(self.components)]

    def run(self, state: State) -> State:
        if problems := simulate(self.components, state.tables, state.columns):
            raise ContractError("; ".join(problems))
        for c in self.components:
            if problems := c.contract.missing(state.tables, state.columns):
                raise ContractError(f"{c.name}: {', '.join(problems)}")
            result = c.run(state)
            for name, df in result.tables.items():
                state = state.with_table(name, df)
            if result.objects is not None:
                merged = merge_result(result.objects, state.tables.get("objects"), result.objects_are_new)
                state = state.with_table("objects", settle(merged, f"{c.number}_{c.name}") if self.persist else merged)
            for sink in self.sinks:
                sink(f"{c.number}_{c.name}", state)
        return state


def run_standalone(component: Component, **tables: DataFrame) -> State:
    """One component by the same rules."""
    return Pipeline([component]).run(State(tables))

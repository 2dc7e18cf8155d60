"""Replaceable components by name: functions of DataFrames, checked before anything runs."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

#: What a component has: ``core`` turns regions into evidence, ``bind`` puts evidence into a batch.
COMPONENTS = ("page_number", "page_type", "biblio", "chapter")


@dataclass(frozen=True)
class Engine:
    module: str
    function: str
    needs: tuple[str, ...] = ()


@dataclass
class Registry:
    engines: dict[tuple[str, str], Engine] = field(default_factory=dict)

    def register(self, component: str, name: str, module: str, function: str, needs: tuple[str, ...] = ()) -> None:
        if component not in COMPONENTS:
            raise ValueError(f"no such component: {component}")
        if (component, name) in self.engines:
            raise ValueError(f"{component} has an engine {name} already")
        self.engines[component, name] = Engine(module, function, needs)

    def preflight(self, wanted: Mapping[str, str]) -> None:
        """Every name must be known and every module importable; all faults are told at once."""
        faults = []
        for component, name in wanted.items():
            engine = self.engines.get((component, name))
            if engine is None:
                faults.append(f"{component}: no engine {name!r}")
                continue
            faults += [f"{component}: module {m} is missing" for m in (engine.module, *engine.needs) if importlib.util.find_spec(m.partition(".")[0]) is None]
        if faults:
            raise ValueError("; ".join(faults))

    def load(self, component: str, name: str) -> Callable[..., DataFrame]:
        """The engine's function; its module is imported only now."""
        self.preflight({component: name})
        engine = self.engines[component, name]
        return getattr(importlib.import_module(engine.module), engine.function)


def merged(base: Mapping, over: Mapping) -> dict:
    """``base`` with ``over`` laid on it, mapping by mapping; other values are replaced whole."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def assigned(config: Mapping, path: str, value) -> dict:
    """``config`` with the value at a path of keys parted by colons; the path's mappings are made where they are missing."""
    first, _, rest = path.partition(":")
    if not first:
        raise ValueError("empty key in a path")
    out = dict(config)
    if rest:
        inner = out.get(first, {})
        if not isinstance(inner, Mapping):
            raise ValueError(f"{first} is no mapping")
        out[first] = assigned(inner, rest, value)
    else:
        out[first] = value
    return out

"""Plugins: feature engineering on one frame, postprocessing on the frame of all splits."""

from __future__ import annotations

import importlib
import inspect
from abc import ABC, abstractmethod
from enum import Enum
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame


class State(Enum):
    DISCOVERED, LOADED, INITIALIZED, READY, FAILED = "discovered", "loaded", "initialized", "ready", "failed"


class Plugin(ABC):
    """A frame-to-frame step.  ``dependencies`` are names of plugins that run before it."""

    name = "plugin"
    version = "1.0"
    dependencies: tuple[str, ...] = ()
    preserve_original_features = True

    def __init__(self, config: dict | None = None):
        self.config = config or {}
        self.state = State.LOADED
        self.history: list[dict] = []

    def info(self) -> dict:
        return {"name": self.name, "version": self.version, "dependencies": list(self.dependencies), "state": self.state.value}

    def initialize(self) -> None:
        self.state = State.READY

    def cleanup(self) -> None:
        self.state = State.LOADED

    def validate_input(self, df: DataFrame) -> list[str]:
        """What is wrong with the input; empty if nothing is."""
        return []

    def should_execute(self, df: DataFrame) -> bool:
        return True

    @abstractmethod
    def transform(self, df: DataFrame) -> DataFrame: ...

    def process(self, df: DataFrame, check_rows: bool = False) -> DataFrame:
        if self.state is not State.READY:
            raise RuntimeError(f"{self.name} is not initialised")
        if wrong := self.validate_input(df):
            raise ValueError(f"{self.name}: {'; '.join(wrong)}")
        if not self.should_execute(df):
            self.history.append({"skipped": True})
            return df
        out = self.transform(df)
        self.validate_output(df, out)
        if check_rows and out.count() != df.count():
            raise ValueError(f"{self.name} changed the number of rows")
        self.history.append({"columns": out.columns})
        return out

    def validate_output(self, df: DataFrame, out: DataFrame) -> None:
        if not isinstance(out, DataFrame):
            raise ValueError(f"{self.name} returned no frame")
        if self.preserve_original_features and not set(df.columns) <= set(out.columns):
            raise ValueError(f"{self.name} lost columns")


class FeaturePlugin(Plugin):
    """Adds features; the rows stay."""


class PostprocessingPlugin(Plugin):
    """Runs on the frame of all datasets and keeps its ``split`` column."""

    preserve_original_features = False

    def validate_output(self, df: DataFrame, out: DataFrame) -> None:
        super().validate_output(df, out)
        if "split" in df.columns and "split" not in out.columns:
            raise ValueError(f"{self.name} lost the datasets")


class PluginPipeline:
    """Plugins in order; one that fails is reported and skipped.

    Frames are lazy: what is wrong with a plan shows at once, what is wrong with rows only
    when they are computed.  ``eager_check`` runs each step once to isolate that too.
    """

    def __init__(self, plugins: list[Plugin] | None = None, eager_check: bool = False):
        self.plugins: list[Plugin] = []
        self.eager_check = eager_check
        for p in plugins or []:
            self.add(p)

    def add(self, plugin: Plugin) -> None:
        if not isinstance(plugin, Plugin):
            raise TypeError("not a plugin")
        self.plugins.append(plugin)

    def plan(self, df: DataFrame) -> list[dict]:
        return [p.info() | {"will_execute": p.should_execute(df)} for p in self.plugins]

    def process(self, df: DataFrame) -> tuple[DataFrame, list[dict]]:
        report = []
        for p in self.plugins:
            try:
                if p.state is State.LOADED:
                    p.initialize()
                out = p.process(df)
                if self.eager_check:
                    out.write.format("noop").mode("overwrite").save()
                report.append({"plugin": p.name, "ok": True, "new_columns": [c for c in out.columns if c not in df.columns]})
                df = out
            except Exception as e:  # a plugin's own fault must not stop the others
                p.state = State.FAILED
                report.append({"plugin": p.name, "ok": False, "error": str(e)})
        return df, report


def from_spec(spec: str | dict) -> Plugin:
    """A plugin that a configuration names: ``module:Class``, or ``{"class": "module:Class", "config": {...}}``."""
    spec = {"class": spec} if isinstance(spec, str) else spec
    module, _, name = spec["class"].partition(":")
    made = getattr(importlib.import_module(module), name)(spec.get("config"))
    if not isinstance(made, Plugin):
        raise TypeError(f"{spec['class']} is no plugin")
    return made


class Registry:
    """Plugins by name, from classes or modules, in the order of their dependencies."""

    def __init__(self):
        self.classes: dict[str, type[Plugin]] = {}

    def register(self, cls: type[Plugin]) -> type[Plugin]:
        self.classes[cls.name] = cls
        return cls

    def discover(self, module: str) -> list[str]:
        found = [c for _, c in inspect.getmembers(importlib.import_module(module), inspect.isclass) if issubclass(c, Plugin) and not inspect.isabstract(c)]
        return [self.register(c).name for c in found]

    def load(self, name: str, config: dict | None = None) -> Plugin:
        if name not in self.classes:
            raise ImportError(f"no plugin {name}")
        return self.classes[name](config)

    def order(self, names: list[str]) -> list[str]:
        unknown = {d for n in names for d in self.classes[n].dependencies} - set(names)
        if unknown:
            raise ValueError(f"unknown dependencies: {', '.join(sorted(unknown))}")
        try:
            return list(TopologicalSorter({n: self.classes[n].dependencies for n in names}).static_order())
        except CycleError as e:
            raise ValueError(f"dependencies form a cycle: {e.args[1]}") from e

"""Configuration: defaults < file < environment < command line, with provenance."""

from __future__ import annotations

import json
import os
from copy import deepcopy

DEFAULTS = {
    "data_handling": {"supported_formats": ["csv", "parquet", "json"], "timestamp_column": "timestamp"},
    "data_splitting": {"ratios": {"d1": 0.4, "d2": 0.2, "d3": 0.2, "d4": 0.1, "d5": 0.05, "d6": 0.05}, "method": "temporal", "random_seed": None},
    "normalization": {"method": "zscore", "training_datasets": ["d1", "d2"], "exclude": [], "range": [-1.0, 1.0]},
    "feature_engineering": {"plugins": []},
    "postprocessing": {"plugins": []},
    "export": {"format": "csv", "path": "./output", "export_normalization_params": True},
}
PREFIX = "CHRONOPREP_"


def merged(base: dict, more: dict) -> dict:
    out = deepcopy(base)
    for k, v in more.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else deepcopy(v)
    return out


class Configuration:
    def __init__(self):
        self.sources: list[tuple[int, str, dict]] = [(1, "defaults", DEFAULTS)]

    def add(self, priority: int, name: str, values: dict) -> Configuration:
        self.sources.append((priority, name, values))
        return self

    def add_file(self, path: str) -> Configuration:
        with open(path) as f:
            if path.endswith((".yml", ".yaml")):
                import yaml

                return self.add(2, path, yaml.safe_load(f) or {})
            return self.add(2, path, json.load(f))

    def add_environment(self, env: dict[str, str] | None = None) -> Configuration:
        """``CHRONOPREP_SECTION__KEY`` (or one underscore for each level) as JSON or text."""
        for name, text in (os.environ if env is None else env).items():
            if name.startswith(PREFIX):
                path = name[len(PREFIX) :].lower()
                section = next((s for s in DEFAULTS if path.startswith(s)), None)
                keys = [section, *path[len(section) :].strip("_").split("__")] if section else path.split("_")
                try:
                    value = json.loads(text)
                except ValueError:
                    value = text
                self.set(".".join(k for k in keys if k), value, 3, name)
        return self

    def add_arguments(self, values: dict) -> Configuration:
        return self.add(4, "command line", values)

    def set(self, dotted: str, value, priority: int = 4, name: str = "set") -> Configuration:
        for k in reversed(dotted.split(".")):
            value = {k: value}
        return self.add(priority, name, value)

    @property
    def values(self) -> dict:
        out: dict = {}
        for _, _, v in sorted(self.sources, key=lambda s: s[0]):
            out = merged(out, v)
        return out

    def get(self, dotted: str, default=None):
        at = self.values
        for k in dotted.split("."):
            if not isinstance(at, dict) or k not in at:
                return default
            at = at[k]
        return at

    def has(self, dotted: str) -> bool:
        missing = object()
        return self.get(dotted, missing) is not missing

    def errors(self) -> list[str]:
        v, out = self.values, []
        ratios = v["data_splitting"]["ratios"]
        if abs(sum(ratios.values()) - 1) > 0.001:
            out.append(f"the sum of the split ratios must be 1.0, not {sum(ratios.values())}")
        out += [f"training dataset {k} is no dataset" for k in v["normalization"]["training_datasets"] if k not in ratios]
        if v["normalization"]["method"] not in ("zscore", "minmax", "robust", "none"):
            out.append(f"unknown normalization method {v['normalization']['method']}")
        if v["data_splitting"]["method"] not in ("temporal", "random", "sequential", "stratified"):
            out.append(f"unknown split method {v['data_splitting']['method']}")
        return out

    def summary(self) -> list[dict]:
        return [{"priority": p, "source": n, "sections": sorted(v)} for p, n, v in sorted(self.sources, key=lambda s: s[0])]

    def save(self, path: str, only_changes: bool = False) -> None:
        changed = lambda new, old: {
            k: changed(v, old[k]) if isinstance(v, dict) and isinstance(old.get(k), dict) else v for k, v in new.items() if k not in old or old[k] != v
        }
        with open(path, "w") as f:
            json.dump(changed(self.values, DEFAULTS) if only_changes else self.values, f, indent=2)

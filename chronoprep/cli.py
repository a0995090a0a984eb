"""Command line: load, prepare, export.  Exit codes: 0 fine, 1 failed, 130 interrupted."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .functions.scalars import convert_type
from .plans.config import Configuration
from .plans.pipeline import Preparation


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronoprep")
    p.add_argument("input", nargs="?")
    p.add_argument("--config")
    p.add_argument("--output")
    p.add_argument("--format", choices=["csv", "parquet", "json"])
    p.add_argument("--split-ratios", nargs=6, type=float)
    p.add_argument("--split-method", choices=["temporal", "random", "sequential", "stratified"])
    p.add_argument("--normalization", choices=["zscore", "minmax", "robust", "none"])
    p.add_argument("--timestamp-column")
    p.add_argument("--order-by", nargs="+")
    p.add_argument("--set", nargs=2, action="append", default=[], metavar=("KEY", "VALUE"))
    p.add_argument("--feature-plugins", nargs="+", metavar="MODULE:CLASS")
    p.add_argument("--postprocessing-plugins", nargs="+", metavar="MODULE:CLASS")
    p.add_argument("--save-config")
    p.add_argument("--validate-only", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return p


def configuration(a: argparse.Namespace) -> Configuration:
    c = Configuration()
    if a.config:
        c.add_file(a.config)
    c.add_environment()
    if a.split_ratios:
        c.set("data_splitting.ratios", dict(zip(("d1", "d2", "d3", "d4", "d5", "d6"), a.split_ratios)))
    for key, value in (("data_splitting.method", a.split_method), ("normalization.method", a.normalization), ("export.format", a.format), ("export.path", a.output), ("data_handling.timestamp_column", a.timestamp_column), ("feature_engineering.plugins", a.feature_plugins), ("postprocessing.plugins", a.postprocessing_plugins)):
        if value is not None:
            c.set(key, value)
    for key, value in a.set:
        c.set(key, convert_type(value))
    return c


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        c = configuration(a)
        if wrong := c.errors():
            print("\n".join(wrong), file=sys.stderr)
            return 1
        if a.save_config:
            c.save(a.save_config)
            return 0
        if a.validate_only:
            return 0
        job = Preparation(SparkSession.builder.getOrCreate(), c).load(a.input)
        job.process(a.order_by)
        if not a.dry_run:
            print(job.export())
        return 0
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())

"""The registered queries of this package and their SQL."""

from __future__ import annotations

from . import bpe, chat, lines, mixing, neardup, suffix, toxicity, vectors, warc

_MODULES = [chat, vectors, suffix, neardup, toxicity, warc, bpe, mixing, lines]


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}

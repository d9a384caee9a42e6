"""Operators for large text corpora; nothing else in the library imports this subpackage."""

from __future__ import annotations

import importlib

_QUERY_MODULES = ["queries"]


def query_modules() -> list:
    return [importlib.import_module(f"{__name__}.{m}") for m in _QUERY_MODULES]

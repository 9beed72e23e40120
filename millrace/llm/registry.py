"""All queries of the llm operators, and their SQL where it can express them."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("repetition", "stuffing", "language", "markup", "scans", "packing", "mixing", "names", "matching")

QUERIES: dict = {}
SQL: dict = {}
for _name in MODULES:
    _module = import_module(f"millrace.llm.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL

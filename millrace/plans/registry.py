"""All queries of the core, and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("nested_queries", "job_queries", "case_queries", "structure_queries", "text_queries", "catalog_queries", "line_queries", "box_queries", "web_queries", "record_queries", "document_queries")

QUERIES: dict = {}
SQL: dict = {}
for _name in MODULES:
    _module = import_module(f"millrace.plans.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL

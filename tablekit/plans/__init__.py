"""Whole jobs over the sample tables, each with the SQL that states the same result."""

from __future__ import annotations

from . import converting, copying, deciding, governing, moving, reporting, scanning, tracking

MODULES = (moving, copying, tracking, governing, scanning, deciding, converting, reporting)


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}

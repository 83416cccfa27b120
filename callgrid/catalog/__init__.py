"""Registered queries: each operator applied to whole shared tables, with the same result stated in SQL."""

from __future__ import annotations

import importlib

from .base import ORACLES, QUERIES

_MODULES = (
    "text", "calendars", "cleaning", "filters", "joins", "aggregates", "windows", "series", "intervals", "ranking",
    "scoring", "modeling", "spatial", "plans", "storage", "streams",
)

for _m in _MODULES:
    importlib.import_module(f".{_m}", __name__)

__all__ = ["QUERIES", "ORACLES"]

"""DuckDB SQL for every catalog query, written apart from the Spark code.

Texts use ``{name}`` for the planning views; ``oracle_sql`` puts their definitions in front.
"""

from __future__ import annotations

import importlib

from spotgrid.sources.binding import with_views

MODULES = ("calendar", "context", "inventory", "reports", "daily", "details", "editable", "choices", "reach", "save", "prepare")


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in MODULES:
        for name, text in importlib.import_module(f"oracle.{module}").SQL.items():
            out[name] = with_views(text)
    return out

"""DuckDB SQL that has to return what the registered queries return."""

from __future__ import annotations

import importlib
import pkgutil


def collect() -> dict[str, str]:
    found: dict[str, str] = {}
    for module in pkgutil.iter_modules(__path__):
        found.update(getattr(importlib.import_module(f"{__name__}.{module.name}"), "ORACLES", {}))
    return found

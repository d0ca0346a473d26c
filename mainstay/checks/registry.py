"""All registered queries and their comparison SQL."""

from __future__ import annotations

import importlib
import pkgutil

from mainstay import checks
from mainstay.checks.common import Query
from mainstay.checks.views import prelude


def _modules() -> list:
    names = sorted(m.name for m in pkgutil.iter_modules(checks.__path__) if m.name.startswith("registry_"))
    return [importlib.import_module(f"{checks.__name__}.{name}") for name in names]


def all_queries() -> dict[str, Query]:
    return {name: query for module in _modules() for name, query in module.Q.items()}


def all_sql() -> dict[str, str]:
    return {name: prelude(text) for module in _modules() for name, text in module.SQL.items()}

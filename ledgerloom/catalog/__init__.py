"""All registered queries."""

import importlib

from ledgerloom.catalog.registry import CHECKS, PLANS, as_callables

SECTIONS = (
    "scalars", "facts", "merge", "records", "inventory", "web", "narrative", "quality", "html", "files", "report",
)

for _section in SECTIONS:
    importlib.import_module(f"ledgerloom.catalog.{_section}")

__all__ = ["CHECKS", "PLANS", "as_callables"]

"""Named queries over the sample tables, with SQL equivalents where they exist."""

from importlib import import_module

from tabkit.catalog.registry import QUERIES, SQL

for _part in ("sources_quality", "statistics", "evaluation", "learning", "language"):
    import_module(f"tabkit.catalog.{_part}")

__all__ = ["QUERIES", "SQL"]

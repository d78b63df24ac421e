"""SQL that DuckDB runs on the same tables, one statement per registered query."""

from oracle.statements import statements  # noqa: F401

__all__ = ["statements"]

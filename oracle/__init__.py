"""Independent SQL statements of the expected results, for a single-node engine."""

from oracle.statements import statements

__all__ = ["statements"]

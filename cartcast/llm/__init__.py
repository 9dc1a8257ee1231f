"""Training-data operators: the corpus operators and their registered queries.

``QUERIES`` and ``ORACLE`` hold what ``__spark_entry__.py`` adds to the
library's own registry. Nothing else in the library imports this subpackage.
"""

from __future__ import annotations

from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

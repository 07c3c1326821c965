"""All registered queries and the SQL they are compared with."""

from tablehandoff.registry import changes, contracts, delivery, numbered, tables, texts, versions  # noqa: F401
from tablehandoff.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

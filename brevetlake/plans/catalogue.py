"""Every query of the library by name, and the SQL that checks it."""

from . import queries_domain, queries_io, queries_matching, queries_relational, queries_text  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

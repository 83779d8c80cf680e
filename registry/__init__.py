"""The driver's queries: inputs mapped from its tables, Spark plans and SQL oracles."""

from . import activity, catalog, churning, documents, exports, networks, reporting, scores, streams  # noqa: F401
from .core import QUERIES

__all__ = ["QUERIES"]

exports.register()

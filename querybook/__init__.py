"""Registered queries over the test tables, each with its SQL counterpart."""

from querybook import allocation, consolidated, endtoend, gold, ingest, quality, silver  # noqa: F401
from querybook.registry import BUILDERS, ORACLES, QUERIES  # noqa: F401

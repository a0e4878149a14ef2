"""Runnable queries over the test tables, each with an equivalent in plain SQL."""

from . import aggregates, domain, filters, functions, io, joins, quality, targets, updates  # noqa: F401
from .registry import CASES, queries, sql_twins  # noqa: F401

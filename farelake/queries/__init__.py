"""Registered queries, one module per group of operators."""

from . import analytics, monitoring, star, storage, zones  # noqa: F401

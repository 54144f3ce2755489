"""Registered queries, each paired with the SQL it is checked against."""

from clinicpulse.registry import analytics, clinic, primitives, runs  # noqa: F401  (registering)
from clinicpulse.registry.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

"""Imports every query module so that the registry is complete."""

from starlift.plans import q_analytics, q_basket, q_conform, q_quality, q_text, q_warehouse  # noqa: F401
from starlift.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]

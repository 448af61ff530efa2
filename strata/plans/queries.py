"""Imports every query module so the registry is complete."""

from strata.plans import q_incremental, q_layers, q_loads, q_quality, q_sources  # noqa: F401
from strata.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

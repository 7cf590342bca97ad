"""Loads every query module; import this to fill the registry."""

from tastegrid.plans import experimenting, guarding, monitoring, ratings, retrieving, serving, storing  # noqa: F401
from tastegrid.plans.registry import ORACLE, QUERIES  # noqa: F401

"""Queries that run the operators on the supplied tables, and the SQL giving the same rows."""

from gridpulse.checks.oracles import ORACLES
from gridpulse.checks.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]

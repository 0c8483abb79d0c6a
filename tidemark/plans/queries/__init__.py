"""Registered queries by family."""

from . import documents, history, ledgers, paging, warehouses
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "documents", "history", "ledgers", "paging", "warehouses"]

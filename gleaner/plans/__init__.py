"""The registered queries, grouped as the operators are."""

from . import inputs, kinds, trees, shape, links, ledger, text, streams  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

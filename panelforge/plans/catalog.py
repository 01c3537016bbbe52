"""All registered queries."""

from __future__ import annotations

from . import q_blocks, q_features, q_intraday, q_round_trips, q_signals, q_tables, q_windows  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

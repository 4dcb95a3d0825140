"""Joins on keys of which one may hold a third of all rows, and connected components."""

from __future__ import annotations

from quillmill.operators.components import SALTS, connected_components, salted_join

__all__ = ["SALTS", "connected_components", "salted_join"]

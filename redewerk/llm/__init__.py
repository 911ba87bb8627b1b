"""Operators for training data. Nothing outside this subpackage imports it."""

from __future__ import annotations

# imported here, so that a missing dependency shows when the subpackage is imported, not when queries are listed
from . import defects, encoding, leaks, names, overlaps, packing, pieces, scans, splits, turns

MODULES = (splits, overlaps, names, pieces, scans, defects, turns, packing, leaks, encoding)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}

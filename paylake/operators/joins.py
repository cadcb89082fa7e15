"""Broadcast behind a counted size bound.

Catalyst's static estimate multiplies the sizes of joined inputs (no CBO),
so a small joined dimension can look huge and the large side gets picked for
broadcast instead.  ``bounded_broadcast`` counts rows of a materialised or
base table (a Parquet count reads only footers) and hints broadcast only
under the bound; above it the join is left to the planner (sort-merge, with
AQE's runtime re-planning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ~50 bytes/row for the narrow sides broadcast here: 1M rows ~ 50 MB.
DEFAULT_MAX_ROWS = 1_000_000

_SCAN_ROWS: dict[tuple, int] = {}


def scan_rows(df: DataFrame) -> int:
    """Row count of an unfiltered table scan (projections allowed), cached
    per exact set of input file paths (Spark gives rewritten files new names,
    and added files change the set).  The count only steers a broadcast
    decision, never a result."""
    key = tuple(sorted(df.inputFiles()))
    if not key:
        return df.count()
    if key not in _SCAN_ROWS:
        _SCAN_ROWS[key] = df.count()
    return _SCAN_ROWS[key]


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``.

    ``rows`` may be passed when an upper bound is known from a cheaper count
    (e.g. the base table of a key-preserving join)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= max_rows else df

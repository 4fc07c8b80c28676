"""The registered queries, each next to the SQL that must give the same rows.

Importing the section modules fills ``QUERIES`` and ``ORACLES``.
"""

from tallywatch.queries import (  # noqa: F401
    gold,
    joins,
    report,
    rows,
    streams,
    summaries,
    tables,
    windows,
)
from tallywatch.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

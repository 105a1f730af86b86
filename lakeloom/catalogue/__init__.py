"""Every operator as a query over the test tables, next to the SQL that checks it."""

from lakeloom.catalogue import (  # noqa: F401  (each module registers its queries)
    aggregation,
    domain,
    governance,
    histories,
    joining,
    maintenance,
    ordering,
    quality,
    relational,
    scalars,
    scans,
    streams,
)
from lakeloom.catalogue.registry import ENTRIES, Tables

__all__ = ["ENTRIES", "Tables"]

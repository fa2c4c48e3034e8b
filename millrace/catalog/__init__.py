"""Queries over the shared test tables, each with an independent SQL form."""

from millrace.catalog import (  # noqa: F401
    aggregates,
    attribution,
    functions,
    joins,
    maintenance,
    nested,
    projections,
    quality,
    reservations,
    roundtrips,
    sources,
    streams,
    texts,
    windows,
)
from millrace.catalog.registry import QUERIES, Query  # noqa: F401

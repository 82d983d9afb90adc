"""Importing this package registers every query."""

from tidewatch.plans.catalog import (  # noqa: F401
    aggregates,
    evaluation,
    inputs,
    joining,
    live,
    models,
    projections,
    quality,
    similarity,
    streams,
    windows,
)

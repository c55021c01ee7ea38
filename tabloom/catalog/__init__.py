"""Named queries over the given tables. Importing this package registers all of them."""

from tabloom.catalog import additions, aggregates, builds, dictionaries, facts, io, models, nearest, ranges, sampling, statistics, wrangling  # noqa: F401
from tabloom.catalog.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

"""Named queries over the test tables, each with the SQL it must agree with where SQL can say it."""

from .core import ORACLE, QUERIES
from . import cleaning, domains, files, loads, partials, personal, quality, reports, runs, scalars, stateful, streams, upkeep  # noqa: F401 - registration

__all__ = ["ORACLE", "QUERIES"]

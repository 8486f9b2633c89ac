"""Queries that exercise the operators on the test tables."""

from . import (  # noqa: F401
    aggregation,
    calendar_gaps,
    cleaning,
    datasets,
    expressions,
    files,
    gridded,
    incremental,
    joining,
    keeping,
    moving,
    moving_state,
    reshaping,
    shapes,
    targets,
)
from .registry import QUERIES, SQL  # noqa: F401

"""Queries of the engine's operators over the test tables, with SQL that gives the same rows."""

from filmstrip.catalog import aggregates, files, folds, joins, pipelines, retrieval, scalars, strategies, streams, windows  # noqa: F401
from filmstrip.catalog.base import QUERIES, SQL  # noqa: F401

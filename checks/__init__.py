"""Queries over the given tables, each with an independent SQL form."""

from checks import boxes, catalogs, curation, extras, publish, samples, staged  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401

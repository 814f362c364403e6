"""Importing this package registers every query."""

from tallyfold.plans.queries import cases, expressions, geography, groups, reporting, sources, statistics, weather  # noqa: F401

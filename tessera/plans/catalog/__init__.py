"""Importing this package registers every query."""

from tessera.plans.catalog import aggs, cleaning, dates, encode, mining, numeric, relate, stages, text, windows  # noqa: F401

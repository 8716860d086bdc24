"""Registered queries over the test tables, each with the SQL that states its result."""

from . import cleaning, modelling, pipeline, statistics


def all_queries() -> dict:
    found = {}
    for module in (statistics, cleaning, modelling, pipeline):
        found.update(module.QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    found = {}
    for module in (statistics, cleaning, modelling, pipeline):
        found.update(module.ORACLES)
    return found

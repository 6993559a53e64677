"""Queries over the given tables, each with an independent SQL text."""

from checks import accounts, files, grids, observations, planning

MODULES = (observations, planning, grids, accounts, files)


def queries():
    return {name: run for module in MODULES for name, run in module.CHECKS.queries.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.CHECKS.oracles.items()}

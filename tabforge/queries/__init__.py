"""Registered queries: each operator over whole tables, with its SQL twin where SQL can say it."""

from tabforge.queries.registry import QUERIES, SQL

from tabforge.queries import (  # noqa: E402,F401
    calibrating,
    columns,
    encoding,
    exact_cases,
    gaps,
    joining,
    modelling,
    nets,
    profiling,
    regression,
    rowwise,
    scaling,
    scoring,
    searching,
    selecting,
    sources,
    splitting,
    trees,
    twins,
)

__all__ = ["QUERIES", "SQL"]

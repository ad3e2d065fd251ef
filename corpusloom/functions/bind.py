"""Bind an intermediate value so that a larger expression evaluates it once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside a higher-order function Catalyst re-evaluates captured expressions for every
    element; a one-element ``transform`` turns the value into a lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def keep_if(row: Column, test: Callable[[Column], Column]) -> Column:
    """Generator that gives the fields of a struct as columns when they pass, and no row otherwise.

    A plain ``filter`` on a computed column is pushed below its projection, which computes the
    column twice: once to test it, once to return it.
    """
    return F.inline(F.filter(F.array(row), test))


def computed(**columns: Column) -> Column:
    """Generator that gives the named columns, computed once, as plain attributes.

    The optimiser does not merge projections across a generator. Put one in front of a Python
    function whose input is a large expression, so that the expression stays out of its call.
    """
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))

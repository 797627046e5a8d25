"""Evaluate an expression once and use its value several times.

Catalyst may inline a computed column into every place that uses it, even into a
lambda that runs once per array element. A lambda parameter is never inlined, so
a one-element array binds the value. Lambdas are given as Spark SQL text: one
parse instead of a driver round trip per function call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: str) -> Column:
    """``body``, a SQL lambda such as ``"h -> upper(h)"``, over ``value``."""
    return F.call_function("transform", F.array(value), F.expr(body)).getItem(0)


def let_sql(value: str, body: str) -> str:
    """The same inside SQL text."""
    return f"transform(array({value}), {body})[0]"


def pattern(regex: str) -> str:
    """A regular expression as a raw SQL literal."""
    return "r'" + regex.replace("'", r"\x27") + "'"

"""Column expressions that several operators share.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed
and carriage return; every operator of this package splits texts this way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six separators, for trimming, and as a class for Java's regular expressions.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, even where lambdas refer to it.

    Catalyst would otherwise copy the expression into each lambda, which then evaluates it for each
    element of an array.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def word_count(text: Column) -> Column:
    """The number of words, without an array of them."""
    body = F.rtrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.length(F.regexp_replace(body, SPACE_CLASS + r"*+[^ \t-\r]++", "x")).cast("long")


def char_count(text: Column, kept: str) -> Column:
    """The number of characters in the class ``kept`` (the inside of a bracket expression)."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{kept}]++", "")).cast("long")

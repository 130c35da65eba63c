"""Column expressions that the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\v\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, also where body's lambdas use it many times."""
    return F.transform(F.array(value), body)[0]


def blank_words(text: Column) -> Column:
    """The runs of anything but BLANKS, as an array; NULL has none."""
    spaced = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def neighbours(words: Column, size: int) -> list[Column]:
    """`size` arrays whose k-th elements are the words of the k-th window; all empty when there is no window."""
    windows = F.greatest(F.size(words) - (size - 1), F.lit(0))
    return [F.slice(words, k + 1, windows) for k in range(size)]

"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of the contracts, and the letters that lower-case.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores added while a column of ``taken`` has them."""
    used = {name.lower() for name in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are; pure ASCII text takes the quicker way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The runs of other than white space, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", -1), lambda w: w != "")

"""Shared pieces of the registered queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainstay.checks.views import Inputs

Query = Callable[[Inputs], DataFrame]

YEAR = 2024
AS_OF = dt.date(2024, 1, 20)
SEVERE = [1003, 1007, 1011, 1013, 1019, 1023, 1029, 1031, 1037, 1041, 1047, -1, -1, -1, -1]
SEVERE_SQL = "(1003, 1007, 1011, 1013, 1019, 1023, 1029, 1031, 1037, 1041, 1047)"


# Added before rounding money on both sides, so that exact halves fall the same way.
NUDGE = 1e-7


def rounded(df: DataFrame, names: list[str], digits: int = 4, nudge: float = 0.0) -> DataFrame:
    """Columns rounded in place; the sum with 0 turns -0.0 into 0.0."""
    return df.withColumns({n: F.round(F.col(n) + F.lit(nudge), digits) + F.lit(0.0) for n in names})

"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Hart's rational form of the normal tail as
# published by G. West, "Better approximations to cumulative normal functions"
# (2005), highest power first. Absolute error about 1e-15; tails below 1e-12 keep
# nine digits.
TAIL_NUMERATOR = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
TAIL_DENOMINATOR = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
TAIL_SWITCH = 7.07106781186547
ROOT_TWO_PI = 2.506628274631


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def zero(value: Column | str) -> Column:
    """NULL read as 0."""
    return F.coalesce(col(value), F.lit(0))


def total(*values: Column | str) -> Column:
    """Sum of columns where a NULL counts as 0."""
    return reduce(lambda a, b: a + b, [zero(v) for v in values])


def strict_total(*values: Column | str) -> Column:
    """Sum of columns where a NULL makes the sum NULL."""
    return reduce(lambda a, b: a + b, [col(v) for v in values])


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def all_known(names: list[str]) -> Column:
    """No column of the list is NULL."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def same_text(left: Column | str, right: Column | str) -> Column:
    """Equality without regard to case; NULL stays unknown."""
    left = col(left)
    right = F.lit(right) if isinstance(right, str) else right
    return F.lower(left) == F.lower(right)


def is_unit_id(value: Column | str) -> Column:
    """Three letters and three digits, with at most one trailing blank."""
    return col(value).rlike("(?i)^[A-Z]{3}[0-9]{3} ?$")


def has_replacement_prefix(material: Column | str) -> Column:
    """Materials stamped as a repair: a 2, any one character, anything."""
    return col(material).rlike("(?s)^2.")


def append_note(note: Column | str, text: str, keep_null: bool = False) -> Column:
    """Append ``text``. With ``keep_null`` a missing note stays missing."""
    base = col(note) if keep_null else F.coalesce(col(note), F.lit(""))
    return F.concat(base, F.lit(text))


def mean_depth(up: Column | str = "udepth", down: Column | str = "ddepth") -> Column:
    return (col(up) + col(down)) / 2.0


def _polynomial(coefficients: tuple[float, ...], z: Column) -> Column:
    return reduce(lambda acc, c: acc * z + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, computed directly so that small tails keep their digits."""
    a = F.abs(z)
    density = F.exp(-(a * a) / 2.0)
    near = density * _polynomial(TAIL_NUMERATOR, a) / _polynomial(TAIL_DENOMINATOR, a)
    fraction = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        fraction = a + F.lit(k) / fraction
    far = density / fraction / ROOT_TWO_PI
    tail = F.when(a > 37.0, F.lit(0.0)).when(a < TAIL_SWITCH, near).otherwise(far)
    return F.when(z > 0, tail).otherwise(1.0 - tail)


def normal_cdf(x: Column | str, mean: Column | str, sd: Column | str) -> Column:
    """Cumulative normal distribution with the given mean and standard deviation."""
    return upper_tail((col(mean) - col(x)) / col(sd))


def factor_power(n: Column, exact: bool = False) -> Column:
    """1.5 to the power n, kept to one decimal unless ``exact``."""
    value = F.pow(F.lit(1.5), n)
    return value if exact else F.round(value, 1)

"""Scalar helpers on columns: numbers, missing values, text.

Missing is always SQL null. NaN and infinity are turned into null, and a
division by zero is null, whether or not ANSI mode is on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number; `1d`, `nan` and `inf`, which a cast would accept, are not.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value as a double, null when it is NaN or infinite."""
    x = as_column(c).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def number(c: Column | str) -> Column:
    """Text to double; letter codes and other text become null."""
    text = as_column(c)
    return finite(F.when(text.rlike(NUMBER_TEXT), text.try_cast("double")))


def sentinel_to_null(c: Column | str, values, tolerance: float = 1e-6) -> Column:
    """Null where the value lies within `tolerance` of one of `values`."""
    x = as_column(c)
    coded = reduce(lambda a, b: a | b, [F.abs(x - F.lit(float(v))) <= tolerance for v in values])
    return F.when(~coded, x)


def positive(c: Column | str) -> Column:
    """The value if it is above zero, else null."""
    x = as_column(c)
    return F.when(x > 0, x)


def present(c: Column | str) -> Column:
    """True when a text value is neither null nor empty."""
    x = as_column(c)
    return x.isNotNull() & (x != "")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null when either is null or b is zero."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def growth(now: Column | str, before: Column | str) -> Column:
    """Simple rate of change now / before - 1."""
    return ratio(now, before) - 1


def row_total(*cols: Column | str) -> Column:
    """Sum across columns, a null counting as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_column(c), F.lit(0)) for c in cols])


def clamp(c, low, high, null_policy: str = "keep") -> Column:
    """Limit to [low, high]. A null stays null, or becomes `high` under 'upper'."""
    x, low, high = as_column(c), as_column(low), as_column(high)
    # The guard matters: greatest and least skip nulls, so a null would become `low`.
    limited = F.when(x.isNotNull(), F.least(F.greatest(x, low), high))
    if null_policy == "keep":
        return limited
    if null_policy == "upper":
        return F.coalesce(limited, high)
    raise ValueError(f"null_policy must be 'keep' or 'upper', not {null_policy!r}")


def integral_div(c: Column | str, by: int) -> Column:
    """Integer division truncating toward zero."""
    x = as_column(c)
    return F.call_function("div", x.cast("long"), F.lit(by).cast("long")).cast("int")


def round_digits(c: Column | str, digits: int) -> Column:
    return F.round(as_column(c), digits)


def first_chars(c: Column | str, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


def last_chars(c: Column | str, n: int = 1) -> Column:
    return F.right(as_column(c), F.lit(n))


def without_char(c: Column | str, char: str) -> Column:
    return F.replace(as_column(c), F.lit(char), F.lit(""))


def text_id(*cols: Column | str) -> Column:
    """One identifier from several parts; null when a part is null."""
    return F.concat(*[as_column(c).cast("string") for c in cols])

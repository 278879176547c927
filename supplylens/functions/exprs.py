"""Column expressions: NULL rules, money, dates, buckets and labels.

Money is summed as DECIMAL so that a total does not depend on the order in which
shuffled partials arrive; ratios are taken in double afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,4)"
FINE = "decimal(28,10)"

# Cycle-time buckets, upper bound inclusive, the last one open.
AGING_BUCKETS = (
    ("0-7 days", 7),
    ("8-15 days", 15),
    ("16-30 days", 30),
    ("31-60 days", 60),
    ("60+ days", None),
)
AGING_LABELS = tuple(label for label, _ in AGING_BUCKETS)

# The strings a CSV reader takes for NULL, compared untrimmed.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Money at four decimals, exact under addition."""
    return col(c).cast(MONEY)


def fine(c: Column | str) -> Column:
    """A derived double at ten decimals, exact under addition."""
    return col(c).cast(FINE)


def as_double(c: Column | str) -> Column:
    return col(c).cast("double")


def sum_or_zero(c: Column | str, scale: str = FINE) -> Column:
    """Sum in which an all-NULL group counts as 0."""
    return F.coalesce(F.sum(col(c).cast(scale)).cast("double"), F.lit(0.0))


def sum_or_null(c: Column | str, scale: str = FINE) -> Column:
    """Sum in which an all-NULL group stays NULL."""
    return F.sum(col(c).cast(scale)).cast("double")


def exact_mean(c: Column | str) -> Column:
    """Mean whose numerator is summed exactly."""
    return F.try_divide(F.sum(fine(c)).cast("double"), F.count(c).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """numerator / denominator * scale where the denominator is positive, else NULL."""
    n, d = as_double(numerator), as_double(denominator)
    value = F.try_divide(n, d)
    if scale != 1.0:
        value = value * F.lit(scale)
    return F.when(d > 0, value)


def trim_spaces(c: Column | str) -> Column:
    return F.trim(col(c))


def strip_whitespace(c: Column | str) -> Column:
    """Strip every kind of white space at both ends, not only blanks."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def null_tokens_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.isin(*NULL_TOKENS), c)


def single_value(c: Column | str) -> Column:
    """Aggregate: the group's value if all non-NULL values agree, else NULL."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def holds(condition: Column) -> Column:
    """A predicate as 0/1 in which unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def within(a: Column | str, b: Column | str, absolute: float, relative: float = 0.0) -> Column:
    a, b = as_double(a), as_double(b)
    return F.abs(a - b) <= F.lit(absolute) + F.lit(relative) * F.abs(b)


def half_even(c: Column | str, digits: int = 2) -> Column:
    """Round to a number of digits, ties to the even neighbour."""
    power = float(10**digits)
    return F.rint(as_double(c) * power) / power


def aging_bucket(days: Column | str) -> Column:
    """Cycle-time bucket; a negative duration has none."""
    return F.when(col(days) >= 0, aging_bucket_open(days))


def aging_bucket_open(days: Column | str) -> Column:
    """Cycle-time bucket in which negative durations fall into the first one."""
    days = col(days)
    chain = None
    for label, upper in AGING_BUCKETS:
        test = days.isNotNull() if upper is None else days <= upper
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def currency_label(c: Column | str) -> Column:
    """Compact amount: 1.23M, 4.56K, or the plain number."""
    v = as_double(c)
    return (
        F.when(v >= 1_000_000, F.format_string("%.2fM", v / 1_000_000))
        .when(v >= 1_000, F.format_string("%.2fK", v / 1_000))
        .otherwise(v.cast("string"))
    )


def sample_variance(n: Column, total: Column, squares: Column) -> Column:
    """Unbiased variance from exact integer moments; NULL below two values."""
    n, total, squares = (c.cast("decimal(38,0)") for c in (n, total, squares))
    spread = (n * squares - total * total).cast("double")
    return F.when(n > 1, F.try_divide(spread, (n * (n - 1)).cast("double")))

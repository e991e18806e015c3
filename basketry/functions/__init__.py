"""Column -> Column helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); no Python UDF anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats (must match the reference's API output):
#   purchase time  yyyy-MM-ddTHH:mm:ssZ
#   month label    yyyy-MM
#   report stamp   yyyyMMdd_HHmmss
ISO_SECONDS_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MONTH_LABEL = "yyyy-MM"
REPORT_STAMP = "%Y%m%d_%H%M%S"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(quantity="quantity", price="price") -> Column:
    """Line amount quantity * price."""
    return col(quantity) * col(price)


def money(c) -> Column:
    """Round a money sum to cents."""
    return F.round(col(c), 2)


def exact_cents_avg(c) -> Column:
    """Average of a money column summed exactly in cents.

    sum(decimal(18,2)) is exact, so two engines divide the same numbers and
    agree to the last bit; plain avg of doubles can land either side of a
    rounding tie depending on summation order."""
    x = col(c)
    return F.sum(x.cast("decimal(18,2)")).cast("double") / F.count(x)


def parse_iso_ts(c) -> Column:
    """ISO-8601 text to timestamp: 'Z', offsets and zone-less text (read as
    UTC in a UTC session); bad text gives NULL instead of an ANSI error."""
    return F.try_to_timestamp(col(c))


def lenient_double(c) -> Column:
    """Text or number to double; non-numeric text, and what is not finite
    (it would turn every sum into NaN), gives NULL."""
    d = col(c).try_cast("double")
    return F.when(F.abs(d) < float("inf"), d)


def to_day(c) -> Column:
    return F.to_date(col(c))


def month_start(c) -> Column:
    """First day of the month as a DATE."""
    return F.date_trunc("month", col(c)).cast("date")


def hour_of_day(c) -> Column:
    return F.hour(col(c)).cast("long")


def iso_seconds(c) -> Column:
    return F.date_format(col(c), ISO_SECONDS_Z)


def month_label(c) -> Column:
    return F.date_format(col(c), MONTH_LABEL)


def or_default(c, default) -> Column:
    """NULL replacement for unmatched dimension rows (P10)."""
    return F.coalesce(col(c), F.lit(default))

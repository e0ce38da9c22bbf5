"""Column expressions shared across the library (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(value) -> Column:
    """A TIMESTAMP literal from a string/datetime, or ``current_timestamp()`` for None.

    Strings are read in the session time zone (UTC under ``configure``); aware datetimes are converted to UTC.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc)
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp")


def safe_divide(num, den) -> Column:
    """NULL instead of an error when the denominator is 0 or NULL (double result)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def fraud_rate(label="TX_FRAUD") -> Column:
    """Share of fraud among labelled rows; unlabelled rows are ignored, NULL if none is labelled."""
    lab = _col(label)
    return safe_divide(F.sum(F.coalesce(lab, F.lit(0))), F.count(lab))


def trunc_second(ts) -> Column:
    """Drop the sub-second part of a timestamp (format-then-parse to whole seconds)."""
    return F.date_trunc("second", _col(ts).cast("timestamp"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch; sub-second parts are dropped (floor)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


#: Exact form of an amount: eight decimals, up to 10**19. Sums keep eight decimals (37 digits).
EXACT_AMOUNT = "decimal(27,8)"


def exact_amount(amount) -> Column:
    """The amount as a decimal, NULL for NaN, infinities and amounts of 10**19 or more.

    Decimal sums do not depend on the order of the rows (a sum of doubles does, in its last bits) and stay exact
    under subtraction, which the prefix-difference window form needs.
    """
    return _col(amount).try_cast(EXACT_AMOUNT)


def inexact_amount(amount) -> Column:
    """The amounts that ``exact_amount`` cannot hold, as doubles; NULL for all others."""
    a = _col(amount)
    return F.when(a.isNotNull() & exact_amount(a).isNull(), a.cast("double"))


def avg_amount(amount="TX_AMOUNT") -> Column:
    """AVG of a currency amount: an exact decimal sum, to which amounts without a decimal form (NaN, infinities)
    are added as doubles, over the number of amounts. NULL amounts are ignored, NULL when there is none."""
    a = _col(amount)
    total = F.coalesce(F.sum(exact_amount(a)).cast("double"), F.lit(0.0)) + F.coalesce(F.sum(inexact_amount(a)), F.lit(0.0))
    return F.try_divide(total, F.count(a).cast("double"))

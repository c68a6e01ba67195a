"""Number and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: slices below this percentage carry no label.
SMALLEST_LABELLED_PERCENT = 7
# Month names of the access-log format, in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_names() -> Column:
    """The month names as an array, January first."""
    return F.array(*map(F.lit, MONTHS))


def log_of_square(x: Column) -> Column:
    """Natural logarithm of x squared."""
    return F.ln(F.pow(x, F.lit(2)))


def percent_label(percent: Column) -> Column:
    """The percentage as text, or an empty text for a small slice."""
    return (F.when(percent < SMALLEST_LABELLED_PERCENT, F.lit(""))
            .otherwise(F.round(percent, 10).cast("string")))


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    """Integer quotient of two non-negative whole numbers; NULL when dividing by 0."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def log_time(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` by position, zone offset ignored, NULL when not a time.

    The result carries no zone and does not depend on the session's zone.
    """
    number = F.array_position(month_names(), F.substring(text, 4, 3))
    month = F.when(number > 0, F.lpad(number.cast("string"), 2, "0"))
    iso = F.concat(
        F.substring(text, 8, 4), F.lit("-"), month, F.lit("-"), F.substring(text, 1, 2),
        F.lit(" "), F.substring(text, 13, 2), F.lit(":"), F.substring(text, 16, 2),
        F.lit(":"), F.substring(text, 19, 2))
    return iso.try_cast("timestamp_ntz")

"""Number labels of the dashboard queries."""

from pyspark.sql import functions as F


def grouped(value, digits):
    """Thousands-grouped text with fixed decimals, halves rounded away from zero.

    The sign is taken before rounding, so a small negative number shows as -0.00.
    """
    sign = F.when(value < 0, "-").otherwise("")
    # format_number rounds halves to even, so the rounding is done first.
    return F.concat(sign, F.format_number(F.round(F.abs(value), digits), digits))


def price_label(price):
    """Four decimals below 10, else two."""
    return F.when(price < 10, grouped(price, 4)).otherwise(grouped(price, 2))


def percent_label(change, percent):
    """Percent with two decimals and a plus sign when the change is not negative."""
    return F.concat(F.when(change >= 0, "+").otherwise(""), grouped(percent, 2), F.lit("%"))


def kilobytes(length):
    """Bytes to KB with two decimals, halves rounded to even."""
    return F.bround(length / F.lit(1024.0), 2)

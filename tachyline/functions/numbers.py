"""Rounding that gives the same bits in any engine doing IEEE arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A hair above one half: values that sit on a tie up to summation noise all go up.
_HALF = 0.501


def steady_round(value: Column, places: int) -> Column:
    """Round a double so that noise in its last digits does not change the result.

    Plain rounding sends a value at a decimal tie up or down by its last bit,
    which depends on the order of summation. Here such ties always go up.
    """
    unit = float(10**places)
    return F.floor(value * unit + _HALF) / unit


def one_decimal(value: Column) -> Column:
    """A double rounded to one decimal by its exact binary value, exact ties to the even digit.

    Ten times the value is 8 + 2 times it; the rounding error of that sum is known exactly
    and decides where the sum itself lands on a tie.
    """
    eight, two = value * 8, value * 2
    tenths = eight + two
    part = tenths - eight
    error = (eight - (tenths - part)) + (two - part)
    low = F.floor(tenths).cast("double")
    over = tenths - low
    odd = F.pmod(low, F.lit(2.0)) == 1
    up = (over > 0.5) | ((over == 0.5) & ((error > 0) | ((error == 0) & odd)))
    return F.when(up, low + 1).otherwise(low) / 10

"""Rounding of money, shares and averages."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_decimals(value: Column) -> Column:
    """Half-up to 2 places.

    The order in which a cluster adds doubles varies from run to run and shifts the last bits, enough
    to push an exact half cent to either side. Settling at 9 places first makes the result repeatable.
    """
    return F.round(F.round(value, 9), 2)

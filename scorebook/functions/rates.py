"""Column helpers shared by the scorecards and the season marts."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

BALLS_PER_OVER = 6


def overs_text(balls: Column) -> Column:
    """Legal balls as text, e.g. 201 balls -> ``33.3``."""
    whole = F.floor(balls / BALLS_PER_OVER).cast("int")
    return F.concat(whole.cast("string"), F.lit("."), (balls % BALLS_PER_OVER).cast("string"))


def rate(amount: Column, per: str, divisor: Column) -> Column:
    """``amount * per / divisor`` to two places, as an exact half-up decimal."""
    return F.round(amount * F.lit(Decimal(per)) / F.nullif(divisor, F.lit(0)), 2)


def average(amount: Column, divisor: Column) -> Column:
    """``amount / divisor`` to two places, as a double."""
    return F.round(amount / F.nullif(divisor, F.lit(0)), 2)

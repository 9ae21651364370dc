"""Money is summed in whole minor units and a remainder: a sum of doubles alone depends on the order of the rows.

A price becomes a bigint of 10**-scale units, summed exactly in Spark's fastest aggregate, and what is left of it as a
double. The remainder is exactly 0 for prices with at most `scale` decimals, so their sums are exact; finer prices keep
all they have, summed like any doubles. NaN, infinite and huge prices are all remainder: their sums are what doubles
give. Casting each price to decimal made the sums three times slower. A sum beyond a bigint stops the job (ANSI mode,
Spark's default).
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 2


def to_units(price: Column, scale: int = SCALE) -> Column:
    """Whole minor units; 0 for a price that is not finite or has no exact number of them."""
    whole = F.rint(price * F.lit(10**scale))
    return F.when(price.isNull(), F.lit(None)).when(F.abs(whole) < F.lit(2.0**53), whole.cast("long")).otherwise(F.lit(0))


def to_rest(price: Column, scale: int = SCALE) -> Column:
    """What a price has beyond its whole minor units."""
    return price - to_units(price, scale) / F.lit(10.0**scale)


def from_units(units: Column, rest: Column, scale: int = SCALE) -> Column:
    """Minor units as the nearest double, and the remainder; done once per result row."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast("double") + rest


def money_sum(name: str, scale: int = SCALE) -> Column:
    """Sum of a price column as double; see the module."""
    price = F.col(name)
    return from_units(F.sum(to_units(price, scale)), F.sum(to_rest(price, scale)), scale)

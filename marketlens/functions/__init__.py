"""Column expressions shared by the operators."""

from marketlens.functions.money import SCALE, from_units, money_sum, to_rest, to_units
from marketlens.functions.status import is_created, is_reversed, with_status
from marketlens.functions.times import with_order_day, with_order_time

__all__ = [
    "SCALE",
    "from_units",
    "is_created",
    "is_reversed",
    "money_sum",
    "to_rest",
    "to_units",
    "with_order_day",
    "with_order_time",
    "with_status",
]

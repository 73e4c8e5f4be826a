"""A bound value inside a column expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once.

    Without it a value used in a lambda is computed anew per element, and one used
    several times is copied into the plan as often.
    """
    return F.element_at(F.transform(F.array(value), body), 1)

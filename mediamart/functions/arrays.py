"""Array helpers."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    Inside a lambda an outer expression would be evaluated again for every element, because
    Catalyst may merge the projection that computed it; a lambda variable is not.
    """
    return F.transform(F.array(value), use)[0]

"""Python over the rows of a table, one at a time.

Workers get such rows a hundred at a time, whatever a partition holds. An Arrow batch has up to 10,000, and texts, pages or
sections of that many, their copies as Python objects among them, grew with the partitions to hundreds of MB a worker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def row_udf(kind: DataType | str) -> Callable:
    """A function of values as a function of columns that returns `kind`."""
    return lambda f: F.udf(f, kind, useArrow=False)

"""Array building without lambdas, so that it stays inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(items: Sequence[tuple[Column, Column]]) -> Column:
    """Array of the values whose condition holds, in order."""
    return F.flatten(F.array(*[F.when(test, F.array(value)).otherwise(F.array()) for test, value in items]))

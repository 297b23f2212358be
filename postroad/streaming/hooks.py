"""User code in the flow: row transforms. Sinks are transports, see `deliver`."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class RowTransform(Protocol):
    """Map and filter on events; ``init`` and ``close`` run once per task."""

    def init(self) -> None: ...

    def run(self, event: dict[str, Any]) -> dict[str, Any] | None: ...

    def close(self) -> None: ...


def row_transform(make: Callable[[], RowTransform], schema: T.StructType | None = None):
    """A step for `transform_chain` that runs a `RowTransform` on Arrow batches.

    ``make`` builds the transform inside each task. Prefer a plain DataFrame function
    where native expressions can say it.
    """

    def step(df: DataFrame) -> DataFrame:
        out = schema or df.schema
        names = out.fieldNames()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            transform = make()
            transform.init()
            try:
                for batch in batches:
                    kept = [e for e in map(transform.run, batch.to_dict("records")) if e is not None]
                    yield pd.DataFrame(kept, columns=names)
            finally:
                transform.close()

        return df.mapInPandas(run, out)

    return step

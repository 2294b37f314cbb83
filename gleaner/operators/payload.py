"""A caller's own transformation over payloads."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_payload(df: DataFrame, body: str, fn: Callable[[bytes], bytes], ok: str | None = None) -> DataFrame:
    """Apply ``fn`` to every good payload (where column ``ok`` is true); one that fails keeps its
    original. Payloads travel in Arrow batches, other columns stay in the JVM."""

    @F.pandas_udf("binary")
    def apply(bodies: pd.Series) -> pd.Series:
        def one(payload):
            try:
                return payload if payload is None else fn(payload)
            except Exception:  # whatever the caller's code raises, the payload stays
                return payload

        return bodies.map(one)

    changed = apply(F.col(body).cast("binary"))
    return df.withColumn(body, changed if ok is None else F.when(F.col(ok), changed).otherwise(F.col(body).cast("binary")))

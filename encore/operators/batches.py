"""Python hooks that run inside Spark tasks, Arrow-batched.

* ``map_in_batches`` - a caller function applied to slices of at most ``batch_size`` rows
  (the place for an outside lookup service); runs in ``mapInPandas``.
* ``register_udfs`` - the session-registered UDF (string length) as a pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_in_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType,
                   batch_size: int = 10) -> DataFrame:
    """Apply ``fn`` to consecutive slices of at most ``batch_size`` rows of each partition.

    ``fn`` returns the output rows for its slice (possibly none, e.g. a failed lookup).
    Nothing is gathered per partition: slices stream through Arrow batches."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for start in range(0, len(pdf), batch_size):
                out = fn(pdf.iloc[start:start + batch_size].reset_index(drop=True))
                if out is not None and len(out):
                    yield out

    return df.mapInPandas(run, schema)


@F.pandas_udf(T.IntegerType())
def name_length(s: pd.Series) -> pd.Series:
    return s.str.len().astype("Int32")


def register_udfs(spark: SparkSession) -> None:
    """Register the session UDFs callable from SQL text."""
    spark.udf.register("name_length", name_length)

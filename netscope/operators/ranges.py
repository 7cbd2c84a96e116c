"""Ranges of an order that hold about equally many rows, whatever the values' distribution."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_ROWS = 100_000     # rows that a range may hold
SAMPLE_ROWS = 131_072    # bound of the sample from which the ends of ranges are taken
MAX_RANGES = 16_384      # beyond RANGE_ROWS * MAX_RANGES / 2 rows the ranges grow with the table


def _encoded(values):
    """Rows of long integers as byte strings of the same order."""
    x = np.ascontiguousarray((values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8"))
    return x.view(f"S{8 * x.shape[1]}").ravel()


def range_of(df: DataFrame, by: Sequence[Column], rows: int = RANGE_ROWS, sample_rows: int = SAMPLE_ROWS) -> Column:
    """Number of the range that a row falls into, growing in the order of ``by`` (long columns without NULLs).

    Ranges aim at half of ``rows``.  Their ends are read off a sample that a hash of ``by`` draws, so every task
    and every repetition places a row alike; the driver sees at most about ``sample_rows`` keys.  Rows with equal
    ``by`` share a range."""
    n = df.count()
    ranges = min(MAX_RANGES, -(-2 * n // rows))
    if ranges <= 1:
        return F.lit(0)
    share = int(min(1.0, sample_rows / n) * 2.0 ** 62)
    drawn = F.abs(F.shiftright(F.xxhash64(F.lit("ranges"), *by), 1)) <= share
    names = [f"b{i}" for i in range(len(by))]
    keys = df.where(drawn).select(*[c.cast("bigint").alias(x) for c, x in zip(by, names)]).toPandas()
    keys = np.sort(_encoded(keys.to_numpy().reshape(-1, len(by))))
    ends = np.unique(keys[np.arange(1, ranges) * len(keys) // ranges]) if len(keys) else keys

    @F.pandas_udf("int")
    def place(x: pd.DataFrame) -> pd.Series:
        return pd.Series(np.searchsorted(ends, _encoded(x.to_numpy()), side="right").astype(np.int32))

    return place(F.struct(*[c.cast("bigint").alias(x) for c, x in zip(by, names)]))

"""A bounded set of bits that tells which rows of a wide table a list of ids may concern.

A join of whole texts with a long list of ids would move every text.  The bits say of
a row that its id is surely not in the list, or that it may be; only the
latter meet the list in an exact join.  The bits take ``BITS`` / 8 bytes (8 MB) whatever
the length of the list: a longer one only lets more rows through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POWER = 26
BITS = 1 << POWER
HASHES = 3


def places(key: Column) -> list[Column]:
    """The key's bits, null of a null key."""
    return [F.when(key.isNotNull(), F.shiftrightunsigned(F.xxhash64(key, F.lit(j)), 64 - POWER).cast("int")) for j in range(HASHES)]


def sieve(ids: DataFrame, column: str):
    """The bits of ``ids`` as a broadcast array of words.

    They are joined where the ids are; at most ``BITS`` / 64 words reach the driver.
    """
    found = ids.where(F.col(column).isNotNull()).select(F.explode(F.array(*places(F.col(column).cast("bigint")))).alias("p"))
    words = found.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, p % 64))").alias("v")).toPandas()
    bits = np.zeros(BITS // 64, dtype=np.uint64)
    bits[words["w"].to_numpy(dtype=np.int64)] = words["v"].to_numpy(dtype=np.int64).view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(bits)


def passed(bits: np.ndarray, columns: list[pd.Series]) -> np.ndarray:
    """Which keys, given by their places, may be in the list; null keys are not."""
    ok = columns[0].notna().to_numpy()
    for s in columns:
        p = s.fillna(0).to_numpy(dtype=np.int64)
        ok &= (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
    return ok


def among(held, key: Column) -> Column:
    """Whether the list of ``held`` may hold a key."""

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(passed(held.value, [a, b, c]))

    return test(*places(key.cast("bigint")))

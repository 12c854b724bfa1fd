"""Tables in the cluster's shared folder; writing one cuts the lineage and survives lost executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.sources.scratch import new_path, shared_dir

__all__ = ["discard", "gathered", "materialise", "new_path", "sampled", "shared_dir"]


def materialise(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tickframe_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialised table that no later plan reads."""
    path = getattr(df, "_tickframe_path", None)
    if path:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def sampled(df: DataFrame, rows: int, total: int, *columns: str) -> DataFrame:
    """About `rows` of the `total` rows of df, twice that at most: those whose columns hash below a bound.
    A plain filter, so no task sends more than its share."""
    parts = 1 << 40
    below = parts if total <= rows else parts * rows // total
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(parts)) < F.lit(below)).limit(2 * rows)


def gathered(df: DataFrame) -> list[np.ndarray]:
    """The columns of df (longs without nulls, a bounded number of rows) as arrays on the driver. Tasks
    pack them, as a row for each would take the driver over ten times the room."""
    names = df.columns

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({c: [b[c].to_numpy(np.int64).tobytes()] for c in names})

    rows = df.mapInPandas(packed, ", ".join(f"`{c}` binary" for c in names)).collect()
    return [np.frombuffer(b"".join(r[k] for r in rows), np.int64) for k in range(len(names))]

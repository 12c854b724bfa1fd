"""Rolling extremes of a stream, kept as state for each ticker."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def extremes(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest of each row and the n before it, by columns; NaN is nothing. The rows are cut into
    stretches of n + 1: a frame is the end of one and the beginning of the next, and both are running
    extremes, so a row costs the same for any n."""
    rows, columns = values.shape
    out = []
    for best, none in ((np.fmin, np.inf), (np.fmax, -np.inf)):
        padded = np.full((-(-(rows + n) // (n + 1)) * (n + 1), columns), none)
        padded[n : n + rows] = np.where(np.isnan(values), none, values)
        cut = padded.reshape(-1, n + 1, columns)
        begun = best.accumulate(cut, axis=1).reshape(padded.shape)
        ended = best.accumulate(cut[:, ::-1], axis=1)[:, ::-1].reshape(padded.shape)
        found = best(ended[:rows], begun[n : n + rows])
        out.append(np.where(np.isinf(found), np.nan, found))
    return out[0], out[1]


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue()


def _unpacked(octets: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(octets).read_all().to_pandas()


class RollingExtremes(StatefulProcessor):
    """For each ticker the rows that new ones may still need: those of the last `delay` before its newest
    row, and n more before these. A row that is not older than that may come in any order; it and the n
    rows after it are given out (again) with the extremes of their frames. Older ones are given out with
    `_late`. A row of a time that is there already replaces it."""

    def __init__(self, n: int, measures: Sequence[str], ts: str, delay_us: int, ttl_ms: int | None):
        self._n, self._measures, self._ts, self._delay, self._ttl = n, list(measures), ts, delay_us, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        more = {} if self._ttl is None else {"ttlDurationMs": self._ttl}
        self._state = handle.getValueState("rows", "rows binary", **more)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).drop_duplicates(self._ts, keep="last")
        old = _unpacked(self._state.get()[0]) if self._state.exists() else new.iloc[:0]
        since = old[self._ts].max() - pd.Timedelta(self._delay, "us") if len(old) else None
        late = (new[self._ts] < since) if since is not None else pd.Series(False, index=new.index)
        if late.any():
            yield self._out(new[late], np.full((int(late.sum()), len(self._measures)), np.nan), None, True)
            new = new[~late]
        if not len(new):
            return
        old = old[~old[self._ts].isin(new[self._ts])]
        held = (pd.concat([old, new], ignore_index=True) if len(old) else new).sort_values(self._ts, kind="stable", ignore_index=True)
        touched = np.concatenate([np.zeros(self._n + 1, np.int64), np.cumsum(held[self._ts].isin(new[self._ts]))])
        changed = touched[self._n + 1 :] > touched[: len(held)]
        low, high = extremes(held[self._measures].to_numpy(np.float64, na_value=np.nan), self._n)
        yield self._out(held[changed], low[changed], high[changed], False)
        first = int(np.searchsorted(held[self._ts], held[self._ts].iloc[-1] - pd.Timedelta(self._delay, "us")))
        self._state.update((_packed(held.iloc[max(0, first - self._n) :]),))

    def _out(self, rows: pd.DataFrame, low: np.ndarray, high: np.ndarray | None, late: bool) -> pd.DataFrame:
        ends = {f"_{k}_{c}": v[:, i] for k, v in (("lo", low), ("hi", low if high is None else high)) for i, c in enumerate(self._measures)}
        return pd.concat([rows.reset_index(drop=True), pd.DataFrame(ends), pd.DataFrame({"_late": np.full(len(rows), late)})], axis=1)


def with_rocks(spark: SparkSession) -> None:
    """State of this kind needs the RocksDB store."""
    if not spark.conf.get(_PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKS)


def rolling_extremes(df: DataFrame, n: int, measures: Sequence[str], delay_us: int, ttl_ms: int | None = None, ts: str = "timestamp") -> DataFrame:
    """The rows of a stream with `_lo_c` and `_hi_c` for each measure, and `_late` (see RollingExtremes).
    With ttl_ms a ticker's state goes once it had no rows for so long: what comes then begins anew."""
    with_rocks(df.sparkSession)
    ends = [StructField(f"_{k}_{c}", DoubleType()) for k in ("lo", "hi") for c in measures]
    schema = StructType([*df.schema.fields, *ends, StructField("_late", BooleanType())])
    processor = RollingExtremes(n, measures, ts, delay_us, ttl_ms)
    return df.groupBy("ticker").transformWithStateInPandas(processor, schema, "Update", "None" if ttl_ms is None else "ProcessingTime")

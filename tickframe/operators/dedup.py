"""Duplicates of time-series rows: keep one, count them, latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Time column and key of each table.
KEYS: dict[str, tuple[str, tuple[str, ...]]] = {
    "bars": ("timestamp", ("ticker", "timestamp")),
    "daily": ("timestamp", ("ticker", "timestamp")),
    "trades": ("sip_timestamp", ("ticker", "sip_timestamp")),
    "quotes": ("sip_timestamp", ("ticker", "sip_timestamp")),
    "news": ("published_utc", ("id",)),
    "indicators": ("timestamp", ("ticker", "timestamp", "indicator_type")),
    "master": ("timestamp", ("ticker", "timestamp")),
}
_TIMES = ("timestamp", "sip_timestamp", "published_utc", "created_at")


def resolve_cols(schema: StructType) -> tuple[str | None, str | None]:
    """(ticker column, time column) of a table, by name; None where there is none."""
    names = set(schema.fieldNames())
    ticker = "ticker" if "ticker" in names else "tickers" if "tickers" in names else None
    return ticker, next((t for t in _TIMES if t in names), None)


def _first(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(over)).where("_n = 1").drop("_n")


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the last by order."""
    return _first(df, keys, [F.col(c).desc() for c in order])


def dedup_ms(df: DataFrame, ts: str = "sip_timestamp", by: Sequence[str] = ("ticker",), order: Sequence[str] = ("sip_timestamp", "sequence_number")) -> DataFrame:
    """One row for each millisecond (of a ticker): the first by order. by=() takes the time alone."""
    return _first(df, [*by, F.date_trunc("millisecond", ts)], list(order))


def dedup_report(df: DataFrame, ts: str = "sip_timestamp", by: Sequence[str] = ("ticker",)) -> DataFrame:
    """What dedup_ms would do: rows, rows that stay, rows that go."""
    stay = F.countDistinct(F.struct(*by, F.date_trunc("millisecond", ts)))
    return df.agg(F.count("*").alias("total_rows"), stay.alias("unique_rows")).withColumn("would_delete", F.col("total_rows") - F.col("unique_rows"))


def latest(df: DataFrame, by: Sequence[str] = ("ticker",), ts: str = "timestamp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row of each group; of one time the one of the lowest tiebreak values, and of equal ones
    the one of the lowest values of its other columns. Rows without a time come last."""
    rest = [c for c in df.columns if c not in by]
    age = F.coalesce(-F.expr(f"timestampdiff(microsecond, timestamp_ntz '1970-01-01', cast(`{ts}` as timestamp_ntz))"), F.lit(2**63 - 1))
    row = F.min_by(F.struct(*rest), F.struct(age, *tiebreak, *rest))
    return df.groupBy(*by).agg(row.alias("_r")).select(*by, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)

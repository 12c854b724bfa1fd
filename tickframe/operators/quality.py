"""Profiles of tables: sizes, gaps, nulls, duplicates, coverage, consistency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from tickframe.operators.dedup import resolve_cols


def table_stats(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.countDistinct("ticker").alias("unique_tickers"), F.min(ts).alias("earliest"), F.max(ts).alias("latest"),
        F.countDistinct(F.to_date(ts)).alias("unique_days"),
    )


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types."""
    return df.dtypes


def date_gaps(df: DataFrame, ts: str = "timestamp", limit: int = 100) -> DataFrame:
    """Runs of days without rows between two days of a ticker that have some; the first `limit`."""
    days = df.select("ticker", F.to_date(ts).alias("date")).distinct()
    before = F.lag("date", 1).over(Window.partitionBy("ticker").orderBy("date"))
    gaps = days.withColumn("gap_start", before).withColumn("days_gap", F.datediff("date", "gap_start")).where("days_gap > 1")
    return gaps.select("ticker", "gap_start", F.col("date").alias("gap_end"), "days_gap").orderBy("ticker", "gap_start").limit(limit)


def quality(df: DataFrame) -> DataFrame:
    """(column_name, null_count, zero_count) of all columns but arrays, in one pass; zero_count is null
    for what isn't a number."""
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, ArrayType)]
    counts = []
    for k, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        counts.append(F.count_if(c.isNull()).alias(f"n{k}"))
        counts.append((F.count_if(c == 0) if isinstance(f.dataType, NumericType) else F.first(F.lit(None).cast("long"))).alias(f"z{k}"))
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{k}").alias("null_count"), F.col(f"z{k}").alias("zero_count")) for k, f in enumerate(fields)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _duplicates(total, distinct):
    share = F.try_divide((F.col("total_rows") - F.col("unique_rows")) * F.lit(100.0), F.col("total_rows").cast("double"))
    return [F.col("total_rows"), F.col("unique_rows"), (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"), F.coalesce(share, F.lit(0.0)).alias("duplicate_pct")]


def dup_by_ts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows that share their time with another, whatever the ticker."""
    return df.agg(F.count("*").alias("total_rows"), F.countDistinct(ts).alias("unique_rows")).select(*_duplicates("total_rows", "unique_rows"))


def dup_by_key(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp")) -> DataFrame:
    grouped = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return grouped.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows")).select(*_duplicates("total_rows", "unique_rows"))


def dup_top(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp"), n: int = 10) -> DataFrame:
    """The n tickers of the most rows beyond one for each key."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias("c"))
    per = grouped.groupBy("ticker").agg(F.sum("c").alias("total_rows"), F.sum(F.col("c") - 1).alias("duplicate_rows"))
    return per.where("duplicate_rows > 0").orderBy(F.col("duplicate_rows").desc(), "ticker").limit(n)


def dup_sample(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp"), n: int = 5) -> DataFrame:
    """The n keys of the most rows."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    return grouped.orderBy(F.col("copies").desc(), *keys).limit(n)


def dup_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """dup_by_ts of each table, with its name."""
    parts = [dup_by_ts(df, resolve_cols(df.schema)[1]).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def consistency(master: DataFrame, bars: DataFrame, quotes: DataFrame, trades: DataFrame, indicators: DataFrame) -> DataFrame:
    """Keys of each source beside what of it is in the master, whose unmatched measures must be null."""

    def minutes(df: DataFrame, ts: str) -> DataFrame:
        return df.agg(F.countDistinct(F.struct("ticker", F.date_trunc("minute", ts))).alias("source_count"))

    sources = {"bars": bars.agg(F.count("*").alias("source_count")), "quotes": minutes(quotes, "sip_timestamp"), "trades": minutes(trades, "sip_timestamp"), "indicators": minutes(indicators, "timestamp")}
    counted = {"bars": F.count("*"), "quotes": F.count("quote_count"), "trades": F.count("trade_count"), "indicators": F.count("sma_5")}
    held = master.agg(*[c.alias(n) for n, c in counted.items()])  # once for all checks
    held = held.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("master_count")) for n in counted])))
    every = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("check_name"), "source_count") for n, df in sources.items()])
    return every.join(held, "check_name").withColumn("difference", F.abs(F.col("source_count") - F.col("master_count")))


def coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, ticker): tickers that another table has and this one hasn't."""
    own = {name: df.select("ticker").distinct() for name, df in tables.items()}
    every = reduce(DataFrame.union, own.values()).distinct()
    parts = [every.join(has, "ticker", "left_anti").select(F.lit(name).alias("table_name"), "ticker") for name, has in own.items()]
    return reduce(DataFrame.unionByName, parts)


def ind_counts(indicators: DataFrame, since=None) -> DataFrame:
    df = indicators.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz")) if since is not None else indicators
    return df.groupBy("indicator_type").agg(F.count("*").alias("row_count"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest")).orderBy("indicator_type")


def ind_daily(indicators: DataFrame) -> DataFrame:
    return indicators.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("row_count"), F.countDistinct("indicator_type").alias("types"), F.countDistinct("ticker").alias("tickers")
    )


def ind_daily_tickers(indicators: DataFrame, start, end) -> DataFrame:
    day = F.to_date("timestamp")
    span = indicators.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return span.groupBy(day.alias("date")).agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))


def master_daily(master: DataFrame) -> DataFrame:
    return master.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("row_count"), F.countDistinct("ticker").alias("tickers"))


def tickers_of(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct().orderBy("ticker")

"""Window features of bars and forward-looking labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.scalar import classify, pct_change, round2, true_range
from tickframe.operators.sequence import row_index, with_halo


def day_of(df: DataFrame, ts: str = "timestamp") -> Column:
    """The day of a row: the column `date` of a stored table, by which it may be laid out, or else made of ts."""
    return F.col("date") if dict(df.dtypes).get("date") == "date" else F.to_date(ts)


def _session(df: DataFrame, session: str) -> list:
    """Columns that end a series: a ticker's day, or the ticker alone."""
    return ["ticker", day_of(df)] if session == "day" else ["ticker"]


def _ordered(df: DataFrame, session: str = "day"):
    return Window.partitionBy(*_session(df, session)).orderBy("timestamp")


def _framed(df: DataFrame, session: str, before: int = 0, after: int = 0, block: int = 4096) -> tuple[DataFrame, object, Callable[[DataFrame], DataFrame]]:
    """(df, a window along its series, what takes the framing off again) for frames of so many rows. A
    day is a window by itself. A series over all days is cut into blocks of numbered rows, with a halo on
    the side that the frames reach to, so that no ticker is one task."""
    if session == "day":
        return df, _ordered(df), lambda d: d
    own = ["rn"] if "rn" not in df.columns else []
    d, over = with_halo(row_index(df) if own else df, max(before, after), block, after > 0)
    return d, over, lambda d: d.where("not _halo").drop("_halo", "_block", *own)


def rounded_prices(bars: DataFrame) -> DataFrame:
    """Prices to two decimals; labels are computed from these."""
    for c in ("open", "high", "low", "close"):
        bars = bars.withColumn(c, round2(F.col(c)))
    return bars


def future_close(bars: DataFrame, n: int = 15, session: str = "day", block: int = 4096) -> DataFrame:
    """The close n rows ahead; null in the last n rows of a session (session="none": of a ticker)."""
    d, over, back = _framed(bars, session, after=n, block=block)
    return back(d.withColumn("future_close", F.lead("close", n).over(over)))


def max_price_diff(bars: DataFrame, n: int = 15, session: str = "day", block: int = 4096) -> DataFrame:
    """The largest rise or fall of the close in the next n rows, whichever is larger; the fall if equal."""
    d, over, back = _framed(bars, session, after=n, block=block)
    ahead = over.rowsBetween(1, n)
    up, down = pct_change(F.max("close").over(ahead), F.col("close")), pct_change(F.min("close").over(ahead), F.col("close"))
    return back(d.withColumn("max_price_diff", round2(F.when(F.abs(up) > F.abs(down), up).otherwise(down))))


def daily_range(bars: DataFrame) -> DataFrame:
    day = Window.partitionBy(*_session(bars, "day"))
    return bars.withColumn("daily_high", round2(F.max("high").over(day))).withColumn("daily_low", round2(F.min("low").over(day)))


def previous_close(bars: DataFrame, mode: str = "prev_day") -> DataFrame:
    """prev_day: the last close of the ticker's previous day with bars; prev_row: of the row before, in
    the session. Days are aggregated first and joined back, so no ticker is sorted as a whole."""
    if mode == "prev_row":
        return bars.withColumn("previous_close", round2(F.lag("close", 1).over(_ordered(bars))))
    days = bars.groupBy("ticker", day_of(bars).alias("_day")).agg(F.max_by("close", "timestamp").alias("_close"))
    by_day = Window.partitionBy("ticker").orderBy("_day")
    days = days.select("ticker", "_day", round2(F.lag("_close", 1).over(by_day)).alias("previous_close"))
    return bars.withColumn("_day", day_of(bars)).join(days, ["ticker", "_day"], "left").drop("_day")


def labels(bars: DataFrame, null_target: int | None = 5) -> DataFrame:
    """price_diff to future_close in per cent, and its class."""
    pct = pct_change(F.col("future_close"), F.col("close"))
    return bars.withColumn("price_diff", pct).withColumn("target", classify(F.col("price_diff"), null_target))


def true_ranges(df: DataFrame, high: str = "daily_high", low: str = "daily_low", previous: str = "previous_close") -> DataFrame:
    h, lo, p = F.col(high), F.col(low), F.col(previous)
    return df.withColumn("tr_current", h - lo).withColumn("tr_high_close", h - p).withColumn("tr_low_close", lo - p).withColumn("tr_value", true_range(h, lo, p))


def atr(df: DataFrame, n: int = 14, session: str = "day", block: int = 4096) -> DataFrame:
    """Mean of tr_value over the last n rows of the session."""
    d, over, back = _framed(df, session, before=n - 1, block=block)
    return back(d.withColumn("atr_value", F.avg("tr_value").over(over.rowsBetween(1 - n, 0))))


def atr_daily(daily: DataFrame, n: int = 14) -> DataFrame:
    """The n-day average on daily bars, of which a ticker has a few thousand in all."""
    days = Window.partitionBy("ticker").orderBy("timestamp")
    ranges = true_ranges(daily.withColumn("previous_close", F.lag("close", 1).over(days)), "high", "low")
    return ranges.withColumn("atr_value", F.avg("tr_value").over(days.rowsBetween(1 - n, 0)))

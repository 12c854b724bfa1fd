"""Aggregates over ticks: bars, quote and trade minutes, wide indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions.scalar import concat_codes, impute, last_known, minute_of, round2

SMA_WINDOWS = (5, 9, 12, 20, 50, 100, 200)
EMA_WINDOWS = (9, 12, 20)


def to_bars(trades: DataFrame, duration: str = "1 minute") -> DataFrame:
    """Open, high, low, close, volume, vwap and number of trades for each ticker and window."""
    at = F.struct("sip_timestamp", "sequence_number")
    size = F.col("size").cast("double")
    grouped = trades.groupBy("ticker", F.window("sip_timestamp", duration).alias("w")).agg(
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.sum("size").cast("long").alias("volume"),
        F.try_divide(F.sum(F.col("price") * size), F.nullif(F.sum(size), F.lit(0.0))).alias("vwap"),
        F.count("*").alias("transactions"),
    )
    return grouped.select("ticker", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume", "vwap", "transactions")


def _filled(c: Column, imputed: bool, rounded: bool = False) -> Column:
    if not imputed:
        return c
    return round2(impute(c, 2.0)) if rounded else impute(c)


def _by(df: DataFrame) -> list[str]:
    """ticker, and the day where a stored table has it: it changes no group, and where the table is laid out
    by both its rows needn't be moved."""
    return ["ticker", "date"] if dict(df.dtypes).get("date") == "date" else ["ticker"]


def quote_minute(quotes: DataFrame, imputed: bool = True) -> DataFrame:
    """Per ticker and minute: mean, lowest bid and highest ask, sizes, number, codes, last exchanges."""
    at, seq = F.col("sip_timestamp"), F.col("sequence_number")
    codes = concat_codes(at, seq, F.col("conditions"))
    return quotes.groupBy(*_by(quotes), minute_of(at).alias("timestamp")).agg(
        _filled(F.avg("bid_price"), imputed, True).alias("avg_bid_price"),
        _filled(F.avg("ask_price"), imputed, True).alias("avg_ask_price"),
        _filled(F.min("bid_price"), imputed, True).alias("min_bid_price"),
        _filled(F.max("ask_price"), imputed, True).alias("max_ask_price"),
        _filled(F.sum("bid_size"), imputed).alias("total_bid_size"),
        _filled(F.sum("ask_size"), imputed).alias("total_ask_size"),
        _filled(F.count("*"), imputed).alias("quote_count"),
        (impute(codes, "2") if imputed else codes).alias("quote_conditions"),
        _filled(last_known(F.col("ask_exchange"), at, seq), imputed).alias("ask_exchange"),
        _filled(last_known(F.col("bid_exchange"), at, seq), imputed).alias("bid_exchange"),
    )


def trade_minute(trades: DataFrame, imputed: bool = True) -> DataFrame:
    """Per ticker and minute: mean, lowest and highest price, size, number, codes, last exchange.
    Without imputation the view's set: trade_volume, number, codes and exchange."""
    at, seq = F.col("sip_timestamp"), F.col("sequence_number")
    codes = concat_codes(at, seq, F.col("conditions"))
    grouped = trades.groupBy(*_by(trades), minute_of(at).alias("timestamp"))
    if not imputed:
        return grouped.agg(
            F.sum("size").alias("trade_volume"), F.count("*").alias("trade_count"), codes.alias("trade_conditions"), last_known(F.col("exchange"), at, seq).alias("trade_exchange")
        )
    return grouped.agg(
        _filled(F.avg("price"), True, True).alias("avg_trade_price"),
        _filled(F.min("price"), True, True).alias("min_trade_price"),
        _filled(F.max("price"), True, True).alias("max_trade_price"),
        _filled(F.sum("size"), True).alias("total_trade_size"),
        _filled(F.count("*"), True).alias("trade_count"),
        impute(codes, "2").alias("trade_conditions"),
        _filled(last_known(F.col("exchange"), at, seq), True).alias("trade_exchange"),
    )


def wide_indicators() -> list[tuple[str, str, str]]:
    """(column, indicator_type, field) of the wide form."""
    out = [(f"sma_{n}", f"SMA_{n}", "value") for n in SMA_WINDOWS] + [(f"ema_{n}", f"EMA_{n}", "value") for n in EMA_WINDOWS]
    return [*out, ("macd_value", "MACD", "value"), ("macd_signal", "MACD", "signal"), ("macd_histogram", "MACD", "histogram"), ("rsi_14", "RSI", "value")]


def pivot_indicators(indicators: DataFrame, imputed: bool = True) -> DataFrame:
    """Long to wide. The types are given, so no pass is needed to find them; of several values of a
    type the highest counts."""
    return indicators.groupBy(*_by(indicators), "timestamp").agg(*indicator_columns(imputed))


def indicator_columns(imputed: bool = True, of: str = "") -> list[Column]:
    """The aggregates of `pivot_indicators`; of: what stands before the names of columns."""
    return [_filled(F.max(F.when(F.col(f"{of}indicator_type") == kind, F.col(f"{of}{field}"))), imputed, True).alias(name) for name, kind, field in wide_indicators()]


def date_range(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.agg(F.min(F.to_date(ts)).alias("min_date"), F.max(F.to_date(ts)).alias("max_date"))

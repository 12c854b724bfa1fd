"""The wide feature table: bars joined with quote, trade and indicator minutes, labels and ranges."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.scalar import impute, round2
from tickframe.operators import features as W
from tickframe.operators.indicators import indicators_long
from tickframe.operators.normalize import normalize_sigmoid
from tickframe.operators.sequence import row_index
from tickframe.operators.ticks import pivot_indicators, quote_minute, trade_minute, wide_indicators
from tickframe.sources import feeds, sinks

_BARS = ("ticker", "timestamp", "open", "high", "low", "close", "volume", "vwap", "transactions")
_QUOTES = (
    "avg_bid_price", "avg_ask_price", "min_bid_price", "max_ask_price", "total_bid_size", "total_ask_size", "quote_count", "quote_conditions", "ask_exchange", "bid_exchange",
)
_TRADES = ("avg_trade_price", "min_trade_price", "max_trade_price", "total_trade_size", "trade_count", "trade_conditions", "trade_exchange")
_INDICATORS = tuple(name for name, _, _ in wide_indicators())
_DAILY = ("daily_high", "daily_low", "previous_close", "tr_current", "tr_high_close", "tr_low_close", "tr_value", "atr_value")
MASTER = (*_BARS, "price_diff", "max_price_diff", "target", *_QUOTES, *_TRADES, *_INDICATORS, *_DAILY)


def joined(bars: DataFrame, *sides: DataFrame) -> DataFrame:
    """bars with each side's columns by (ticker, timestamp); sides have one row for a key. Where bars and a
    side have the day of a stored table, it is a key too."""
    for side in sides:
        if "date" in side.columns and "date" not in bars.columns:
            side = side.drop("date")
        bars = bars.join(side, [k for k in ("ticker", "date", "timestamp") if k in side.columns], "left")
    return bars


def _unmatched(df: DataFrame, columns, kind: str) -> DataFrame:
    """Measures of unmatched sides as zeros and blanks, or left null."""
    if kind == "null":
        return df
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(c, F.lit("" if types[c] == "string" else 0).cast(types[c])) for c in columns})


def bar_features(bars: DataFrame, session: str = "day", prev: str = "prev_day", null_target: int | None = 5) -> DataFrame:
    """All that comes from bars alone, with the day as `date`: a column, so that all windows of a day share
    one exchange."""
    bars = bars.withColumn("date", W.day_of(bars))
    if session == "none" and "rn" not in bars.columns:
        bars = row_index(bars)  # once for all frames
    d = W.rounded_prices(bars.select(*_BARS, *[c for c in ("rn", "date") if c in bars.columns]))
    d = d.withColumn("volume", impute(F.col("volume"))).withColumn("vwap", round2(impute(F.col("vwap"), 2.0))).withColumn("transactions", impute(F.col("transactions")))
    d = W.daily_range(W.max_price_diff(W.future_close(d, 15, session), 15, session))
    return W.atr(W.true_ranges(W.labels(W.previous_close(d, prev), null_target)), 14, session)


def master(bars: DataFrame, quotes: DataFrame, trades: DataFrame, indicators: DataFrame, session: str = "day", unmatched: str = "zero", prev: str = "prev_day") -> DataFrame:
    """51 columns for each bar, and rn (`row_index`) where bars have it. Ticks are aggregated to minutes
    before they are joined; windows are partitioned by ticker and day, so all days are made in one plan."""
    numbered = ["rn"] if "rn" in bars.columns else []
    wide = joined(bar_features(bars, session, prev), quote_minute(quotes), trade_minute(trades), pivot_indicators(indicators))
    return _unmatched(wide, (*_QUOTES, *_TRADES, *_INDICATORS), unmatched).select(*MASTER, *numbered)


def master_range(bars: DataFrame, quotes: DataFrame, trades: DataFrame, indicators: DataFrame, start, end, earlier: DataFrame | None = None, **options) -> DataFrame:
    """master of the days from start to end alone, to which all feeds are pruned, by their partition `date`
    too where they have that column. For the previous day's close each ticker's last bar before them is
    taken along, however long ago it was: `earlier`, or where that isn't given a partial aggregate over all
    earlier bars. Of stored tables `stored_range` finds it by walking back over few days."""
    first, after = F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1)

    def pruned(df: DataFrame, ts: str) -> DataFrame:
        return feeds.scan_range(df, ts, first, after, "left")

    rest = [c for c in _BARS if c != "ticker"]
    if earlier is None:
        earlier = bars.where(F.col("timestamp") < first.cast("timestamp_ntz")).groupBy("ticker").agg(F.max_by(F.struct(*rest), "timestamp").alias("_r")).select("ticker", "_r.*")
    own = pruned(bars, "timestamp").select(*_BARS).unionByName(earlier.select(*_BARS))
    return feeds.scan_range(master(own, pruned(quotes, "sip_timestamp"), pruned(trades, "sip_timestamp"), pruned(indicators, "timestamp"), **options), "timestamp", first, after, "left")


def stored_range(spark, root: str, start, end, **options) -> DataFrame:
    """`master_range` of the tables bars, quotes, trades and indicators below root. Read are the days from
    start to end, and of the bars as many days before as the tickers of the range need for their last one:
    mostly one."""
    bars, quotes, trades, indicators = (spark.read.parquet(f"{root}/{name}") for name in ("bars", "quotes", "trades", "indicators"))
    wanted = feeds.scan_range(bars, "timestamp", start, F.date_add(F.lit(end).cast("date"), 1), "left").select("ticker").distinct()
    return master_range(bars, quotes, trades, indicators, start, end, sinks.last_before(f"{root}/bars", wanted, start), **options)


def master_view(bars: DataFrame, quotes: DataFrame, trades: DataFrame, indicators: DataFrame) -> DataFrame:
    """The push form: raw minutes, whose unmatched numbers are 0 while codes and exchanges stay null,
    beside pivoted indicators as they are."""
    return view_columns(joined(bars.select(*_BARS), quote_minute(quotes, False), trade_minute(trades, False), pivot_indicators(indicators, False)))


#: What the tables of a co-located store are laid out by.
LAID_OUT = ("ticker", "date")


def colocate(name: str, feed: str, df: DataFrame, buckets: int) -> None:
    """Add the rows of a feed to the table `name`, made if it isn't there, which is bucketed by ticker and
    day and sorted by ticker and time: the joins by minute and the windows of a day of `master` over tables
    of as many buckets need no exchange of their own, and a ticker's days lie in different buckets."""
    ts, schema = _LANDED[feed]
    spark = df.sparkSession
    sinks.ensure_table(spark, name, f"{schema}, date date", buckets=(LAID_OUT, ("ticker", ts), buckets))
    rows = df.withColumn("date", F.to_date(ts)).select(*spark.table(name).columns)
    rows.repartition(buckets, *LAID_OUT).sortWithinPartitions("ticker", ts).write.insertInto(name)


_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def laid_out(spark):
    """Within it joins by minute are planned to take tables laid out by ticker and day as they lie: by itself
    Spark moves both sides unless the layout is by all keys of a join."""
    before = spark.conf.get(_KEYS)
    spark.conf.set(_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_KEYS, before)


def master_colocated(spark, names: dict[str, str], path: str, **options) -> None:
    """The master over co-located tables (names of bars, quotes, trades, indicators), as Parquet."""
    with laid_out(spark):
        master(*[spark.table(names[feed]) for feed in ("bars", "quotes", "trades", "indicators")], **options).write.parquet(path)


_LANDED = {"bars": ("timestamp", feeds.BARS), "quotes": ("sip_timestamp", feeds.QUOTES), "trades": ("sip_timestamp", feeds.TRADES), "indicators": ("timestamp", feeds.INDICATORS)}


def view_columns(raw: DataFrame) -> DataFrame:
    """The push form's columns of bars joined with their minutes."""
    zeros = (*_QUOTES[:7], "trade_volume", "trade_count")
    return _unmatched(raw, zeros, "zero").select(*_BARS, *_QUOTES, "trade_volume", "trade_count", "trade_conditions", "trade_exchange", *_INDICATORS)


def build_all(spark, src: str, out: str, start, end, tickers=None) -> None:
    """The whole historical run: landed feeds of a range and a universe into tables, the master of the
    range's days and its normalised form. src has a folder each for bars, trades, quotes and news, and may
    have daily (bars of days) and indicators; where these weren't landed they are computed from all stored
    bars. Of the stored ticks only the range's days are read. Landed records that can't be read or don't fit
    their columns go to out/quarantine, with the reason."""
    universe = tickers or feeds.DEFAULT_UNIVERSE

    def land(name: str, read, ts: str, keys: list[str], closed: str = "both") -> None:
        rows = feeds.scan_range(read(spark, f"{src}/{name}"), ts, start, end, closed)
        sinks.upsert(feeds.in_universe(rows, universe) if "ticker" in keys else rows, f"{out}/{name}", keys, ts)

    key, tick = ["ticker", "timestamp"], ["ticker", "sip_timestamp", "sequence_number"]
    land("bars", feeds.read_bars, "timestamp", key)
    land("trades", feeds.read_trades, "sip_timestamp", tick, "left")
    land("quotes", feeds.read_quotes, "sip_timestamp", tick, "left")
    land("news", feeds.read_news, "published_utc", ["id"], "left")
    bad = [feeds.quarantined(spark, f"{src}/{name}", name) for name in feeds.RAW if sinks.exists(spark, f"{src}/{name}")]
    reduce(DataFrame.unionByName, bad).write.mode("overwrite").parquet(f"{out}/quarantine")
    if sinks.exists(spark, f"{src}/daily"):
        land("daily", feeds.read_daily, "timestamp", key)
    if sinks.exists(spark, f"{src}/indicators"):
        land("indicators", feeds.read_indicators, "timestamp", [*key, "indicator_type"])
    else:
        made = indicators_long(sinks.read_table(spark, f"{out}/bars"))
        sinks.upsert(feeds.scan_range(made, "timestamp", start, end), f"{out}/indicators", [*key, "indicator_type"])
    sinks.upsert(stored_range(spark, out, start, end), f"{out}/master", key)
    wide = feeds.scan_range(spark.read.parquet(f"{out}/master"), "timestamp", start, F.date_add(F.lit(end).cast("date"), 1), "left")
    sinks.upsert(normalize_sigmoid(wide.select(*MASTER)), f"{out}/normalized", key)

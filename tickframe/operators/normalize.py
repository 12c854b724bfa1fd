"""The master table scaled to 0..5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.scalar import round2, sigmoid
from tickframe.operators.sequence import row_index, with_halo
from tickframe.operators.ticks import EMA_WINDOWS, SMA_WINDOWS

PASS_THROUGH = ("ticker", "timestamp", "target", "quote_conditions", "trade_conditions", "ask_exchange", "bid_exchange", "trade_exchange")
#: Scale of each column under the sigmoid (fixed values).
SCALES: dict[str, float] = {
    **dict.fromkeys(("open", "high", "low", "close"), 1000.0),
    "volume": 1_000_000.0,
    **dict.fromkeys(("vwap", "transactions"), 1000.0),
    **dict.fromkeys(("price_diff", "max_price_diff"), 10.0),
    **dict.fromkeys(("avg_bid_price", "avg_ask_price", "min_bid_price", "max_ask_price"), 1000.0),
    **dict.fromkeys(("total_bid_size", "total_ask_size"), 100_000.0),
    **dict.fromkeys(("quote_count", "avg_trade_price", "min_trade_price", "max_trade_price"), 1000.0),
    "total_trade_size": 100_000.0,
    "trade_count": 1000.0,
    **{f"sma_{n}": 1000.0 for n in SMA_WINDOWS},
    **{f"ema_{n}": 1000.0 for n in EMA_WINDOWS},
    **dict.fromkeys(("macd_value", "macd_signal", "macd_histogram"), 10.0),
    "rsi_14": 100.0,
    **dict.fromkeys(("daily_high", "daily_low", "previous_close"), 1000.0),
    **dict.fromkeys(("tr_current", "tr_high_close", "tr_low_close", "tr_value", "atr_value"), 100.0),
}


def normalize_sigmoid(master: DataFrame) -> DataFrame:
    """Each measure through a logistic of its scale; a projection, so it runs on streams as well."""
    return master.select(*[sigmoid(F.col(c).cast("double"), SCALES[c]).alias(c) if c in SCALES else F.col(c) for c in master.columns])


def between(c: Column, low: Column, high: Column, guard: int = 0) -> Column:
    """Where c is between low and high, 0 to 5; null where these are equal (guard=1: or one apart)."""
    width = (high - low).cast("double")
    if guard == 1:
        width = F.nullif(width, F.lit(1.0))
    return round2(5 * F.try_divide(c - low, width))


def normalize_minmax(master: DataFrame, n: int = 100, guard: int = 0) -> DataFrame:
    """Each measure between its lowest and highest of the last n rows and this one, times 5. A flat
    frame (range 0) gives null; guard=1 gives null for a range of exactly 1 as well.

    Rows that carry their number rn along the ticker (see `row_index`) aren't numbered again: number the
    bars before the joins, so that a master is made once. Rows are framed in blocks with a halo, so a ticker's series is spread over tasks. Within a frame of
    n + 1 rows, extremes are those of a suffix of one stretch of n + 1 rows and of a prefix of the
    next, each a running extreme: a row costs the same for any n. Blocks are dealt to tasks once, which does
    for the windows of stretches as well; else rows would move again with all extremes beside them."""
    indexed, over = with_halo(master if "rn" in master.columns else row_index(master), n, max(4096, 8 * (n + 1)))
    d = indexed.repartition("ticker", "_block").withColumn("_stretch", F.floor(F.col("rn") / (n + 1)))
    inner = Window.partitionBy("ticker", "_block", "_stretch")
    before = inner.orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    after = inner.orderBy(F.col("rn").desc()).rowsBetween(Window.unboundedPreceding, 0)  # runs backwards: a frame up to the end is made anew for each row
    measures = [c for c in master.columns if c in SCALES]
    d = d.withColumns({f"_p_{c}": F.struct(F.min(c).over(before).alias("lo"), F.max(c).over(before).alias("hi")) for c in measures})
    d = d.withColumns({f"_s_{c}": F.struct(F.min(c).over(after).alias("lo"), F.max(c).over(after).alias("hi")) for c in measures})
    d = d.withColumns({f"_s_{c}": F.lag(f"_s_{c}", n).over(over) for c in measures})

    low, high = (lambda c: F.least(F.col(f"_p_{c}.lo"), F.col(f"_s_{c}.lo"))), (lambda c: F.greatest(F.col(f"_p_{c}.hi"), F.col(f"_s_{c}.hi")))
    return d.where("not _halo").select(*[between(F.col(c), low(c), high(c), guard).alias(c) if c in SCALES else F.col(c) for c in master.columns if c != "rn"])

"""Streaming forms: minute windows, dedup, latest rows, master and rolling scaling by micro-batch.

Streams carry `timestamp` columns (watermarks don't take timestamp_ntz); `as_stream_time` casts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickframe.functions.scalar import concat_codes, last_known, market_hours
from tickframe.operators.normalize import SCALES, between, normalize_minmax
from tickframe.operators.ticks import indicator_columns
from tickframe.plans.master import master_view, view_columns
from tickframe.sources.feeds import on_days
from tickframe.sources.sinks import append, exists, files_of, first_days, remove, settle, upsert
from tickframe.streaming.rolling import rolling_extremes


def as_stream_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def _minutes(ticks: DataFrame, delay: str):
    return ticks.withWatermark("sip_timestamp", delay).groupBy("ticker", F.window("sip_timestamp", "1 minute").alias("w"))


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("ticker", "w")]
    return df.select("ticker", F.col("w.start").alias("timestamp"), *rest)


def _quote_columns(quote: str | None = None) -> list[Column]:
    """Aggregates of quotes: of whole rows, or of the column `quote` that holds them where a row is one."""
    c = (lambda name: F.col(f"{quote}.{name}")) if quote else F.col
    at, seq = c("sip_timestamp"), c("sequence_number")
    codes = concat_codes(at, seq, c("conditions"), F.col(quote).isNotNull() if quote else None)
    return [
        F.avg(c("bid_price")).alias("avg_bid_price"), F.avg(c("ask_price")).alias("avg_ask_price"), F.min(c("bid_price")).alias("min_bid_price"), F.max(c("ask_price")).alias("max_ask_price"),
        F.sum(c("bid_size")).alias("total_bid_size"), F.sum(c("ask_size")).alias("total_ask_size"), F.count(quote or "*").alias("quote_count"),
        (F.when(F.count(quote) > 0, codes) if quote else codes).alias("quote_conditions"),
        last_known(c("ask_exchange"), at, seq).alias("ask_exchange"), last_known(c("bid_exchange"), at, seq).alias("bid_exchange"),
    ]


def _trade_columns(trade: str | None = None) -> list[Column]:
    """The same of trades."""
    c = (lambda name: F.col(f"{trade}.{name}")) if trade else F.col
    at, seq = c("sip_timestamp"), c("sequence_number")
    codes = concat_codes(at, seq, c("conditions"), F.col(trade).isNotNull() if trade else None)
    return [
        F.sum(c("size")).alias("trade_volume"), F.count(trade or "*").alias("trade_count"), (F.when(F.count(trade) > 0, codes) if trade else codes).alias("trade_conditions"),
        last_known(c("exchange"), at, seq).alias("trade_exchange"),
    ]


def stream_minute_quotes(quotes: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Raw quote minutes; a window comes out once the watermark has passed it, later ticks are dropped."""
    return _flat(_minutes(quotes, delay).agg(*_quote_columns()))


def stream_minute_trades(trades: DataFrame, delay: str = "10 seconds") -> DataFrame:
    return _flat(_minutes(trades, delay).agg(*_trade_columns()))


def stream_view(bars: DataFrame, quotes: DataFrame, trades: DataFrame, indicators: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """`master_view` of four streams, by ticker and minute: the streams are put together and a minute's rows of
    all four are one aggregate, so the state is one store a partition (as three joins of streams it was
    fifteen, whose commits took the time). Each stream has a watermark of its own; the slowest one decides. A
    minute comes out once, when the watermark has passed it, with what of the other streams came before; then
    its rows leave the state, which holds the minutes still open and no history. Rows later than the delay are
    dropped."""
    rows = None
    for name, df, ts in (("bar", bars, "timestamp"), ("quote", quotes, "sip_timestamp"), ("trade", trades, "sip_timestamp"), ("indicator", indicators, "timestamp")):
        marked = df.withWatermark(ts, delay)
        if name != "bar":
            marked = marked.where("ticker is not null")  # a bar without a ticker has no match
        fields = [F.col(c).cast("timestamp_ntz").alias(c) if c == ts else F.col(c) for c in df.columns if c != "ticker"]  # `at` alone carries the watermark
        own = marked.select("ticker", F.col(ts).alias("at"), F.struct(*fields).alias(name))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    minutes = rows.groupBy("ticker", F.window("at", "1 minute").alias("w"))
    measures = [*_quote_columns("quote"), *_trade_columns("trade"), *indicator_columns(False, "indicator.")]
    wide = minutes.agg(F.collect_list("bar").alias("bars"), *measures)
    return view_columns(wide.select("ticker", F.inline("bars"), *wide.columns[3:]))


def stream_bars(trades: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Minute bars of a stream of trades."""
    at = F.struct("sip_timestamp", "sequence_number")
    size = F.col("size").cast("double")
    return _flat(
        _minutes(trades, delay).agg(
            F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("size").alias("volume"),
            F.try_divide(F.sum(F.col("price") * size), F.nullif(F.sum(size), F.lit(0.0))).alias("vwap"), F.count("*").alias("transactions"),
        )
    )


def stream_dedup(ticks: DataFrame, keys: Sequence[str] = ("ticker", "sip_timestamp", "sequence_number"), delay: str = "10 seconds", ts: str = "sip_timestamp") -> DataFrame:
    """First arrival of each key; a replay within the watermark's delay is dropped."""
    return ticks.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Take what is there, write it as Parquet, and stop."""
    df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _each(df: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, available: bool, interval: str, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available else writer.trigger(processingTime=interval)).start()


def _newest(rows: DataFrame, by: Sequence, ts: str) -> DataFrame:
    """The newest row of each group, ties as in `latest`; one aggregate, so that it can be a stream's state."""
    rest = [c for c in rows.columns if c not in ("ticker", "w")]
    row = F.min_by(F.struct(*rest), F.struct(-F.unix_micros(F.col(ts).cast("timestamp")), *[c for c in rest if c != ts]))
    return rows.groupBy(*by).agg(row.alias("_r")).select("ticker", "_r.*")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table of latest rows that are whole, in order."""
    if not exists(spark, path):
        return []
    files, place = files_of(spark, path)
    names = [x.getPath().getName() for x in files.listStatus(place)]
    return sorted(int(n[8:]) for n in names if n.startswith("version=") and exists(spark, f"{path}/{n}/_SUCCESS"))


def latest_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table that `start_latest` keeps: one row a ticker."""
    return spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")


def _merge_latest(rows: DataFrame, path: str, batch: int, ts: str) -> None:
    """The version of a batch: the last one before it, with newer rows in place of older ones. The same
    batch again makes the same version; the one before stays for readers, those before that go."""
    spark = rows.sparkSession
    versions = _versions(spark, path)
    past = [v for v in versions if v < batch]
    every = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/version={past[-1]}")) if past else rows
    _newest(every, ["ticker"], ts).select(*rows.columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={batch}")  # a row a ticker
    for v in past[:-1]:
        remove(spark, f"{path}/version={v}")


def start_latest(
    df: DataFrame, out: str, checkpoint: str, ts: str = "timestamp", open_only: bool = True, delay: str = "10 seconds", available: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Each minute the newest row of each ticker, in market hours, into the table at out (`latest_rows`).

    The state is the newest row of each ticker in the minutes that the watermark has not passed: a row
    that is late by less than the delay still counts, a later one is dropped, and a minute's state goes
    once it is passed. What changed in a batch is merged into the table, which has a version for each
    batch, so a batch that is run again after a crash counts once."""
    rows = as_stream_time(df, ts).withWatermark(ts, delay)
    rows = rows.where(market_hours(F.col(ts).cast("timestamp_ntz"))) if open_only else rows
    newest = _newest(rows, ["ticker", F.window(ts, "1 minute").alias("w")], ts).select(*df.columns)

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.withColumn(ts, F.col(ts).cast("timestamp_ntz")).persist()
        try:
            if not rows.isEmpty():
                _merge_latest(rows, out, number, ts)
        finally:
            rows.unpersist()

    return _each(newest, batch, checkpoint, available, interval, "update")


def start_master(bars: DataFrame, sources: Callable[[], tuple[DataFrame, DataFrame, DataFrame]], out: str, checkpoint: str, available: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Each block of bars is joined with the quotes, trades and indicators there are for its days, and
    replaces its keys in the table at out. The days of a block are few, so they are plain predicates on
    time, and on the partition `date` where a source has that column. (`stream_view` joins streams.)"""

    def batch(rows: DataFrame, _: int) -> None:
        rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).persist()
        try:
            days = [r[0] for r in rows.select(F.to_date("timestamp")).distinct().collect() if r[0] is not None]
            if days:
                quotes, trades, indicators = (on_days(df, ts, days) for df, ts in zip(sources(), ("sip_timestamp", "sip_timestamp", "timestamp"), strict=True))
                upsert(master_view(rows, quotes, trades, indicators), out, ["ticker", "timestamp"])
        finally:
            rows.unpersist()

    settle(bars.sparkSession, out)
    return _each(bars, batch, checkpoint, available, interval)


def _affected(source: str, rows: DataFrame, n: int) -> DataFrame:
    """The stored rows that `rows`, which are among them, may change (`_changed`), and those that these need:
    of each ticker of `rows` all from its first to its last row there, n after and n before.

    Days are read on from these rows' own both ways, twice as many each time, until every ticker has enough
    or no more: before its first day (`first_days`), or after the table's last, it has none. So a new ticker
    doesn't widen what is read. Only tickers and times are read for that."""
    stored = rows.sparkSession.read.parquet(source)
    ends = rows.groupBy("ticker").agg(F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to")).join(first_days(source, rows), "ticker")
    low, high, begun, ending = ends.agg(*[F.to_date(x) for x in (F.min("_from"), F.max("_to"), F.max("_from"), F.min("_to"))]).first()
    edges = (F.col("date") <= F.lit(begun)) | (F.col("date") >= F.lit(ending))  # days on which any ticker has rows before its first or after its last
    last, back, ahead = stored.agg(F.max("date")).first()[0], 1, 1
    while True:
        start, end = low - dt.timedelta(days=back), high + dt.timedelta(days=ahead)
        days = stored.where(F.col("date").between(F.lit(start), F.lit(end))).join(F.broadcast(ends), "ticker")  # a row a ticker; else a ticker's whole series is one task's
        has = days.where(edges).groupBy("ticker", "first").agg(F.count_if(F.col("timestamp") < F.col("_from")).alias("before"), F.count_if(F.col("timestamp") > F.col("_to")).alias("after"))
        short = has.agg(F.count_if((F.col("before") < n) & (F.col("first") < F.lit(start))), F.count_if(F.col("after") < n)).first()
        more = bool(short[0]), bool(short[1]) and end < last
        if not any(more):
            break
        back, ahead = back * (1 + more[0]), ahead * (1 + more[1])
    side = F.when(F.col("timestamp") < F.col("_from"), -1).when(F.col("timestamp") > F.col("_to"), 1).otherwise(0)
    away = F.when(F.col("_side") < 0, -1).otherwise(1) * F.unix_micros(F.col("timestamp").cast("timestamp"))
    beside = days.where(edges).withColumn("_side", side).where("_side <> 0").withColumn("_n", F.row_number().over(Window.partitionBy("ticker", "_side").orderBy(away))).where(F.col("_n") <= n).drop("_n")
    near = days.withColumn("_side", side).where("_side = 0").unionByName(beside)  # of a long range no window is made: its rows are all taken
    return near.withColumn("_changed", F.col("_side") >= 0).drop("_from", "_to", "first", "_side")


def start_minmax(master: DataFrame, source: str, out: str, checkpoint: str, n: int = 100, available: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Rolling scaling of new master rows, however late: a block is stored at source, and its rows and the n
    of each ticker after them, which they may change, are scaled together with the n before and replace
    theirs at out. Of the stored rows only the days that hold these are read. An empty block changes
    nothing. (`start_minmax_state` reads no stored row, for rows that are late by a bounded time.)"""

    def batch(rows: DataFrame, _: int) -> None:
        columns = rows.columns
        rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).persist()
        try:
            if rows.isEmpty():
                return
            upsert(rows, source, ["ticker", "timestamp"])
            scaled = normalize_minmax(_affected(source, rows, n).select(*columns, "_changed"), n)
            upsert(scaled.where("_changed").drop("_changed"), out, ["ticker", "timestamp"])
        finally:
            rows.unpersist()

    for table in (source, out):
        settle(master.sparkSession, table)
    return _each(master, batch, checkpoint, available, interval)


def start_minmax_state(
    master: DataFrame, out: str, checkpoint: str, n: int = 100, delay: dt.timedelta = dt.timedelta(minutes=15), guard: int = 0, late: str | None = None, ttl: dt.timedelta | None = None,
    available: bool = False, interval: str = "1 minute",
) -> StreamingQuery:
    """Rolling scaling whose frames are kept as state: no stored row is read. A row may come `delay` after
    its ticker's newest one; it and the n rows after it replace theirs at out, so out is what
    `normalize_minmax` makes of all rows. What comes later than that is added to the table `late`, if one is
    named, and is in no frame. With ttl the state of a ticker without rows for so long goes (Spark then looks
    at the clock in batches without rows, so the query can't end by itself). A ticker's state is its last n
    rows and those of the delay."""
    if ttl is not None and available:
        raise ValueError("a query whose state expires by the clock never runs out of work")
    columns, measures = master.columns, [c for c in master.columns if c in SCALES]
    framed = rolling_extremes(master, n, measures, int(delay.total_seconds() * 1e6), None if ttl is None else int(ttl.total_seconds() * 1000))

    def batch(rows: DataFrame, _: int) -> None:
        rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).persist()
        try:
            if late:
                append(rows.where("_late").select(*columns), late)
            scaled = [between(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}"), guard).alias(c) if c in measures else F.col(c) for c in columns]
            upsert(rows.where("not _late").select(*scaled), out, ["ticker", "timestamp"])
        finally:
            rows.unpersist()

    settle(master.sparkSession, out)
    return _each(framed, batch, checkpoint, available, interval)

"""Feeds with declared schemas, and the scans over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.scalar import epoch_ms, epoch_ns, parse_utc

BARS = "ticker string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, vwap double, transactions bigint"
TRADES = (
    "ticker string, sip_timestamp timestamp_ntz, participant_timestamp timestamp_ntz, trf_timestamp timestamp_ntz, sequence_number bigint, price double, size int, "
    "conditions array<int>, exchange int, tape int"
)
QUOTES = (
    "ticker string, sip_timestamp timestamp_ntz, ask_exchange int, ask_price double, ask_size double, bid_exchange int, bid_price double, bid_size double, "
    "conditions array<int>, indicators array<int>, participant_timestamp timestamp_ntz, sequence_number bigint, tape int, trf_timestamp timestamp_ntz"
)
NEWS = (
    "id string, publisher string, title string, author string, published_utc timestamp_ntz, article_url string, tickers array<string>, amp_url string, image_url string, "
    "description string, keywords array<string>"
)
INDICATORS = "ticker string, timestamp timestamp_ntz, indicator_type string, window int, value double, signal double, histogram double"
#: The default universe (fixed values).
DEFAULT_UNIVERSE = ("AAPL", "AMZN", "TSLA", "NVDA", "MSFT", "GOOGL", "META", "AMD")

_RAW_BARS = "ticker string, timestamp bigint, open double, high double, low double, close double, volume double, vwap double, transactions bigint"
_RAW_TRADES = (
    "ticker string, sip_timestamp bigint, participant_timestamp bigint, trf_timestamp bigint, sequence_number bigint, price double, size double, conditions array<int>, exchange int, tape int"
)
_RAW_QUOTES = (
    "ticker string, sip_timestamp bigint, ask_exchange int, ask_price double, ask_size double, bid_exchange int, bid_price double, bid_size double, conditions array<int>, "
    "indicators array<int>, participant_timestamp bigint, sequence_number bigint, tape int, trf_timestamp bigint"
)
_RAW_NEWS = (
    "id string, publisher struct<name:string>, title string, author string, published_utc string, article_url string, tickers array<string>, amp_url string, image_url string, "
    "description string, keywords array<string>"
)
_RAW_INDICATORS = "ticker string, timestamp bigint, indicator_type string, window int, value double, signal double, histogram double"


#: Landed schemas by feed, and the column that takes records which can't be read.
RAW = {"bars": _RAW_BARS, "daily": _RAW_BARS, "trades": _RAW_TRADES, "quotes": _RAW_QUOTES, "news": _RAW_NEWS, "indicators": _RAW_INDICATORS}
CORRUPT = "_corrupt"
#: Milliseconds and nanoseconds that a timestamp of microseconds can hold.
_MOST_MS = 9 * 10**15
_NONE_INT, _NONE_TEXT = "cast(array() as array<int>)", "cast(array() as array<string>)"


def _columns(schema: str) -> list[tuple[str, str]]:
    return [tuple(x.split(" ", 1)) for x in schema.split(", ")]


def _files(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    """Landed files; of text forms, records that don't parse come as `_corrupt`, what fits of them beside it."""
    if kind == "json":
        return spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return spark.read.schema(schema).format(kind).load(path)


def _ms(c: str) -> Column:
    return epoch_ms(F.when(F.col(c).between(-_MOST_MS, _MOST_MS), F.col(c)))


def _made(feed: str, fallback: Column | None = None) -> tuple[str, dict[str, Column]]:
    """A feed's schema, and the columns of it that aren't the landed ones cast."""
    if feed in ("bars", "daily"):
        return BARS, {"timestamp": _ms("timestamp")}
    if feed in ("trades", "quotes"):
        times = {c: epoch_ns(F.col(c)) for c in ("sip_timestamp", "participant_timestamp", "trf_timestamp")}
        lists = {c: F.coalesce(c, F.expr(_NONE_INT)) for c in (("conditions",) if feed == "trades" else ("conditions", "indicators"))}
        return (TRADES if feed == "trades" else QUOTES) + ", sip_nanos bigint", times | lists | {"sip_nanos": F.col("sip_timestamp")}
    if feed == "news":
        texts = {c: F.coalesce(c, F.lit("")) for c in ("id", "title", "author", "article_url", "amp_url", "image_url", "description")}
        lists = {c: F.coalesce(c, F.expr(_NONE_TEXT)) for c in ("tickers", "keywords")}
        return NEWS, {"publisher": F.coalesce("publisher.name", F.lit("")), "published_utc": parse_utc(F.col("published_utc"), fallback), **texts, **lists}
    return INDICATORS, {"timestamp": _ms("timestamp"), "value": F.coalesce("value", F.lit(0.0))}


def _reason(raw: DataFrame, feed: str) -> Column:
    """Null, or what of a record can't be read or doesn't fit."""
    schema, made = _made(feed)
    out = [F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable"))] if CORRUPT in raw.columns else []
    if feed != "news":  # texts fit, and what is missing or no time has its value
        out += [F.when(F.col(n).isNotNull() & made.get(n, F.col(n)).try_cast(k).isNull(), F.lit(n)) for n, k in _columns(schema) if n in raw.columns]
    return F.nullif(F.concat_ws(", ", *out), F.lit(""))


def _good(raw: DataFrame, feed: str, fallback: Column | None = None) -> DataFrame:
    schema, made = _made(feed, fallback)
    return raw.where(_reason(raw, feed).isNull()).select(*[made.get(n, F.col(n)).try_cast(k).alias(n) for n, k in _columns(schema)])


def quarantined(spark: SparkSession, path: str, feed: str, kind: str = "json") -> DataFrame:
    """(feed, reason, record) of the landed records that `read_...` leaves out: as text, as far as they
    could be read. The reason is "unreadable", or the columns that they don't fit."""
    raw = _files(spark, path, RAW[feed], kind)
    text = F.to_json(F.struct(*[c for c in raw.columns if c != CORRUPT]))
    record = F.coalesce(CORRUPT, text) if CORRUPT in raw.columns else text
    return raw.select(F.lit(feed).alias("feed"), _reason(raw, feed).alias("reason"), record.alias("record")).where("reason is not null")


def bars_from(raw: DataFrame) -> DataFrame:
    """Landed bars with epoch milliseconds -> BARS. Here and below, records that don't fit are left out: see
    `quarantined`."""
    return _good(raw, "bars")


def trades_from(raw: DataFrame) -> DataFrame:
    """Landed trades with epoch nanoseconds -> TRADES and sip_nanos; conditions are never null."""
    return _good(raw, "trades")


def quotes_from(raw: DataFrame) -> DataFrame:
    """Landed quotes with epoch nanoseconds -> QUOTES and sip_nanos."""
    return _good(raw, "quotes")


def news_from(raw: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Landed news -> NEWS: the publisher's name, blanks for null texts, empty arrays for null ones."""
    return _good(raw, "news", fallback)


def indicators_from(raw: DataFrame) -> DataFrame:
    """Landed indicators with epoch milliseconds -> INDICATORS; a null value counts 0."""
    return _good(raw, "indicators")


def read_bars(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return bars_from(_files(spark, path, _RAW_BARS, kind))


def read_daily(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return read_bars(spark, path, kind)


def read_trades(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return trades_from(_files(spark, path, _RAW_TRADES, kind))


def read_quotes(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return quotes_from(_files(spark, path, _RAW_QUOTES, kind))


def read_news(spark: SparkSession, path: str, kind: str = "json", fallback: Column | None = None) -> DataFrame:
    return news_from(_files(spark, path, _RAW_NEWS, kind), fallback)


def read_indicators(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return indicators_from(_files(spark, path, _RAW_INDICATORS, kind))


def scan_range(df: DataFrame, ts: str, start, end, closed: str = "both", day: str = "date") -> DataFrame:
    """Rows from start to end (times, dates or columns of these); closed "left" leaves end out. Plain
    comparisons, so row groups are skipped; and where df has the date column `day` of a stored table, which
    is the date of ts, the same for it, so only the partitions of these days are listed and read."""
    c, first, last = F.col(ts), _time(start), _time(end)
    rows = (c >= first) & ((c <= last) if closed == "both" else (c < last))
    if dict(df.dtypes).get(day) == "date":
        rows = F.col(day).between(F.to_date(first), F.to_date(last)) & rows
    return df.where(rows)


def _time(t) -> Column:
    return (t if isinstance(t, Column) else F.lit(t)).cast("timestamp_ntz")


def on_days(df: DataFrame, ts: str, days: Sequence, day: str = "date") -> DataFrame:
    """Rows of some days, which are joined to stretches; pruned like `scan_range`."""
    ordered, terms = sorted(set(days)), []
    for k, d in enumerate(ordered):
        if not k or (d - ordered[k - 1]).days > 1:
            terms.append([d, d])
        terms[-1][1] = d
    c = F.col(ts)
    rows = reduce(lambda a, b: a | b, [(c >= _time(a)) & (c < _time(b + timedelta(days=1))) for a, b in terms], F.lit(False))
    return df.where(F.col(day).isin(ordered) & rows if dict(df.dtypes).get(day) == "date" else rows)


_COMPARE = {"gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v}


def filter_params(df: DataFrame, params: Mapping[str, object]) -> DataFrame:
    """All of {"field": v} (equal), {"field.gt": v}, .gte, .lt and .lte."""
    terms = []
    for key, value in params.items():
        name, _, op = key.rpartition(".")
        terms.append(_COMPARE[op](F.col(name), F.lit(value)) if name and op in _COMPARE else F.col(key) == F.lit(value))
    return df.where(reduce(lambda a, b: a & b, terms, F.lit(True)))


def in_universe(df: DataFrame, tickers: Sequence[str] | DataFrame = DEFAULT_UNIVERSE, column: str = "ticker") -> DataFrame:
    """Rows of the given tickers: a short list, or a table with a column ticker."""
    if isinstance(tickers, DataFrame):
        return df.join(tickers.select(F.col("ticker").alias(column)).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(*tickers))


def _last(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    whole = F.max_by(F.struct(*columns), F.struct("sip_timestamp", "sequence_number")).alias("last")
    return df.groupBy("ticker").agg(whole).select("ticker", *[F.col(f"last.{c}").alias(c) for c in columns])


def last_trade(trades: DataFrame) -> DataFrame:
    """The latest trade of each ticker; of one time the one of the highest sequence number."""
    return _last(trades, [c for c in trades.columns if c != "ticker"])


def last_quote(quotes: DataFrame) -> DataFrame:
    return _last(quotes, [c for c in quotes.columns if c != "ticker"])


def news_by_ticker(news: DataFrame, ticker: str) -> DataFrame:
    return news.where(F.array_contains("tickers", ticker))


def news_explode(news: DataFrame) -> DataFrame:
    """A row for each ticker of an item, under `ticker`."""
    return news.withColumn("ticker", F.explode("tickers"))


def subscribe(df: DataFrame, topics: Sequence[str], feed: str = "T") -> DataFrame:
    """Rows of a feed (T trades, Q quotes, ...) that topics name: "T.AAPL", or "T.*" for all. Works on
    streams."""
    own = [t.split(".", 1)[1] for t in topics if t.split(".", 1)[0] == feed]
    return df if "*" in own else df.where(F.col("ticker").isin(*own) if own else F.lit(False))

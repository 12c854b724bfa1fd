"""Registered queries of the time-series operators, each with its DuckDB SQL where it has one."""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions import scalar as P
from tickframe.operators import dedup as D
from tickframe.operators import features as W
from tickframe.operators import indicators as I
from tickframe.operators import quality as Q
from tickframe.operators import ticks as A
from tickframe.operators.normalize import PASS_THROUGH, SCALES, normalize_minmax, normalize_sigmoid
from tickframe.operators.sequence import row_index
from tickframe.plans import fixtures as X
from tickframe.plans import master as M
from tickframe.plans.fixtures import r2, r6
from tickframe.sources import feeds as S
from tickframe.sources import upkeep as U
from tickframe.sources.scratch import new_path
from tickframe.sources.sinks import append, ensure_table, drop_table, export_normalized, files_of, read_table, recreate_table, upsert
from tickframe.streaming import streams as ST


class Data:
    """The derived feeds of a folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    bars = cached_property(lambda self: X.bars(self.spark, self.dir))
    daily = cached_property(lambda self: X.daily(self.spark, self.dir))
    trades = cached_property(lambda self: X.trades(self.spark, self.dir))
    quotes = cached_property(lambda self: X.quotes(self.spark, self.dir))
    news = cached_property(lambda self: X.news(self.spark, self.dir))
    light = cached_property(lambda self: X.indicators(self.spark, self.dir))
    dup = cached_property(lambda self: X.ticks_dup(self.spark, self.dir))
    full = cached_property(lambda self: I.indicators_long(self.bars))
    master = cached_property(lambda self: M.master(self.bars, self.quotes, self.trades, self.full))
    small = cached_property(lambda self: M.master(self.bars, self.quotes, self.trades, self.light))

    def new(self, tag: str) -> str:
        return new_path(self.spark, tag)

    def stream(self) -> DataFrame:
        """Events as a stream of all trades."""
        raw = X.table(self.spark, self.dir, "events")
        events = self.spark.readStream.schema(raw.schema).parquet(f"{self.dir}/events.parquet*")  # a glob, as it may be a file or a folder
        return events


_DEFS: dict[str, tuple[Callable[[Data], DataFrame], str | None, str]] = {}


def _query(name: str, sql: str | None = None, six: str = ""):
    """Register a query. six: the double columns that are compared at six decimals."""

    def put(f: Callable[[Data], DataFrame]):
        _DEFS[name] = (f, sql, six)
        return f

    return put


def imp(x: str) -> str:
    return f"coalesce(nullif({x}, 0), 2)"


_NOW = "timestamp '2030-01-01'"
_MINUTE = "date_trunc('minute', sip_timestamp)::timestamp as timestamp"
_CODES = "array_to_string(flatten(list(conditions order by sip_timestamp, sequence_number)), '')"


def _known(c: str) -> str:
    return f"(last({c} order by sip_timestamp, sequence_number) filter (where {c} is not null))"


_QM = f"""select ticker, {_MINUTE}, {r2(imp("avg(bid_price)"))} as avg_bid_price, {r2(imp("avg(ask_price)"))} as avg_ask_price, {r2(imp("min(bid_price)"))} as min_bid_price,
 {r2(imp("max(ask_price)"))} as max_ask_price, {imp("sum(bid_size)")} as total_bid_size, {imp("sum(ask_size)")} as total_ask_size, {imp("count(*)")} as quote_count,
 coalesce(nullif({_CODES}, ''), '2') as quote_conditions, {imp(_known("ask_exchange"))} as ask_exchange, {imp(_known("bid_exchange"))} as bid_exchange from quotes_v group by all"""
_TM = f"""select ticker, {_MINUTE}, {r2(imp("avg(price)"))} as avg_trade_price, {r2(imp("min(price)"))} as min_trade_price, {r2(imp("max(price)"))} as max_trade_price,
 {imp("sum(size)::bigint")} as total_trade_size, {imp("count(*)")} as trade_count, coalesce(nullif({_CODES}, ''), '2') as trade_conditions, {imp(_known("exchange"))} as trade_exchange
 from trades_v group by all"""
_QR = f"""select ticker, {_MINUTE}, avg(bid_price) as avg_bid_price, avg(ask_price) as avg_ask_price, min(bid_price) as min_bid_price, max(ask_price) as max_ask_price,
 sum(bid_size) as total_bid_size, sum(ask_size) as total_ask_size, count(*) as quote_count, {_CODES} as quote_conditions, {_known("ask_exchange")} as ask_exchange,
 {_known("bid_exchange")} as bid_exchange from quotes_v group by all"""
_TR = f"select ticker, {_MINUTE}, sum(size)::bigint as trade_volume, count(*) as trade_count, {_CODES} as trade_conditions, {_known('exchange')} as trade_exchange from trades_v group by all"


def _pivot(source: str, imputed: bool = True) -> str:
    def one(name: str, kind: str, field: str) -> str:
        x = f"max(case when indicator_type = '{kind}' then {field} end)"
        return f"{r2(imp(x)) if imputed else x} as {name}"

    return f"select ticker, timestamp, {', '.join(one(*x) for x in A.wide_indicators())} from {source} group by all"


def _pct(new: str, old: str) -> str:
    return f"(({new}) - {old}) / nullif({old}, 0) * 100"


def _target(x: str) -> str:
    return f"case when {x} <= -1 then 0 when {x} <= -0.5 then 1 when {x} <= 0 then 2 when {x} <= 0.5 then 3 when {x} <= 1 then 4 else 5 end"


#: Bars with labels, daily ranges and true ranges.
_FEATURES = f"""
b0 as (select ticker, timestamp, {r2("open")} as open, {r2("high")} as high, {r2("low")} as low, {r2("close")} as close, {imp("volume")} as volume, {r2(imp("vwap"))} as vwap,
  {imp("transactions")} as transactions, timestamp::date as d from bars_v),
b1 as (select *, lead(close, 15) over w as future_close, max(close) over f as mx, min(close) over f as mn, {r2("max(high) over (partition by ticker, d)")} as daily_high,
  {r2("min(low) over (partition by ticker, d)")} as daily_low, {r2("lag(close) over w")} as previous_row from b0
  window w as (partition by ticker, d order by timestamp), f as (partition by ticker, d order by timestamp rows between 1 following and 15 following)),
pd as (select ticker, d, {r2("lag(c) over (partition by ticker order by d)")} as previous_close from (select ticker, d, last(close order by timestamp) as c from b0 group by all)),
b2 as (select b1.*, previous_close, {_pct("future_close", "close")} as price_diff,
  {r2(f"case when abs({_pct('mx', 'close')}) > abs({_pct('mn', 'close')}) then {_pct('mx', 'close')} else {_pct('mn', 'close')} end")} as max_price_diff,
  daily_high - daily_low as tr_current, daily_high - previous_close as tr_high_close, daily_low - previous_close as tr_low_close,
  greatest(daily_high - daily_low, abs(daily_high - previous_close), abs(daily_low - previous_close)) as tr_value from b1 left join pd using (ticker, d)),
b3 as (select *, {_target("price_diff")} as target, avg(tr_value) over (partition by ticker, d order by timestamp rows between 13 preceding and current row) as atr_value from b2)"""

#: Means by windows, recursions row by row.
_IND = f"""
idx as (select ticker, timestamp, close, row_number() over (partition by ticker order by timestamp) - 1 as rn from bars_v),
rec as (select ticker, rn, close, close as e9, close as e12, close as e20, close as e26, 0::double as sg, null::double as up, null::double as dn from idx where rn = 0
  union all select i.ticker, i.rn, i.close, e9 + (i.close - e9) * (2::double / 10), e12 + (i.close - e12) * (2::double / 13), e20 + (i.close - e20) * (2::double / 21),
    e26 + (i.close - e26) * (2::double / 27),
    sg + ((e12 + (i.close - e12) * (2::double / 13)) - (e26 + (i.close - e26) * (2::double / 27)) - sg) * (2::double / 10),
    case when i.rn = 1 then greatest(i.close - r.close, 0) else up + (greatest(i.close - r.close, 0) - up) / 14 end,
    case when i.rn = 1 then greatest(r.close - i.close, 0) else dn + (greatest(r.close - i.close, 0) - dn) / 14 end
  from rec r join idx i on i.ticker = r.ticker and i.rn = r.rn + 1),
sm as (select ticker, timestamp, rn, {", ".join(f"avg(close) over (partition by ticker order by rn rows between {n - 1} preceding and current row) as s{n}" for n in A.SMA_WINDOWS)} from idx),
ind_full as ({" union all ".join(f"select ticker, timestamp, 'SMA_{n}' as indicator_type, {n} as window, s{n} as value, null::double as signal, null::double as histogram from sm where rn >= {n - 1}" for n in A.SMA_WINDOWS)}
  union all {" union all ".join(f"select ticker, timestamp, 'EMA_{n}', {n}, e{n}, null, null from rec join idx using (ticker, rn) where rn >= {n - 1}" for n in A.EMA_WINDOWS)}
  union all select ticker, timestamp, 'MACD', 0, e12 - e26, sg, e12 - e26 - sg from rec join idx using (ticker, rn) where rn >= 33
  union all select ticker, timestamp, 'RSI', 14, case when dn = 0 then 100 else 100 - 100 / (1 + up / dn) end, null, null from rec join idx using (ticker, rn) where rn >= 14)"""


def _master_sql(indicators: str, more: str = "") -> str:
    def side(c: str) -> str:
        return f"coalesce({c}, '') as {c}" if c.endswith("conditions") else f"coalesce({c}, 0) as {c}"

    sides = (*M._QUOTES, *M._TRADES, *M._INDICATORS)
    return f"""{more}{_FEATURES.lstrip()}, qm as ({_QM}), tm as ({_TM}), im as ({_pivot(indicators)}),
mst as (select {", ".join(side(c) if c in sides else c for c in M.MASTER)} from b3 left join qm using (ticker, timestamp) left join tm using (ticker, timestamp) left join im using (ticker, timestamp))"""


_MASTER = f"with recursive {_IND.strip()}, " + _master_sql("ind_full")
_SMALL = "with " + _master_sql("ind_v")
_MASTER_SIX = ",".join(c for c in M.MASTER if c in SCALES and c not in ("volume", "transactions", "quote_count", "trade_count", "total_trade_size"))


def _sigmoid(c: str) -> str:
    return r2(f"5 / (1 + exp(-5 * coalesce(nullif({c}, 0), 2)::double / {SCALES[c]}::double))")


def _minmax(c: str) -> str:
    return r2(f"5 * ((({c}) - min({c}) over m)::double / nullif((max({c}) over m - min({c}) over m)::double, 0))")


_M100 = "window m as (partition by ticker order by timestamp rows between 100 preceding and current row)"
_BARS_SIX = "vwap"


# sources and scans


def _ms(c: str):
    return F.unix_millis(F.col(c).cast("timestamp"))


def _ns(c: str):
    return F.unix_micros(F.col(c).cast("timestamp")) * 1000


@_query("src_bars", "select * from bars_v", _BARS_SIX)
def _(d: Data):
    return S.bars_from(d.bars.withColumn("timestamp", _ms("timestamp")))


@_query("src_daily", "select * from daily_v", _BARS_SIX)
def _(d: Data):
    return S.bars_from(d.daily.withColumn("timestamp", _ms("timestamp")))


@_query("src_trades", "select *, epoch_us(sip_timestamp) * 1000 as sip_nanos from trades_v")
def _(d: Data):
    raw = d.trades.withColumn("conditions", F.when(F.size("conditions") > 0, F.col("conditions")))
    return S.trades_from(raw.withColumns({c: _ns(c) for c in ("sip_timestamp", "participant_timestamp", "trf_timestamp")}))


@_query("src_quotes", "select *, epoch_us(sip_timestamp) * 1000 as sip_nanos from quotes_v")
def _(d: Data):
    return S.quotes_from(d.quotes.withColumns({c: _ns(c) for c in ("sip_timestamp", "participant_timestamp", "trf_timestamp")}))


@_query("src_news", f"select * exclude (doc_id) replace (case when doc_id % 50 = 0 then {_NOW} else published_utc end as published_utc) from news_v")
def _(d: Data):
    raw = d.news.withColumn("published_utc", F.col("published")).withColumn("publisher", F.struct(F.col("publisher").alias("name")))
    for c in ("author", "amp_url", "image_url"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    return S.news_from(raw, F.lit("2030-01-01").cast("timestamp_ntz"))


@_query("src_indicators", "select * replace (coalesce(case when value > 40 then value end, 0) as value) from ind_v")
def _(d: Data):
    raw = d.light.withColumn("timestamp", _ms("timestamp")).withColumn("value", F.when(F.col("value") > 40, F.col("value")))
    return S.indicators_from(raw)


def _landing(d: Data) -> str:
    """Bars as landed lines, of which some are cut off, and some have a volume or a time that fits no column."""
    path = d.new("landing")
    raw = d.bars.withColumn("timestamp", _ms("timestamp")).withColumn("volume", F.col("volume").cast("double"))
    m = F.minute(F.timestamp_millis("timestamp")) % 10
    raw = raw.withColumn("m", m).withColumn("volume", F.when(F.col("m") == 3, F.lit(1e30)).otherwise(F.col("volume"))).withColumn("timestamp", F.when(F.col("m") == 5, F.lit(2**62)).otherwise(F.col("timestamp")))
    line = F.to_json(F.struct(*d.bars.columns))
    raw.select(F.when(F.col("m") == 7, F.substring(line, 1, 40)).otherwise(line).alias("value")).write.text(path)
    return path


@_query("src_bars_bad", "select * from bars_v where minute(timestamp) % 10 not in (3, 5, 7)", _BARS_SIX)
def _(d: Data):
    return S.read_bars(d.spark, _landing(d))


@_query("quarantine", """select 'bars' as feed, case minute(timestamp) % 10 when 3 then 'volume' when 5 then 'timestamp' else 'unreadable' end as reason, count(*) as records
 from bars_v where minute(timestamp) % 10 in (3, 5, 7) group by all""")
def _(d: Data):
    return S.quarantined(d.spark, _landing(d), "bars").groupBy("feed", "reason").agg(F.count("*").alias("records"))


@_query("scan_closed", "select * from bars_v where timestamp >= timestamp '2024-01-03' and timestamp <= timestamp '2024-01-05'", _BARS_SIX)
def _(d: Data):
    return S.scan_range(d.bars, "timestamp", "2024-01-03", "2024-01-05")


@_query("scan_halfopen", "select * from trades_v where sip_timestamp >= timestamp '2024-01-03' and sip_timestamp < timestamp '2024-01-05'")
def _(d: Data):
    return S.scan_range(d.trades, "sip_timestamp", "2024-01-03", "2024-01-05", "left")


@_query("filter_params", "select * from quotes_v where bid_size >= 29 and bid_size <= 30 and ask_price > 1.5")
def _(d: Data):
    return S.filter_params(d.quotes, {"bid_size.gte": 29.0, "bid_size.lte": 30.0, "ask_price.gt": 1.5})


@_query("universe", "select * from trades_v where ticker in ('click', 'view')")
def _(d: Data):
    return S.in_universe(d.trades, ["click", "view"])


@_query("last_trade", "select * from trades_v qualify row_number() over (partition by ticker order by sip_timestamp desc, sequence_number desc) = 1")
def _(d: Data):
    return S.last_trade(d.trades)


@_query("last_quote", "select * from quotes_v qualify row_number() over (partition by ticker order by sip_timestamp desc, sequence_number desc) = 1")
def _(d: Data):
    return S.last_quote(d.quotes)


@_query("subscribe", "select * from trades_v where ticker in ('click', 'purchase')")
def _(d: Data):
    return S.subscribe(d.trades, ["T.click", "T.purchase", "Q.*"])


@_query("export_sorted", "select ticker, timestamp, close, volume from bars_v")
def _(d: Data):
    """Written as range-sorted files, and read again."""
    path = d.new("export")
    export_normalized(d.bars, path, ["ticker", "timestamp", "close", "volume"])
    return d.spark.read.parquet(path)


@_query("news_by_ticker", "select id, published_utc, tickers from news_v where list_contains(tickers, 'view')")
def _(d: Data):
    return S.news_by_ticker(d.news, "view").select("id", "published_utc", "tickers")


@_query("news_explode", "select id, published_utc, unnest(tickers) as ticker from news_v")
def _(d: Data):
    return S.news_explode(d.news).select("id", "published_utc", "ticker")


# scalars


@_query("impute", "select event_id, coalesce(nullif(k, 0), 2) as k, coalesce(nullif(value, 0), 2)::double as value, coalesce(nullif(case when k > 50 then ticker else '' end, ''), '2') as name from ev")
def _(d: Data):
    t = X.ticks(X.table(d.spark, d.dir, "events"))
    name = P.impute(F.when(F.col("k") > 50, F.col("ticker")).otherwise(F.lit("")), "2")
    return t.select("event_id", P.impute(F.col("k")).alias("k"), P.impute(F.col("value"), 2.0).alias("value"), name.alias("name"))


@_query("round2", f"select event_id, {r2('value / 7')} as third, {r2('k + 0.005::double')} as tie from ev")
def _(d: Data):
    t = X.ticks(X.table(d.spark, d.dir, "events"))
    return t.select("event_id", P.round2(F.col("value") / 7).alias("third"), P.round2(F.col("k") + F.lit(0.005)).alias("tie"))


@_query("market_hours", """select event_id, isodow(l) <= 5 and hour(l) * 3600 + minute(l) * 60 + floor(second(l)) between 34200 and 57600 as is_open
 from (select event_id, timezone('America/New_York', timezone('UTC', ts)) as l from ev)""")
def _(d: Data):
    return X.ticks(X.table(d.spark, d.dir, "events")).select("event_id", P.market_hours(F.col("ts")).alias("is_open"))


@_query("epoch_ts", "select event_id, date_trunc('millisecond', ts)::timestamp as from_ms, ts as from_ns from ev")
def _(d: Data):
    t = X.ticks(X.table(d.spark, d.dir, "events")).select("event_id", _ms("ts").alias("ms"), _ns("ts").alias("ns"))
    return t.select("event_id", P.epoch_ms(F.col("ms")).alias("from_ms"), P.epoch_ns(F.col("ns") + 999).alias("from_ns"))


@_query("parse_utc", f"select id, case when doc_id % 50 = 0 then {_NOW} else published_utc end as published_utc from news_v")
def _(d: Data):
    return d.news.select("id", P.parse_utc(F.col("published"), F.lit("2030-01-01").cast("timestamp_ntz")).alias("published_utc"))


@_query("conditions_concat", f"select ticker, {_MINUTE}, coalesce(nullif({_CODES}, ''), '2') as conditions from trades_v group by all")
def _(d: Data):
    codes = P.impute(P.concat_codes(F.col("sip_timestamp"), F.col("sequence_number"), F.col("conditions")), "2")
    return d.trades.groupBy("ticker", P.minute_of(F.col("sip_timestamp")).alias("timestamp")).agg(codes.alias("conditions"))


# aggregates over ticks


def _bars_sql(unit: str) -> str:
    return f"""select ticker, date_trunc('{unit}', sip_timestamp)::timestamp as timestamp, first(price order by sip_timestamp, sequence_number) as open, max(price) as high, min(price) as low,
 last(price order by sip_timestamp, sequence_number) as close, sum(size)::bigint as volume, sum(price * size) / nullif(sum(size), 0) as vwap, count(*) as transactions from trades_v group by all"""


for _unit in ("minute", "hour", "day"):
    _query(f"bars_{_unit}", _bars_sql(_unit), "vwap")(lambda d, unit=_unit: A.to_bars(d.trades, f"1 {unit}"))

_query("quote_metrics", _QM)(lambda d: A.quote_minute(d.quotes))
_query("trade_metrics", _TM)(lambda d: A.trade_minute(d.trades))
_query("minute_quotes", _QR, "avg_bid_price,avg_ask_price")(lambda d: A.quote_minute(d.quotes, False))
_query("minute_trades", _TR)(lambda d: A.trade_minute(d.trades, False))
_query("indicator_pivot", _pivot("ind_v"))(lambda d: A.pivot_indicators(d.light))
_query("date_range", "select min(timestamp)::date as min_date, max(timestamp)::date as max_date from bars_v")(lambda d: A.date_range(d.bars))

# features


def _feature(columns: str, six: str = ""):
    return f"with {_FEATURES.strip()} select ticker, timestamp, {columns} from b3", six


def _rounded(d: Data) -> DataFrame:
    return W.rounded_prices(d.bars)


_query("future_close", *_feature("future_close"))(lambda d: W.future_close(_rounded(d)).select("ticker", "timestamp", "future_close"))
_query("price_diff", *_feature("price_diff", "price_diff"))(lambda d: W.labels(W.future_close(_rounded(d))).select("ticker", "timestamp", "price_diff"))
_query("target", *_feature("target"))(lambda d: W.labels(W.future_close(_rounded(d))).select("ticker", "timestamp", "target"))
_query("max_price_diff", *_feature("max_price_diff"))(lambda d: W.max_price_diff(_rounded(d)).select("ticker", "timestamp", "max_price_diff"))
_query("daily_range", *_feature("daily_high, daily_low"))(lambda d: W.daily_range(_rounded(d)).select("ticker", "timestamp", "daily_high", "daily_low"))
_query("previous_close_day", *_feature("previous_close"))(lambda d: W.previous_close(_rounded(d)).select("ticker", "timestamp", "previous_close"))
_query("previous_close_row", *_feature("previous_row as previous_close"))(lambda d: W.previous_close(_rounded(d), "prev_row").select("ticker", "timestamp", "previous_close"))
_TRS = ("tr_current", "tr_high_close", "tr_low_close", "tr_value")
_query("true_range", *_feature(", ".join(_TRS), ",".join(_TRS)))(lambda d: W.true_ranges(W.previous_close(W.daily_range(_rounded(d)))).select("ticker", "timestamp", *_TRS))
_query("atr", *_feature("atr_value", "atr_value"))(lambda d: W.atr(W.true_ranges(W.previous_close(W.daily_range(_rounded(d))))).select("ticker", "timestamp", "atr_value"))
#: The same over all days of a ticker.
_ALONG = f"""{_FEATURES}, c1 as (select *, lead(close, 15) over w as ahead, max(close) over f as top, min(close) over f as low_, avg(tr_value) over g as atr_all from b2
  window w as (partition by ticker order by timestamp), f as (partition by ticker order by timestamp rows between 1 following and 15 following),
  g as (partition by ticker order by timestamp rows between 13 preceding and current row))"""


def _along(columns: str, six: str = ""):
    return f"with {_ALONG.strip()} select ticker, timestamp, {columns} from c1", six


_query("future_close_none", *_along("ahead as future_close"))(lambda d: W.future_close(_rounded(d), session="none").select("ticker", "timestamp", "future_close"))
_query("max_price_diff_none", *_along(r2(f"case when abs({_pct('top', 'close')}) > abs({_pct('low_', 'close')}) then {_pct('top', 'close')} else {_pct('low_', 'close')} end") + " as max_price_diff"))(
    lambda d: W.max_price_diff(_rounded(d), session="none").select("ticker", "timestamp", "max_price_diff")
)
_query("atr_none", *_along("atr_all as atr_value", "atr_value"))(
    lambda d: W.atr(W.true_ranges(W.previous_close(W.daily_range(_rounded(d)))), session="none").select("ticker", "timestamp", "atr_value")
)
_query(
    "atr_daily",
    """with t as (select ticker, timestamp, greatest(high - low, abs(high - p), abs(low - p)) as tr_value from (select *, lag(close) over (partition by ticker order by timestamp) as p from daily_v))
 select ticker, timestamp, avg(tr_value) over (partition by ticker order by timestamp rows between 13 preceding and current row) as atr_value from t""",
    "atr_value",
)(lambda d: W.atr_daily(d.daily).select("ticker", "timestamp", "atr_value"))

# indicators
_LONG = "value,signal,histogram"


def _ind(where: str) -> str:
    return f"with recursive {_IND.strip()} select * from ind_full where {where}"


_query("sma", _ind("indicator_type like 'SMA%'"), _LONG)(lambda d: I.sma(d.bars))
_query("ema", _ind("indicator_type like 'EMA%'"), _LONG)(lambda d: I.ema(d.bars))
_query("macd", _ind("indicator_type = 'MACD'"), _LONG)(lambda d: I.macd(d.bars))
_query("rsi", _ind("indicator_type = 'RSI'"), _LONG)(lambda d: I.rsi(d.bars))
_query("indicators_long", _ind("true"), _LONG)(lambda d: d.full)

# joins and composites
_query(
    "master_join",
    f"with q as ({_QM}), t as ({_TM}), i as ({_pivot('ind_v')}) select * from bars_v left join q using (ticker, timestamp) left join t using (ticker, timestamp) left join i using (ticker, timestamp)",
    "vwap",
)(lambda d: M.joined(d.bars, A.quote_minute(d.quotes), A.trade_minute(d.trades), A.pivot_indicators(d.light)))
_ZERO = (*M._QUOTES[:7], "trade_volume", "trade_count")
_query(
    "master_view",
    f"with q as ({_QR}), t as ({_TR}), i as ({_pivot('ind_v', False)}) select * replace ({', '.join(f'coalesce({c}, 0) as {c}' for c in _ZERO)}) from bars_v"
    " left join q using (ticker, timestamp) left join t using (ticker, timestamp) left join i using (ticker, timestamp)",
    "vwap,avg_bid_price,avg_ask_price",
)(lambda d: M.master_view(d.bars, d.quotes, d.trades, d.light))
_query("master", f"{_MASTER} select * from mst", _MASTER_SIX)(lambda d: d.master)
_query("master_day", f"{_SMALL} select * from mst where timestamp::date = date '2024-01-04'", _MASTER_SIX)(
    lambda d: M.master_range(d.bars, d.quotes, d.trades, d.light, "2024-01-04", "2024-01-04")
)
_PASS = ", ".join(PASS_THROUGH)
_query("normalized_sigmoid", f"{_MASTER} select {_PASS}, {', '.join(f'{_sigmoid(c)} as {c}' for c in SCALES)} from mst")(lambda d: normalize_sigmoid(d.master))
_query("normalized_minmax", f"{_MASTER} select {_PASS}, {', '.join(f'{_minmax(c)} as {c}' for c in SCALES)} from mst {_M100}")(lambda d: normalize_minmax(M.master(row_index(d.bars), d.quotes, d.trades, d.full)))
_SOME = ("open", "high", "low", "close", "volume", "vwap", "transactions")
_query("norm_sigmoid", f"select ticker, timestamp, {', '.join(f'{_sigmoid(c)} as {c}' for c in _SOME)} from bars_v")(lambda d: normalize_sigmoid(d.bars))
_query("norm_minmax", f"select ticker, timestamp, {', '.join(f'{_minmax(c)} as {c}' for c in _SOME)} from bars_v {_M100}")(lambda d: normalize_minmax(d.bars))


@_query("master_stored_day", f"{_SMALL} select * from mst where timestamp::date = date '2024-01-04'", _MASTER_SIX)
def _(d: Data):
    """The same day from stored tables, of which few days are read."""
    root = d.new("stored")
    for name, df, ts in (("bars", d.bars, "timestamp"), ("quotes", d.quotes, "sip_timestamp"), ("trades", d.trades, "sip_timestamp"), ("indicators", d.light, "timestamp")):
        append(df, f"{root}/{name}", ts)
    return M.stored_range(d.spark, root, "2024-01-04", "2024-01-04")


@_query("master_colocated", f"{_SMALL} select * from mst", _MASTER_SIX)
def _(d: Data):
    """The master over tables laid out by ticker and day."""
    tag = "tickframe_" + d.new("x")[-8:]
    names = {feed: f"{tag}_{feed}" for feed in M._LANDED}
    for feed, df in (("bars", d.bars), ("quotes", d.quotes), ("trades", d.trades), ("indicators", d.light)):
        M.colocate(names[feed], feed, df, 8)
    path = d.new("master")
    M.master_colocated(d.spark, names, path)
    for name in names.values():
        drop_table(d.spark, name)
    return d.spark.read.parquet(path)


@_query("master_upsert", f"{_SMALL} select ticker, timestamp, close, case when timestamp::date = date '2024-01-04' then 2 else 1 end as version from mst")
def _(d: Data):
    """The whole master, then one day of it again: the day's rows are replaced."""
    path = d.new("master")
    rows = d.small.select("ticker", "timestamp", "close")
    upsert(rows.withColumn("version", F.lit(1)), path, ["ticker", "timestamp"])
    upsert(rows.where(F.to_date("timestamp") == "2024-01-04").withColumn("version", F.lit(2)), path, ["ticker", "timestamp"])
    return read_table(d.spark, path).select("ticker", "timestamp", "close", "version")


@_query("append_sink", "select ticker, timestamp, close from bars_v union all select ticker, timestamp, close from bars_v where timestamp < timestamp '2024-01-03'")
def _(d: Data):
    """All bars, an empty frame, and two days of them again."""
    path, rows = d.new("append"), d.bars.select("ticker", "timestamp", "close")
    append(rows, path)
    append(rows.where("false"), path)
    append(rows.where("timestamp < timestamp_ntz '2024-01-03'"), path)
    return read_table(d.spark, path).select("ticker", "timestamp", "close")


@_query("table_lifecycle", "select ticker, count(*) as n from bars_v group by 1")
def _(d: Data):
    """A table is created, filled, created again in vain, dropped, recreated and filled once."""
    name = "tickframe_bars_" + d.new("x")[-8:]
    for make in (ensure_table, ensure_table, recreate_table):
        make(d.spark, name, "ticker string, timestamp timestamp_ntz, close double")
        d.bars.select("ticker", "timestamp", "close").write.mode("append").insertInto(name)
    path = d.new("table")
    d.spark.table(name).groupBy("ticker").agg(F.count("*").alias("n")).write.parquet(path)
    drop_table(d.spark, name)
    return d.spark.read.parquet(path)


def _stats(t: str, ts: str = "timestamp") -> str:
    return f"select count(*) as total_rows, count(distinct ticker) as unique_tickers, min({ts}) as earliest, max({ts}) as latest, count(distinct {ts}::date) as unique_days from {t}"


def _history(d: Data, indicators: bool = False) -> str:
    """Landed feeds through the whole run; the folder of its tables."""
    src, out = d.new("landing"), d.new("history")
    d.bars.withColumn("timestamp", _ms("timestamp")).write.json(f"{src}/bars")
    d.daily.withColumn("timestamp", _ms("timestamp")).write.json(f"{src}/daily")
    times = {c: _ns(c) for c in ("sip_timestamp", "participant_timestamp", "trf_timestamp")}
    d.trades.withColumns(times).write.json(f"{src}/trades")
    d.quotes.withColumns(times).write.json(f"{src}/quotes")
    d.news.withColumn("published_utc", F.col("published")).withColumn("publisher", F.struct(F.col("publisher").alias("name"))).drop("published").write.json(f"{src}/news")
    if indicators:
        d.light.withColumn("timestamp", _ms("timestamp")).write.json(f"{src}/indicators")
    M.build_all(d.spark, src, out, "1998-06-01", "2035-01-01", ["click", "view", "purchase", "error", "signup", "1-URGENT", "2-HIGH"])
    return out


@_query("history_run", _DEFS["normalized_sigmoid"][1])
def _(d: Data):
    return read_table(d.spark, f"{_history(d)}/normalized").select(*M.MASTER)


_HELD = {"bars": "bars_v", "daily": "(from daily_v where ticker in ('1-URGENT', '2-HIGH') and timestamp >= timestamp '1998-06-01')", "trades": "trades_v", "quotes": "quotes_v", "indicators": "ind_v", "master": "bars_v", "normalized": "bars_v"}


@_query("history_tables", " union all ".join(f"select '{n}' as table_name, * from ({_stats(t, D.KEYS.get(n, ('timestamp',))[0])})" for n, t in _HELD.items()))
def _(d: Data):
    """What the run stores of each feed, daily bars and a landed indicator feed among them."""
    out = _history(d, indicators=True)
    parts = [Q.table_stats(read_table(d.spark, f"{out}/{n}"), D.KEYS.get(n, ("timestamp",))[0]).select(F.lit(n).alias("table_name"), "*") for n in _HELD]
    return reduce(DataFrame.unionByName, parts)


@_query("backfill_daily", "select * from daily_v where timestamp >= timestamp '1995-03-01' and timestamp <= timestamp '1995-12-31'", _BARS_SIX)
def _(d: Data):
    """Months loaded one by one, whose closed ranges share their boundary days, then deduplicated."""
    cuts = ["1995-03-01", "1995-04-15", "1995-06-01", "1995-09-01", "1995-12-31"]
    path = d.new("backfill")
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        append(S.scan_range(d.daily, "timestamp", a, b).withColumn("chunk", F.lit(k)), path)
    return D.dedup_last(read_table(d.spark, path), ["ticker", "timestamp"], ["chunk"]).select(*d.daily.columns)


@_query("backfill_indicators", "select * from ind_v where timestamp >= timestamp '2024-01-02' and timestamp <= timestamp '2024-01-25'")
def _(d: Data):
    """Weeks loaded one by one, whose closed ranges share their boundaries, then deduplicated by type."""
    first, path = datetime.date(2024, 1, 2), d.new("backfill")
    cuts = [first + datetime.timedelta(days=min(7 * k, 23)) for k in range(5)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        append(S.scan_range(d.light, "timestamp", str(a), str(b)).withColumn("chunk", F.lit(k)), path)
    return D.dedup_last(read_table(d.spark, path), ["ticker", "timestamp", "indicator_type"], ["chunk"]).select(*d.light.columns)


# duplicates
_KEY = ["ticker", "sip_timestamp"]
_query("dedup_last", "select * from ticks_dup qualify row_number() over (partition by ticker, sip_timestamp order by ingest_seq desc, sequence_number desc) = 1")(
    lambda d: D.dedup_last(d.dup, _KEY, ["ingest_seq", "sequence_number"])
)
_query(
    "dedup_ms", "select * from ticks_dup qualify row_number() over (partition by ticker, date_trunc('millisecond', sip_timestamp) order by sip_timestamp, sequence_number, ingest_seq) = 1"
)(lambda d: D.dedup_ms(d.dup, order=("sip_timestamp", "sequence_number", "ingest_seq")))
_query(
    "dedup_report",
    """select count(*) as total_rows, count(distinct (ticker, date_trunc('millisecond', sip_timestamp))) as unique_rows,
 count(*) - count(distinct (ticker, date_trunc('millisecond', sip_timestamp))) as would_delete from ticks_dup""",
)(lambda d: D.dedup_report(d.dup))
_query("latest_only", "select * from bars_v qualify row_number() over (partition by ticker order by timestamp desc) = 1", _BARS_SIX)(lambda d: D.latest(d.bars))
_query("latest_indicator", "select * from ind_v qualify row_number() over (partition by ticker, indicator_type order by timestamp desc) = 1")(
    lambda d: D.latest(d.light, ("ticker", "indicator_type"))
)

# profiles


def _dup(of: str, t: str) -> str:
    n, u = "count(*)", f"count(distinct {of})"
    return f"select {n} as total_rows, {u} as unique_rows, {n} - {u} as duplicate_rows, coalesce(({n} - {u}) * 100::double / nullif({n}, 0), 0) as duplicate_pct from {t}"


def _quality_sql(t: str, columns: list[tuple[str, bool]]) -> str:
    rows = [f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count, {f'count(*) filter (where {c} = 0)' if n else 'null::bigint'} as zero_count from {t}" for c, n in columns]
    return " union all ".join(rows)


_QUOTE_COLS = [(x.split(" ")[0], x.split(" ")[1] in ("int", "double", "bigint")) for x in S.QUOTES.split(", ") if "array" not in x]
_query("table_stats", _stats("bars_v"))(lambda d: Q.table_stats(d.bars))


def _written(d: Data) -> str:
    """The bars in three writes of which profiles are kept: two appends, and one day again over zeroed rows."""
    path, day = d.new("profiled"), "2024-01-04"
    early = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")
    zeroed = F.when(F.to_date("timestamp") == day, F.lit(0.0)).otherwise(F.col("close"))
    U.append_profiled(d.bars.where(early).withColumn("close", zeroed), path)
    U.append_profiled(d.bars.where(~early), path)
    U.upsert_profiled(d.bars.where(F.to_date("timestamp") == day), path, ["ticker", "timestamp"])
    return path


_BAR_COLS = [(x.split(" ")[0], x.split(" ")[1] in ("int", "double", "bigint")) for x in S.BARS.split(", ")]
_query("profile_stats", _stats("bars_v"))(lambda d: U.profile_stats(d.spark, _written(d)))
_query("profile_quality", _quality_sql("bars_v", _BAR_COLS))(lambda d: U.profile_quality(d.spark, _written(d)))


def _stored_dup(d: Data) -> str:
    path = d.new("duplicates")
    append(d.dup, path, "sip_timestamp")
    return path


@_query("dedup_stored", "select * from ticks_dup qualify row_number() over (partition by ticker, sip_timestamp order by ingest_seq desc, sequence_number desc) = 1")
def _(d: Data):
    """Duplicates of a stored table go, in place."""
    path = _stored_dup(d)
    U.dedup_stored(d.spark, path, _KEY, ["ingest_seq", "sequence_number"], "sip_timestamp")
    return read_table(d.spark, path).select(*d.dup.columns)


_query("dedup_stored_dry", "select n as total_rows, u as unique_rows, n - u as would_delete from (select count(*) as n, count(distinct (ticker, sip_timestamp)) as u from ticks_dup)")(
    lambda d: U.stored_duplicates(d.spark, _stored_dup(d), _KEY)
)
_query(
    "date_gaps",
    """select ticker, gap_start, gap_end, date_diff('day', gap_start, gap_end)::int as days_gap from (select ticker, lag(d) over (partition by ticker order by d) as gap_start, d as gap_end
 from (select distinct ticker, timestamp::date as d from daily_v)) where date_diff('day', gap_start, gap_end) > 1 order by ticker, gap_start limit 100""",
)(lambda d: Q.date_gaps(d.daily))
_query("quality", _quality_sql("quotes_v", _QUOTE_COLS))(lambda d: Q.quality(d.quotes))
_query("dup_by_ts", _dup("sip_timestamp", "ticks_dup"), "duplicate_pct")(lambda d: Q.dup_by_ts(d.dup, "sip_timestamp"))
_query("dup_by_key", _dup("(ticker, sip_timestamp)", "ticks_dup"), "duplicate_pct")(lambda d: Q.dup_by_key(d.dup, _KEY))
_query(
    "dup_top_tickers",
    """select ticker, sum(c)::bigint as total_rows, sum(c - 1)::bigint as duplicate_rows from (select ticker, count(*) as c from ticks_dup group by ticker, sip_timestamp) group by 1
 having sum(c - 1) > 0 order by duplicate_rows desc, ticker limit 10""",
)(lambda d: Q.dup_top(d.dup, _KEY))
_query("dup_sample", "select ticker, sip_timestamp, count(*) as copies from ticks_dup group by all having count(*) > 1 order by copies desc, ticker, sip_timestamp limit 5")(
    lambda d: Q.dup_sample(d.dup, _KEY)
)
_ALL = {"bars": ("bars_v", "timestamp"), "daily": ("daily_v", "timestamp"), "trades": ("trades_v", "sip_timestamp"), "quotes": ("quotes_v", "sip_timestamp"), "news": ("news_v", "published_utc"),
        "indicators": ("ind_v", "timestamp"), "replayed": ("ticks_dup", "sip_timestamp"), "master": ("mst", "timestamp")}
_query("dup_all", f"{_SMALL} " + " union all ".join(f"select '{n}' as table_name, * from ({_dup(ts, t)})" for n, (t, ts) in _ALL.items()), "duplicate_pct")(
    lambda d: Q.dup_all({"bars": d.bars, "daily": d.daily, "trades": d.trades, "quotes": d.quotes, "news": d.news.drop("published"), "indicators": d.light, "replayed": d.dup, "master": d.small})
)
_query(
    "consistency",
    f"""with q as ({_QM}), t as ({_TM}), i as ({_pivot("ind_v")}), m as (select * from bars_v left join q using (ticker, timestamp) left join t using (ticker, timestamp) left join i using (ticker, timestamp)),
 c as (select 'bars' as check_name, (select count(*) from bars_v) as source_count, (select count(*) from m) as master_count
 union all select 'quotes', (select count(*) from q), (select count(quote_count) from m) union all select 'trades', (select count(*) from t), (select count(trade_count) from m)
 union all select 'indicators', (select count(*) from i), (select count(sma_5) from m)) select *, abs(source_count - master_count) as difference from c""",
)(lambda d: Q.consistency(M.master(d.bars, d.quotes, d.trades, d.light, unmatched="null"), d.bars, d.quotes, d.trades, d.light))
_query(
    "coverage",
    """with own as (select 'bars' as table_name, ticker from bars_v union select 'daily', ticker from daily_v union select 'trades', ticker from trades_v union select 'quotes', ticker from quotes_v
 union select 'news', unnest(tickers) from news_v union select 'indicators', ticker from ind_v)
 select table_name, ticker from (select distinct table_name from own), (select distinct ticker from own) except select table_name, ticker from own""",
)(lambda d: Q.coverage({"bars": d.bars, "daily": d.daily, "trades": d.trades, "quotes": d.quotes, "news": S.news_explode(d.news), "indicators": d.light}))
_COUNTS = "select indicator_type, count(*) as row_count, min(timestamp) as earliest, max(timestamp) as latest from ind_v {} group by 1"
_query("ind_counts", _COUNTS.format(""))(lambda d: Q.ind_counts(d.light))
_query("ind_counts_since", _COUNTS.format("where timestamp >= timestamp '2024-01-05'"))(lambda d: Q.ind_counts(d.light, "2024-01-05"))
_query("ind_daily", "select timestamp::date as date, count(*) as row_count, count(distinct indicator_type) as types, count(distinct ticker) as tickers from ind_v group by 1")(
    lambda d: Q.ind_daily(d.light)
)
_query(
    "ind_daily_tickers",
    "select timestamp::date as date, list_sort(list(distinct ticker)) as tickers from ind_v where timestamp::date between date '2024-01-03' and date '2024-01-08' group by 1",
)(lambda d: Q.ind_daily_tickers(d.light, "2024-01-03", "2024-01-08"))
_query("master_stats", f"{_SMALL} {_stats('mst')}")(lambda d: Q.table_stats(d.small))
_query("master_daily", f"{_SMALL} select timestamp::date as date, count(*) as row_count, count(distinct ticker) as tickers from mst group by 1")(lambda d: Q.master_daily(d.small))
_query("master_tickers", f"{_SMALL} select distinct ticker from mst")(lambda d: Q.tickers_of(d.small))

# streams


def _closed(sql: str, source: str) -> str:
    return f"select * from ({sql}) where timestamp + interval 1 minute <= (select max(sip_timestamp) from {source}) - interval 10 seconds"


def _stream_ticks(d: Data, make) -> DataFrame:
    return ST.as_stream_time(make(X.ticks(d.stream())), "sip_timestamp")


def _ran(d: Data, df: DataFrame) -> DataFrame:
    path = d.new("stream")
    ST.run_available(df, path, d.new("state"))
    out = d.spark.read.schema(df.schema).parquet(path)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in out.dtypes if kind == "timestamp"})


def _stream_trades(d: Data) -> DataFrame:
    return _stream_ticks(d, lambda t: X._as_trades(t.where("user_id % 2 = 0")))


_query("stream_minute_quotes", _closed(_QR, "quotes_v"), "avg_bid_price,avg_ask_price")(lambda d: _ran(d, ST.stream_minute_quotes(_stream_ticks(d, X.quotes_of))))
_query("stream_minute_trades", _closed(_TR, "trades_v"))(lambda d: _ran(d, ST.stream_minute_trades(_stream_trades(d))))
_query("stream_bars", _closed(_bars_sql("minute"), "trades_v"), "vwap")(lambda d: _ran(d, ST.stream_bars(_stream_trades(d))))
_query("stream_dedup", "select distinct ticker, sip_timestamp, sequence_number from trades_v")(
    lambda d: _ran(d, ST.stream_dedup(_stream_trades(d).select("ticker", "sip_timestamp", "sequence_number", F.explode(F.array(F.lit(0), F.lit(1))).alias("replay")), delay="1 day").drop("replay"))
)
_query("stream_norm", f"select sequence_number, ticker, {r2('5 / (1 + exp(-5 * coalesce(nullif(price, 0), 2)::double / 1000::double))')} as close from trades_v")(
    lambda d: _ran(d, normalize_sigmoid(_stream_trades(d).select("sequence_number", "ticker", F.col("price").alias("close"))))
)


def _landed(d: Data, df: DataFrame, batches: int = 1) -> DataFrame:
    """df as a stream of files, in so many batches by time."""
    path = d.new("feed")
    if batches == 1:
        df.write.parquet(path)
        return d.spark.readStream.schema(df.schema).parquet(path)
    df.repartitionByRange(batches, "timestamp").write.parquet(path)
    return d.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@_query("stream_latest", "select * from bars_v qualify row_number() over (partition by ticker order by timestamp desc) = 1", _BARS_SIX)
def _(d: Data):
    out = d.new("latest")
    ST.start_latest(_shuffled(d, d.bars, _CUTS), out, d.new("state"), open_only=False, available=True).awaitTermination()
    return ST.latest_rows(d.spark, out).select(*d.bars.columns)


@_query("stream_latest_open", """select * from bars_v where isodow(timezone('America/New_York', timezone('UTC', timestamp))) <= 5
 and timezone('America/New_York', timezone('UTC', timestamp))::time between time '09:30:00' and time '16:00:00' qualify row_number() over (partition by ticker order by timestamp desc) = 1""", _BARS_SIX)
def _(d: Data):
    """With the market gate, in several batches."""
    out = d.new("latest")
    ST.start_latest(_shuffled(d, d.bars, _CUTS), out, d.new("state"), available=True).awaitTermination()
    return ST.latest_rows(d.spark, out).select(*d.bars.columns)


@_query("stream_master", _DEFS["master_view"][1], _DEFS["master_view"][2])
def _(d: Data):
    out, columns = d.new("master"), M.master_view(d.bars, d.quotes, d.trades, d.light).columns
    ST.start_master(_landed(d, d.bars), lambda: (d.quotes, d.trades, d.light), out, d.new("state"), available=True).awaitTermination()
    return read_table(d.spark, out).select(*columns)


_CUTS = ("2024-01-08", "2024-01-15", "2024-01-22")
_LATE = "pmod(xxhash64(ticker, timestamp), 7) = 0"


#: Rows of a file of a stream that comes in several batches, about.
_FILE_ROWS = 1 << 18


def _dealt(d: Data, df: DataFrame) -> tuple[str, int, Callable[[int], None]]:
    """The rows of df by `part` as a folder of files: (folder, files of a part, what puts the next part there).
    Each part has as many files as the largest one needs (what it lacks is made up by empty ones), so that
    number is a batch. df is evaluated once, and no part goes through one task."""
    staged, path = d.new("parts"), d.new("feed")
    df.write.partitionBy("part").parquet(staged)
    rows = d.spark.read.schema(df.schema).parquet(staged)
    each = math.ceil(max([1, *[r[1] for r in rows.groupBy("part").count().collect()]]) / _FILE_ROWS)
    files, folder = files_of(d.spark, path)

    def put(k: int) -> None:
        part = rows.where(F.col("part") == k).drop("part")
        part.repartition(each).write.mode("append").parquet(path)
        while sum(x.getPath().getName().endswith(".parquet") for x in files.listStatus(folder)) % each:
            part.limit(0).coalesce(1).write.mode("append").parquet(path)

    return path, each, put


def _shuffled(d: Data, df: DataFrame, cuts: tuple[str, ...], late: str = "false", ts: str = "timestamp") -> DataFrame:
    """df as a stream: parts by time at the cuts, a batch each, of which the late rows come one part later."""
    part = sum((F.col(ts) >= F.lit(c).cast("timestamp_ntz")).cast("int") for c in cuts) + F.when(F.expr(late), 1).otherwise(0)
    path, each, put = _dealt(d, df.withColumn("part", part))
    for k in range(len(cuts) + 2):
        put(k)
    return d.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", each).parquet(path)


@_query("stream_view", f"""select * from ({_DEFS['master_view'][1]}) where timestamp + interval 1 minute <= (select least((select max(timestamp) from bars_v), (select max(sip_timestamp) from quotes_v),
 (select max(sip_timestamp) from trades_v), (select max(timestamp) from ind_v))) - interval 10 seconds""", _DEFS["master_view"][2])
def _(d: Data):
    """Four streams in several batches each."""
    feeds = []
    for df, ts in ((d.bars, "timestamp"), (d.quotes, "sip_timestamp"), (d.trades, "sip_timestamp"), (d.light, "timestamp")):
        feeds.append(ST.as_stream_time(_shuffled(d, df, _CUTS, ts=ts), ts))
    return _ran(d, ST.stream_view(*feeds))


@_query("stream_minmax", _DEFS["norm_minmax"][1])
def _(d: Data):
    """Several batches, each with late rows of the one before."""
    out = d.new("minmax")
    ST.start_minmax(_shuffled(d, d.bars, _CUTS, _LATE), d.new("rows"), out, d.new("state"), available=True).awaitTermination()
    return read_table(d.spark, out).select(*d.bars.columns)


@_query("stream_minmax_state", _DEFS["norm_minmax"][1])
def _(d: Data):
    """The same by state: all batches but the last, and the last after a restart."""
    out, state = d.new("minmax"), d.new("state")
    part = sum((F.col("timestamp") >= F.lit(c).cast("timestamp_ntz")).cast("int") for c in _CUTS) + F.expr(f"if({_LATE}, 1, 0)")
    path, each, put = _dealt(d, d.bars.withColumn("part", part))
    for parts in ((0, 1, 2), (3, 4)):
        for k in parts:
            put(k)
        feed = ST.as_stream_time(d.spark.readStream.schema(d.bars.schema).option("maxFilesPerTrigger", each).parquet(path), "timestamp")
        ST.start_minmax_state(feed, out, state, delay=datetime.timedelta(days=20), available=True).awaitTermination()
    return read_table(d.spark, out).select(*d.bars.columns)


def _run(f: Callable[[Data], DataFrame], six: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(Data(spark, sf_dir))
        return df.withColumns({c: X.six(F.col(c)) for c in six.split(",") if c})

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(f, six) for name, (f, _, six) in _DEFS.items()}


def _statement(sql: str, six: str) -> str:
    """The query's SQL behind the derived feeds, its doubles at six decimals."""
    sql = sql.strip()
    if sql.startswith("with recursive "):
        head, body = f"with recursive {X.ctes()}, ", sql[len("with recursive ") :]
    elif sql.startswith("with "):
        head, body = f"with {X.ctes()}, ", sql[len("with ") :]
    else:
        head, body = f"with {X.ctes()} ", sql
    if not six:
        return head + body
    replaced = ", ".join(f"{r6(c)} as {c}" for c in six.split(",") if c)
    return f"select * replace ({replaced}) from ({head}{body})"


def oracle_sql() -> dict[str, str]:
    return {name: _statement(sql, six) for name, (_, sql, six) in _DEFS.items() if sql}

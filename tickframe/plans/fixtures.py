"""Feeds derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.scalar import minute_of
from tickframe.operators.sequence import row_index, with_halo


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(c: Column) -> Column:
    """Six decimals, so that sums of another order compare equal."""
    return F.round(c.cast("decimal(38,10)"), 6).cast("double")


def ticks(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.col("event_type").alias("ticker"), "value", k.alias("k"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    weighted = F.sum(F.col("value").cast("decimal(18,4)") * F.col("k")).cast("double")
    return ticks(table(spark, sf_dir, "events")).groupBy("ticker", minute_of(F.col("ts")).alias("timestamp")).agg(
        F.min_by("value", at).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", at).alias("close"),
        F.sum("k").alias("volume"),
        F.try_divide(weighted, F.nullif(F.sum("k"), F.lit(0))).alias("vwap"),
        F.count("*").alias("transactions"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.groupBy(F.col("o_orderpriority").alias("ticker"), F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("timestamp")).agg(
        F.min_by(price, "o_orderkey").alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, "o_orderkey").alias("close"),
        F.count("*").alias("volume"),
        F.avg(price).alias("vwap"),
        F.count("*").alias("transactions"),
    )


def _as_trades(t: DataFrame) -> DataFrame:
    return t.select(
        "ticker", F.col("ts").alias("sip_timestamp"), F.col("ts").alias("participant_timestamp"), F.lit(None).cast("timestamp_ntz").alias("trf_timestamp"),
        F.col("event_id").alias("sequence_number"), F.col("value").alias("price"), F.col("k").alias("size"),
        F.when(F.col("k") % 10 == 0, F.expr("cast(array() as array<int>)")).otherwise(F.array(F.col("k") % 4, F.col("k") % 7)).alias("conditions"),
        (F.col("user_id") % 12).cast("int").alias("exchange"), (F.col("user_id") % 3 + 1).cast("int").alias("tape"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_trades(ticks(table(spark, sf_dir, "events")).where("user_id % 2 = 0"))


def quotes_of(t: DataFrame) -> DataFrame:
    return t.where("user_id % 3 <> 0").select(
        "ticker", F.col("ts").alias("sip_timestamp"), F.when(F.col("event_id") % 17 != 0, (F.col("event_id") % 12).cast("int")).alias("ask_exchange"),
        (F.col("value") + 0.01).alias("ask_price"), (100 - F.col("k")).cast("double").alias("ask_size"), (F.col("user_id") % 12).cast("int").alias("bid_exchange"),
        (F.col("value") - 0.01).alias("bid_price"), F.col("k").cast("double").alias("bid_size"), F.array(F.col("k") % 3).alias("conditions"), F.array(F.col("k") % 5).alias("indicators"),
        F.col("ts").alias("participant_timestamp"), F.col("event_id").alias("sequence_number"), (F.col("user_id") % 3 + 1).cast("int").alias("tape"),
        F.lit(None).cast("timestamp_ntz").alias("trf_timestamp"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_of(ticks(table(spark, sf_dir, "events")))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """published: the time as text (with Z, and unreadable for every fiftieth)."""
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    d = table(spark, sf_dir, "documents")
    d = d.join(table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("publisher"), F.substring("text", 1, 80).alias("title"), F.lit("").alias("author"),
        at.alias("published_utc"), F.when(F.col("doc_id") % 50 == 0, F.lit("junk")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("published"),
        F.coalesce("url", F.lit("")).alias("article_url"), F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("click"), F.lit("view"))).otherwise(F.array(F.lit("click"))).alias("tickers"),
        F.lit("").alias("amp_url"), F.lit("").alias("image_url"), F.col("text").alias("description"), F.array("lang", "source").alias("keywords"),
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A light long form: two means and rows of the shape of MACD."""
    indexed, w = with_halo(row_index(bars(spark, sf_dir).select("ticker", "timestamp", "close")), 19)

    def mean(n: int) -> Column:
        return six(F.avg("close").over(w.rowsBetween(1 - n, 0)))

    d = indexed.select("ticker", "timestamp", "close", mean(5).alias("a"), mean(20).alias("b"), mean(9).alias("c"), (F.col("rn") + 1).alias("n"), "_halo").where("not _halo")
    none = F.lit(None).cast("double")
    value = six(F.col("close") - F.col("b"))
    rows = F.array(
        F.struct(F.lit("SMA_5").alias("indicator_type"), F.lit(5).alias("window"), F.when(F.col("n") >= 5, F.col("a")).alias("value"), none.alias("signal"), none.alias("histogram")),
        F.struct(F.lit("SMA_20").alias("indicator_type"), F.lit(20).alias("window"), F.when(F.col("n") >= 20, F.col("b")).alias("value"), none.alias("signal"), none.alias("histogram")),
        F.struct(F.lit("MACD").alias("indicator_type"), F.lit(0).alias("window"), F.when(F.col("n") >= 20, value).alias("value"), F.col("c").alias("signal"), six(value - F.col("c")).alias("histogram")),
    )
    return d.select("ticker", "timestamp", F.inline(rows)).where("value is not null")


def ticks_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades, a replay of some with a price one higher, and some again 100 microseconds later."""
    t = _as_trades(ticks(table(spark, sf_dir, "events")))
    replay = t.where("sequence_number % 50 = 0").withColumn("price", F.col("price") + 1.0).withColumn("ingest_seq", F.lit(1))
    late = t.where("sequence_number % 75 = 0").withColumn("sip_timestamp", F.col("sip_timestamp") + F.expr("interval 100 microseconds")).withColumn("ingest_seq", F.lit(0))
    return t.withColumn("ingest_seq", F.lit(0)).unionByName(replay).unionByName(late)


#: The same as SQL; {r6} and {r2} stand for rounding through decimals.
CTES = """
ev as (select event_id, ts, user_id, event_type as ticker, value, cast(json_extract_string(props, '$.k') as int) as k from events),
bars_v as (select ticker, date_trunc('minute', ts)::timestamp as timestamp, first(value order by ts, event_id) as open, max(value) as high, min(value) as low,
  last(value order by ts, event_id) as close, sum(k)::bigint as volume, (sum(value::decimal(18,4) * k)::double / nullif(sum(k), 0))::double as vwap, count(*) as transactions
  from ev group by all),
daily_v as (select o_orderpriority as ticker, date_trunc('day', o_orderdate)::timestamp as timestamp, first(o_totalprice order by o_orderkey) as open, max(o_totalprice) as high,
  min(o_totalprice) as low, last(o_totalprice order by o_orderkey) as close, count(*) as volume, avg(o_totalprice) as vwap, count(*) as transactions from orders group by all),
alltrades as (select ticker, ts as sip_timestamp, ts as participant_timestamp, null::timestamp as trf_timestamp, event_id as sequence_number, value as price, k as size,
  case when k % 10 = 0 then []::int[] else [k % 4, k % 7] end as conditions, (user_id % 12)::int as exchange, (user_id % 3 + 1)::int as tape, user_id from ev),
trades_v as (select * exclude (user_id) from alltrades where user_id % 2 = 0),
quotes_v as (select ticker, ts as sip_timestamp, case when event_id % 17 <> 0 then (event_id % 12)::int end as ask_exchange, value + 0.01::double as ask_price, (100 - k)::double as ask_size,
  (user_id % 12)::int as bid_exchange, value - 0.01::double as bid_price, k::double as bid_size, [k % 3] as conditions, [k % 5] as indicators, ts as participant_timestamp,
  event_id as sequence_number, (user_id % 3 + 1)::int as tape, null::timestamp as trf_timestamp from ev where user_id % 3 <> 0),
news_v as (select doc_id::varchar as id, source as publisher, substr(text, 1, 80) as title, '' as author, timestamp '2024-01-01' + to_minutes(doc_id::int) as published_utc,
  coalesce(url, '') as article_url, case when doc_id % 2 = 0 then ['click', 'view'] else ['click'] end as tickers, '' as amp_url, '' as image_url, text as description,
  [lang, source] as keywords, doc_id from documents left join pages on page_id = doc_id),
ind_0 as (select ticker, timestamp, close, {a5} as a, {a20} as b, {a9} as c, row_number() over (partition by ticker order by timestamp) as n from bars_v),
ind_v as (select ticker, timestamp, 'SMA_5' as indicator_type, 5 as window, a as value, null::double as signal, null::double as histogram from ind_0 where n >= 5
  union all select ticker, timestamp, 'SMA_20', 20, b, null, null from ind_0 where n >= 20
  union all select ticker, timestamp, 'MACD', 0, {r6cb}, c, {r6h} from ind_0 where n >= 20),
ticks_dup as (select * exclude (user_id), 0 as ingest_seq from alltrades
  union all select * exclude (user_id) replace (price + 1.0::double as price), 1 from alltrades where sequence_number % 50 = 0
  union all select * exclude (user_id) replace (sip_timestamp + interval 100 microseconds as sip_timestamp), 0 from alltrades where sequence_number % 75 = 0)
"""


def r6(x: str) -> str:
    return f"round(({x})::decimal(38,10), 6)::double"


def r2(x: str) -> str:
    return f"round(({x})::decimal(38,10), 2)::double"


def ctes() -> str:
    def mean(n: int) -> str:
        return r6(f"avg(close) over (partition by ticker order by timestamp rows between {n - 1} preceding and current row)")

    value = r6("close - b")
    return CTES.format(a5=mean(5), a20=mean(20), a9=mean(9), r6cb=value, r6h=r6(f"{value} - c")).strip()

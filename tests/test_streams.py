"""Sinks and streams over several batches: empty ones, restarts, late rows, the market gate."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickframe.operators import dedup as D
from tickframe.operators.normalize import normalize_minmax
from tickframe.plans.master import master, master_range, master_view
from tickframe.sources import feeds as S
from tickframe.sources.sinks import append, export_normalized, read_table, upsert
from tickframe.streaming import streams as ST

FRIDAY = dt.datetime(2024, 1, 5, 15, 0)


def bars(spark, closes, start=FRIDAY, ticker="A", step=dt.timedelta(minutes=1)):
    return spark.createDataFrame([(ticker, start + step * i, c, c, c, c, 1, c, 1) for i, c in enumerate(closes)], S.BARS)


def closes(df):
    return [(r.ticker, r.timestamp, r.close) for r in df.orderBy("ticker", "timestamp").collect()]


def test_upsert(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["ticker", "timestamp"]
    upsert(bars(spark, []), path, keys)
    upsert(bars(spark, [1.0, 2.0]), path, keys)
    upsert(bars(spark, []), path, keys)
    both = bars(spark, [5.0]).withColumn("seq", F.lit(1)).unionByName(bars(spark, [6.0]).withColumn("seq", F.lit(2))).unionByName(bars(spark, [4.0]).withColumn("seq", F.lit(0)))
    upsert(both.drop("seq").limit(0), path, keys)
    other = f"{tmp_path}/u"
    upsert(both, other, keys, order=["seq"])
    assert [x[2] for x in closes(read_table(spark, other))] == [6.0]
    upsert(bars(spark, [7.0], FRIDAY + dt.timedelta(days=3)), path, keys)
    upsert(bars(spark, [9.0]), path, keys)
    assert [x[2] for x in closes(read_table(spark, path))] == [9.0, 2.0, 7.0]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t", "u"]


def test_append_and_export(spark, tmp_path):
    path = f"{tmp_path}/a"
    for x in ([1.0], [], [2.0]):
        append(bars(spark, x), path)
    assert sorted(x[2] for x in closes(read_table(spark, path))) == [1.0, 2.0]
    export_normalized(bars(spark, [3.0, 1.0, 2.0]), f"{tmp_path}/e", ["ticker", "timestamp", "close"])
    assert [x[2] for x in closes(spark.read.parquet(f"{tmp_path}/e"))] == [3.0, 1.0, 2.0]


def test_latest_of_one_time(spark):
    rows = [("A", FRIDAY, "y", 2), ("A", FRIDAY, "x", 3), ("A", FRIDAY, "x", 1), ("A", None, "a", 0), ("B", None, "q", 7)]
    d = spark.createDataFrame(rows, "ticker string, timestamp timestamp_ntz, name string, n int")
    assert sorted((r.ticker, r.name, r.n) for r in D.latest(d, tiebreak=["name"]).collect()) == [("A", "x", 1), ("B", "q", 7)]
    assert {(r.name, r.n) for r in D.latest(d).where("ticker = 'A'").collect()} == {("x", 1)}


def landing(spark, tmp_path, name):
    path = f"{tmp_path}/{name}"
    os.makedirs(path)
    return path, spark.readStream.schema(S.BARS).option("maxFilesPerTrigger", 1).parquet(path)


def test_latest_starts_on_a_weekend(spark, tmp_path):
    path, stream = landing(spark, tmp_path, "in")
    saturday = FRIDAY + dt.timedelta(days=1)
    bars(spark, [1.0, 2.0], saturday).coalesce(1).write.mode("append").parquet(path)

    def run():
        ST.start_latest(stream, f"{tmp_path}/out", f"{tmp_path}/state", available=True).awaitTermination()

    run()
    bars(spark, [3.0, 4.0], saturday + dt.timedelta(days=2)).coalesce(1).write.mode("append").parquet(path)
    run()  # goes on where it was
    bars(spark, [0.5], FRIDAY).coalesce(1).write.mode("append").parquet(path)
    bars(spark, [5.0], saturday + dt.timedelta(days=2, hours=1), "B").coalesce(1).write.mode("append").parquet(path)
    run()
    got = closes(ST.latest_rows(spark, f"{tmp_path}/out"))
    assert [(x[0], x[2]) for x in got] == [("A", 4.0), ("B", 5.0)]


@pytest.mark.parametrize("days", [1, 40])
def test_minmax_in_batches(spark, tmp_path, days):
    xs = [float((i * 29) % 31) for i in range(60)]
    whole = bars(spark, xs, step=dt.timedelta(hours=24 * days // 2 + 1)).unionByName(bars(spark, xs[:7], ticker="B"))
    path, stream = landing(spark, tmp_path, "in")
    for low, high in ((0, 20), (20, 45), (45, 60)):
        first = FRIDAY + dt.timedelta(hours=24 * days // 2 + 1) * low
        last = FRIDAY + dt.timedelta(hours=24 * days // 2 + 1) * high
        whole.where((F.col("timestamp") >= F.lit(first)) & (F.col("timestamp") < F.lit(last))).coalesce(1).write.mode("append").parquet(path)
    ST.start_minmax(stream, f"{tmp_path}/rows", f"{tmp_path}/out", f"{tmp_path}/state", n=10, available=True).awaitTermination()
    assert closes(read_table(spark, f"{tmp_path}/out")) == closes(normalize_minmax(whole, 10))


def test_minmax_makes_no_ticker_one_task(spark, tmp_path):
    """Of rows to be scaled only the n beside a block are numbered by ticker (each task sends n at most), no
    stored row moves to be joined, and blocks move once."""
    whole = bars(spark, [float((i * 29) % 31) for i in range(60)], step=dt.timedelta(hours=9))
    upsert(whole, f"{tmp_path}/rows", ["ticker", "timestamp"])
    near = ST._affected(f"{tmp_path}/rows", whole.where("close = 7 or close = 8"), 5)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortMergeJoin" not in plan.split("Window [")[0]
    scaled = normalize_minmax(near.select(*whole.columns, "_changed"), 5)
    assert "_stretch" not in "".join(x for x in scaled._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x)


def test_minmax_after_late_rows_and_new_tickers(spark, tmp_path):
    """Rows days late change those after them; a new ticker doesn't widen what is read."""
    xs, hour = [float((i * 29) % 31) for i in range(90)], dt.timedelta(hours=9)
    whole = bars(spark, xs, step=hour).collect()
    path, stream = landing(spark, tmp_path, "in")
    late = {3, 20, 21, 40}
    parts = [[i for i in range(45) if i not in late], [i for i in range(45, 90)], sorted(late)]
    for part in parts:
        spark.createDataFrame([whole[i] for i in part], S.BARS).coalesce(1).write.mode("append").parquet(path)
    run = lambda: ST.start_minmax(stream, f"{tmp_path}/rows", f"{tmp_path}/out", f"{tmp_path}/state", n=10, available=True).awaitTermination()
    run()
    new = bars(spark, [5.0, 6.0], FRIDAY + hour * 89, "NEW")
    new.coalesce(1).write.mode("append").parquet(path)
    run()
    want = normalize_minmax(spark.createDataFrame(whole, S.BARS).unionByName(new), 10)
    assert closes(read_table(spark, f"{tmp_path}/out")) == closes(want)
    near = ST._affected(f"{tmp_path}/rows", new.unionByName(spark.createDataFrame(whole[89:], S.BARS)), 10)
    assert near.where("ticker = 'A'").count() == 11 and near.where("ticker = 'NEW'").count() == 2
    assert min(r.timestamp for r in near.collect()) == whole[79].timestamp
    plan = ST._affected(f"{tmp_path}/rows", new, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and str((FRIDAY + hour * 89).date() - dt.timedelta(days=1)) in plan  # a day before, no more


def test_master_in_batches_and_late_rows(spark, tmp_path):
    quotes, trades, indicators = (spark.createDataFrame([], s) for s in (S.QUOTES, S.TRADES, S.INDICATORS))
    path, stream = landing(spark, tmp_path, "in")
    bars(spark, [1.0, 2.0]).coalesce(1).write.mode("append").parquet(path)
    bars(spark, [3.0], FRIDAY + dt.timedelta(days=3)).coalesce(1).write.mode("append").parquet(path)

    def run():
        ST.start_master(stream, lambda: (quotes, trades, indicators), f"{tmp_path}/out", f"{tmp_path}/state", available=True).awaitTermination()

    run()
    bars(spark, [9.0], FRIDAY).coalesce(1).write.mode("append").parquet(path)  # a late correction
    run()
    want = bars(spark, [9.0, 2.0]).unionByName(bars(spark, [3.0], FRIDAY + dt.timedelta(days=3)))
    assert closes(read_table(spark, f"{tmp_path}/out")) == closes(master_view(want, quotes, trades, indicators))


def test_master_range_reaches_back_over_a_gap(spark):
    quotes, trades, indicators = (spark.createDataFrame([], s) for s in (S.QUOTES, S.TRADES, S.INDICATORS))
    all_bars = bars(spark, [10.0, 11.0]).unionByName(bars(spark, [12.0, 13.0], FRIDAY + dt.timedelta(days=60)))
    day = str((FRIDAY + dt.timedelta(days=60)).date())
    got = master_range(all_bars, quotes, trades, indicators, day, day).orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in master(all_bars, quotes, trades, indicators).where(f"timestamp >= '{day}'").orderBy("timestamp").collect()]
    assert [r.previous_close for r in got] == [11.0, 11.0]


def test_extremes_against_plain():
    import numpy as np

    from tickframe.streaming.rolling import extremes

    rng = np.random.default_rng(0)
    for rows, n in ((1, 0), (1, 5), (7, 0), (7, 3), (30, 4), (101, 100), (250, 100)):
        v = rng.integers(0, 9, (rows, 3)).astype(float)
        v[rng.random((rows, 3)) < 0.2] = np.nan
        low, high = extremes(v, n)
        for i in range(rows):
            for c in range(3):
                frame = v[max(0, i - n) : i + 1, c]
                frame = frame[~np.isnan(frame)]
                want = (frame.min(), frame.max()) if len(frame) else (None, None)
                assert want == (None if np.isnan(low[i, c]) else low[i, c], None if np.isnan(high[i, c]) else high[i, c])


def minmax_state(stream, tmp_path, **more):
    ST.start_minmax_state(stream, f"{tmp_path}/out", f"{tmp_path}/state", available=True, **more).awaitTermination()


def test_minmax_state_takes_late_rows_and_restarts(spark, tmp_path):
    """Rows come shuffled over batches, a correction and a new ticker among them; the query restarts
    between batches; stored rows aren't there to be read."""
    import random

    xs = [float((i * 29) % 31) for i in range(60)]
    minute = dt.timedelta(minutes=1)
    whole = [("A", FRIDAY + minute * i, x, x, x, x, int(x), None, i % 3) for i, x in enumerate(xs)] + [("B", FRIDAY + minute * i, 2.0, 3.0, 1.0, x, 4, x, None) for i, x in enumerate(xs[:25])]
    order = sorted(range(len(whole)), key=lambda i: (whole[i][1] - FRIDAY).seconds // 60 + random.Random(i).uniform(0, 14))  # up to 14 minutes late
    path, stream = landing(spark, tmp_path, "in")
    stream = ST.as_stream_time(stream, "timestamp")
    for k in range(0, len(order), 17):
        part = [whole[i] for i in order[k : k + 17]]
        if k:
            part.append((*part[0][:2], 30.0, *part[0][3:]))  # its row is replaced in a batch
            whole[order[k]] = part.pop(0)[:2] + (30.0,) + whole[order[k]][3:]
        spark.createDataFrame(part, S.BARS).coalesce(1).write.mode("append").parquet(path)
        minmax_state(stream, tmp_path, n=10)
    fixed = ("A", FRIDAY + minute * 50, 0.5, 40.0, 0.5, 0.5, 1, 7.0, 1)
    spark.createDataFrame([fixed], S.BARS).coalesce(1).write.mode("append").parquet(path)
    minmax_state(stream, tmp_path, n=10)
    want = normalize_minmax(spark.createDataFrame([r for r in whole if r[:2] != fixed[:2]] + [fixed], S.BARS), 10)
    got = read_table(spark, f"{tmp_path}/out").select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_minmax_state_keeps_what_is_too_late_apart(spark, tmp_path):
    path, stream = landing(spark, tmp_path, "in")
    stream = ST.as_stream_time(stream, "timestamp")
    early = FRIDAY - dt.timedelta(minutes=30)
    for part in (bars(spark, [1.0, 4.0, 2.0]), bars(spark, [9.0], early), bars(spark, [3.0], FRIDAY + dt.timedelta(minutes=3))):
        part.coalesce(1).write.mode("append").parquet(path)
        minmax_state(stream, tmp_path, n=2, late=f"{tmp_path}/late")
    assert [x[1:] for x in closes(read_table(spark, f"{tmp_path}/late"))] == [(early, 9.0)]
    assert closes(read_table(spark, f"{tmp_path}/out")) == closes(normalize_minmax(bars(spark, [1.0, 4.0, 2.0, 3.0]), 2))


def test_minmax_state_expires(spark, tmp_path):
    import time

    path, stream = landing(spark, tmp_path, "in")
    stream = ST.as_stream_time(stream, "timestamp")
    run = lambda **more: ST.start_minmax_state(stream, f"{tmp_path}/out", f"{tmp_path}/state", n=5, ttl=dt.timedelta(seconds=1), **more)
    with pytest.raises(ValueError):
        run(available=True)
    for k, part in enumerate((bars(spark, [1.0, 4.0]), bars(spark, [2.0], FRIDAY + dt.timedelta(minutes=2)))):
        part.coalesce(1).write.mode("append").parquet(path)
        query, until = run(interval="1 second"), time.time() + 60
        try:
            while time.time() < until and sum(p.numInputRows for p in query.recentProgress) < 2 - k:
                time.sleep(0.5)
        finally:
            query.stop()
        time.sleep(2)
    assert [x[2] for x in closes(read_table(spark, f"{tmp_path}/out"))] == [None, 5.0, None]


def scans(df):
    """The partition filters of each file scan that has some."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]+)\]", plan)


def test_scans_are_pruned_to_days(spark, tmp_path):
    from tickframe.plans.master import stored_range
    from tickframe.sources.sinks import days_of, last_before

    day = dt.timedelta(days=1)
    quotes = spark.createDataFrame([("A", FRIDAY + day * i, 1, 2.0, 3.0, 1, 2.0, 3.0, [i], [], None, i, 1, None) for i in range(10)], S.QUOTES)
    trades = spark.createDataFrame([("A", FRIDAY + day * i, None, None, i, 2.0, 3, [i], 1, 1) for i in range(10)], S.TRADES)
    indicators = spark.createDataFrame([("A", FRIDAY + day * i, "SMA_5", 5, float(i), None, None) for i in range(10)], S.INDICATORS)
    all_bars = bars(spark, [float(i) for i in range(10)], step=day).unionByName(bars(spark, [5.0], FRIDAY, "OLD")).unionByName(bars(spark, [6.0, 7.0], FRIDAY + day * 8, "OLD")).unionByName(bars(spark, [8.0], FRIDAY + day * 8, "NEW"))
    feeds = {"bars": (all_bars, "timestamp"), "quotes": (quotes, "sip_timestamp"), "trades": (trades, "sip_timestamp"), "indicators": (indicators, "timestamp")}
    for name, (df, ts) in feeds.items():
        append(df, f"{tmp_path}/{name}", ts)
    assert len(days_of(spark, f"{tmp_path}/bars")) == 10
    want = str((FRIDAY + day * 8).date())

    part = S.scan_range(spark.read.parquet(f"{tmp_path}/bars"), "timestamp", FRIDAY, FRIDAY + day, "left")
    assert len(scans(part)) == 1 and "date" in scans(part)[0] and part.count() == 2
    got = stored_range(spark, str(tmp_path), want, want)
    assert [f for f in scans(got) if want not in f and "2024-01" not in f] == [] and len(scans(got)) >= 4
    whole = master(all_bars, *(feeds[n][0] for n in ("quotes", "trades", "indicators"))).where(f"to_date(timestamp) = '{want}'")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert {r.ticker: r.previous_close for r in got.collect()} == {"A": 7.0, "OLD": 5.0, "NEW": None}
    tickers = spark.createDataFrame([("A",), ("NEW",)], "ticker string")
    back = last_before(f"{tmp_path}/bars", tickers, want)  # NEW isn't waited for: one day is read
    assert [(r.ticker, r.close) for r in back.collect()] == [("A", 7.0)]
    assert all("2024-01-12" in f for f in scans(back) if "date" in f and "<=" in f)

    days = [FRIDAY.date(), (FRIDAY + day).date(), (FRIDAY + day * 4).date()]
    some = S.on_days(spark.read.parquet(f"{tmp_path}/quotes"), "sip_timestamp", days)
    assert some.count() == 3 and "date" in scans(some)[0]
    assert S.on_days(quotes, "sip_timestamp", days).count() == 3 and S.on_days(quotes, "sip_timestamp", []).count() == 0


def test_view_of_four_streams_is_one_state(spark, tmp_path):
    """Bars with and without quotes and trades, one without a ticker; the minutes of all streams are one store a partition."""
    at, end = FRIDAY, FRIDAY + dt.timedelta(minutes=9)
    quote = lambda t, s, n, codes: (t, s, 1, 2.0, 3.0, 4, 1.0, 5.0, codes, [], s, n, 1, None)
    trade = lambda t, s, n, codes: (t, s, s, None, n, 9.0, 7, codes, 3, 1)
    own = [("A", at), ("A", at + dt.timedelta(minutes=1)), (None, at), ("B", at), ("Z", end)]
    frames = {
        "timestamp0": spark.createDataFrame([(t, s, 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1) for t, s in own], S.BARS),
        "sip_timestamp1": spark.createDataFrame([quote("A", at, 2, [5]), quote("A", at, 1, [4]), quote(None, at, 3, [1]), quote("B", at, 4, None), quote("Z", end, 5, [])], S.QUOTES),
        "sip_timestamp2": spark.createDataFrame([trade("A", at, 1, [8, 9]), trade(None, at, 2, [1]), trade("Z", end, 3, [])], S.TRADES),
        "timestamp3": spark.createDataFrame([(t, s, "SMA_5", 5, 6.0, None, None) for t, s in (("A", at), (None, at), ("Z", end))], S.INDICATORS),
    }
    feeds = []
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        feeds.append(ST.as_stream_time(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}"), name[:-1]))
    q = ST.stream_view(*feeds).writeStream.format("memory").queryName("one_view").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {len(p["stateOperators"]) for p in q.recentProgress} == {1}
    got = spark.table("one_view").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    expected = master_view(*frames.values()).where(F.col("timestamp") < F.lit(end))
    assert got.columns == expected.columns
    key = lambda r: (str(r.ticker), r.timestamp)
    assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key) and got.count() == 4


def test_feed_in_batches_of_several_files(spark, tmp_path, monkeypatch):
    """A part of many rows has several files, a small or empty one as many; a batch is a part."""
    from tickframe.plans import queries as Q

    monkeypatch.setattr(Q, "_FILE_ROWS", 40)
    made, new = [], Q.Data.new
    monkeypatch.setattr(Q.Data, "new", lambda d, tag: made.append(new(d, tag)) or made[-1])
    d, days = Q.Data(spark, str(tmp_path)), [1] * 3 + [9] * 150 + [23] * 2
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, day)) for i, day in enumerate(days)], "i int, timestamp timestamp_ntz")
    stream, seen = Q._shuffled(d, df, Q._CUTS), []
    ST._each(stream, lambda rows, _: seen.append((rows.count(), sorted({r.timestamp.day for r in rows.collect()}))), f"{tmp_path}/c", True, "").awaitTermination()
    assert seen == [(3, [1]), (150, [9]), (0, []), (2, [23]), (0, [])]
    feed = next(p for p in made if "feed-" in p).removeprefix("file://")
    assert len([n for n in os.listdir(feed) if n.endswith(".parquet")]) == 20

"""How rows are laid out and read: frames over all days, co-located tables, folds as trees, records that don't fit."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from tickframe.operators import features as W
from tickframe.operators import quality as Q
from tickframe.operators import sequence
from tickframe.plans import master as M
from tickframe.sources import feeds as S

START = dt.datetime(2024, 1, 5, 15, 0)


def bars(spark, closes, ticker="A", step=dt.timedelta(hours=5)):
    return spark.createDataFrame([(ticker, START + step * i, c, c + 1, c - 1, c, 1, c, 1) for i, c in enumerate(closes)], S.BARS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [15, 16, 40, 4096])
def test_frames_over_all_days(spark, block):
    xs = [float((i * 37) % 53) for i in range(70)]
    df = bars(spark, xs).unionByName(bars(spark, xs[:9], "B"))
    ahead = W.max_price_diff(W.future_close(df, 15, "none", block), 15, "none", block).orderBy("ticker", "timestamp").collect()
    for name, own in (("A", xs), ("B", xs[:9])):
        rows = [r for r in ahead if r.ticker == name]
        assert [r.future_close for r in rows] == [own[i + 15] if i + 15 < len(own) else None for i in range(len(own))]
        for i, r in enumerate(rows):
            near = own[i + 1 : i + 16]
            if not near or not own[i]:
                assert r.max_price_diff is None
                continue
            up, down = (max(near) - own[i]) / own[i] * 100, (min(near) - own[i]) / own[i] * 100
            assert abs(r.max_price_diff - (up if abs(up) > abs(down) else down)) < 0.0051
    mean = W.atr(df.withColumn("tr_value", F.col("close")), 14, "none", block).orderBy("ticker", "timestamp").collect()
    assert [round(r.atr_value, 9) for r in mean if r.ticker == "A"] == [round(sum(xs[max(0, i - 13) : i + 1]) / min(14, i + 1), 9) for i in range(70)]
    assert mean[0].asDict().keys() == {*df.columns, "tr_value", "atr_value"}


def test_no_frame_is_a_whole_ticker(spark):
    """Of the windows by ticker alone there is one, over counts of days."""
    df = W.atr(W.future_close(bars(spark, [1.0, 2.0]), session="none").withColumn("tr_value", F.col("close")), session="none")
    alone = re.findall(r"Window \[(.*)\], \[ticker#\d+\], ", plan(df))
    assert alone and all("_c#" in w for w in alone)


def test_a_day_has_one_exchange(spark):
    text = plan(M.bar_features(bars(spark, [1.0, 2.0])))
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, date#\d+", text)) <= 2  # the windows', and that of the days' last closes


def test_colocated_master_needs_half_the_exchanges(spark, tmp_path):
    df = bars(spark, [float(i) for i in range(30)])
    quotes = df.select("ticker", F.col("timestamp").alias("sip_timestamp"), *[F.lit(v).cast(k).alias(n) for n, k, v in (
        ("ask_exchange", "int", 1), ("ask_price", "double", 2), ("ask_size", "double", 3), ("bid_exchange", "int", 1), ("bid_price", "double", 2), ("bid_size", "double", 3))],
        F.array(F.lit(1)).alias("conditions"), F.array(F.lit(1)).alias("indicators"), F.lit(None).cast("timestamp_ntz").alias("participant_timestamp"), F.lit(1).cast("long").alias("sequence_number"),
        F.lit(1).alias("tape"), F.lit(None).cast("timestamp_ntz").alias("trf_timestamp"))
    trades = spark.createDataFrame([("A", START, None, None, 1, 2.0, 3, [1], 1, 1)], S.TRADES)
    indicators = spark.createDataFrame([("A", START, "SMA_5", 5, 2.5, None, None)], S.INDICATORS)
    feeds = {"bars": df, "quotes": quotes, "trades": trades, "indicators": indicators}
    names, plain = {k: f"laid_{k}_{tmp_path.name.replace('-', '_')}" for k in feeds}, []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for k, x in feeds.items():
            M.colocate(names[k], k, x, 4)
            x.write.parquet(f"{tmp_path}/{k}")
            plain.append(spark.read.parquet(f"{tmp_path}/{k}"))
        held = [spark.table(names[k]) for k in feeds]
        with M.laid_out(spark):
            few, many = (len(re.findall(r"Exchange hashpartitioning", plan(M.master(*x)))) for x in (held, plain))
        assert 2 * few < many
        M.master_colocated(spark, names, f"{tmp_path}/out")
        assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=repr) == sorted(map(tuple, M.master(*plain).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for n in names.values():
            spark.sql(f"drop table if exists {n}")
    assert spark.conf.get(M._KEYS) == "true"


@pytest.mark.parametrize("stretch,size", [(2, 1), (2, 7), (3, 2)])
def test_folds_are_trees(spark, monkeypatch, stretch, size):
    """Many levels of stretches: the same as row by row."""
    monkeypatch.setattr(sequence, "STRETCH", stretch)
    xs = [float((i * 29) % 31) for i in range(60)]
    got = [r.e for r in sequence.block_scan(bars(spark, xs), [("e", "close", 0.2)], size).orderBy("timestamp").collect()]
    y, want = xs[0], []
    for x in xs:
        y = 0.8 * y + 0.2 * x
        want.append(y)
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))


def test_consistency_makes_the_master_once(spark):
    empty = (spark.createDataFrame([], s) for s in (S.QUOTES, S.TRADES, S.INDICATORS))
    quotes, trades, indicators = empty
    held = M.master(bars(spark, [1.0, 2.0]), quotes, trades, indicators, unmatched="null").withColumn("once", F.rand())
    out = Q.consistency(held.where("once >= 0"), bars(spark, [1.0, 2.0]), quotes, trades, indicators)
    assert plan(out).count("rand(") == 1
    assert {r.check_name: (r.source_count, r.master_count, r.difference) for r in out.collect()} == {"bars": (2, 2, 0), "quotes": (0, 0, 0), "trades": (0, 0, 0), "indicators": (0, 0, 0)}


def test_records_that_do_not_fit(spark, tmp_path):
    ok = {"ticker": "A", "timestamp": 1704466800000, "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0, "volume": 5.0, "vwap": 1.0, "transactions": 2}
    lines = [json.dumps(x) for x in (ok, ok | {"volume": 1e30}, ok | {"timestamp": 2**62}, ok | {"timestamp": -(2**63)}, ok | {"volume": None, "vwap": None}, ok | {"open": "much"}, ok | {"volume": 1e30, "timestamp": 2**62})]
    (tmp_path / "bars").mkdir()
    (tmp_path / "bars" / "x.json").write_text("\n".join([*lines, '{"ticker": "A", "timesta', ""]))
    good = S.read_bars(spark, f"{tmp_path}/bars").collect()
    assert [(r.volume, r.timestamp) for r in good] == [(5, dt.datetime(2024, 1, 5, 15, 0)), (None, dt.datetime(2024, 1, 5, 15, 0))]
    bad = S.quarantined(spark, f"{tmp_path}/bars", "bars").collect()
    assert sorted(r.reason for r in bad) == ["timestamp", "timestamp", "timestamp, volume", "unreadable", "unreadable", "volume"]
    assert {r.feed for r in bad} == {"bars"} and sum("much" in r.record for r in bad) == 1 and sum("1.0E30" in r.record for r in bad) == 2
    (tmp_path / "trades").mkdir()
    (tmp_path / "trades" / "x.json").write_text(json.dumps({"ticker": "A", "sip_timestamp": 1704466800000000001, "size": 3e9, "price": 1.0}) + "\n" + json.dumps({"ticker": "A", "sip_timestamp": 1704466800000000001, "size": 3, "price": 1.0}))
    assert [(r.size, r.sip_nanos, r.conditions) for r in S.read_trades(spark, f"{tmp_path}/trades").collect()] == [(3, 1704466800000000001, [])]
    assert [r.reason for r in S.quarantined(spark, f"{tmp_path}/trades", "trades").collect()] == ["size"]

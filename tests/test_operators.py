"""Hand-made rows for the edges of the time-series operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.functions import scalar as P
from tickframe.operators import dedup as D
from tickframe.operators import features as W
from tickframe.operators import indicators as I
from tickframe.operators import quality as Q
from tickframe.operators import sequence
from tickframe.operators.normalize import normalize_minmax
from tickframe.operators.sequence import block_scan, row_index, with_halo
from tickframe.plans.master import MASTER, master
from tickframe.sources import feeds as S

T0 = dt.datetime(2024, 1, 5, 14, 30)
BARS = S.BARS


def bars(spark, closes, start=T0, ticker="A", step=dt.timedelta(minutes=1)):
    rows = [(ticker, start + step * i, c, c, c, c, 1, c, 1) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, BARS)


def values(df, column):
    return [r[column] for r in df.orderBy("ticker", "timestamp").collect()]


def test_label_needs_fifteen_rows_ahead(spark):
    d = W.labels(W.future_close(bars(spark, [100.0] * 15 + [101.0])))
    assert values(d, "price_diff") == [pytest.approx(1.0)] + [None] * 15
    assert values(d, "target") == [4] + [5] * 15
    assert values(W.labels(W.future_close(bars(spark, [100.0])), None), "target") == [None]


def test_classes_are_inclusive_below(spark):
    cuts = [-1.5, -1.0, -0.5, 0.0, 0.5, 1.0, 1.5, None]
    d = spark.createDataFrame([(i, c) for i, c in enumerate(cuts)], "i int, pct double").select("i", P.classify(F.col("pct")).alias("c"))
    assert [r.c for r in d.orderBy("i").collect()] == [0, 0, 1, 2, 3, 4, 5, 5]


def test_equal_rise_and_fall_gives_the_fall(spark):
    assert values(W.max_price_diff(bars(spark, [100.0, 101.0, 99.0])), "max_price_diff") == [-1.0, -1.98, None]


def test_zero_close_gives_null(spark):
    assert values(W.max_price_diff(bars(spark, [0.0, 1.0])), "max_price_diff") == [None, None]


def test_previous_close_passes_the_weekend(spark):
    both = bars(spark, [10.0, 11.0]).unionByName(bars(spark, [12.0], T0 + dt.timedelta(days=3)))
    assert values(W.previous_close(both), "previous_close") == [None, None, 11.0]
    assert values(W.previous_close(both, "prev_row"), "previous_close") == [None, 10.0, None]


def test_first_true_range_is_high_less_low(spark):
    d = W.true_ranges(W.previous_close(W.daily_range(bars(spark, [10.0, 12.0]))))
    assert values(d, "tr_value") == [2.0, 2.0] and values(d, "tr_high_close") == [None, None]


@pytest.mark.parametrize(
    ("at", "is_open"),
    [
        ("2024-01-05 14:30:00", True), ("2024-01-05 14:29:59", False), ("2024-01-05 21:00:00", True), ("2024-01-05 21:00:01", False), ("2024-01-06 15:00:00", False),
        ("2024-03-11 13:30:00", True), ("2024-03-08 13:30:00", False), ("2024-03-08 14:30:00", True), (None, None),
    ],
)
def test_market_hours(spark, at, is_open):
    assert spark.range(1).select(P.market_hours(F.lit(at).cast("timestamp_ntz")).alias("o")).first().o is is_open


def test_round2_takes_the_decimal(spark):
    assert spark.range(1).select(P.round2(F.lit(1.005)).alias("x"), P.round2(F.lit(-1.005)).alias("y")).first()[:] == (1.01, -1.01)


def test_times(spark):
    row = spark.range(1).select(
        P.epoch_ns(F.lit(1704464999123456789)).alias("ns"), P.epoch_ns(F.lit(None).cast("long")).alias("none"), P.parse_utc(F.lit("2024-01-05T14:30:00Z")).alias("z"),
        P.parse_utc(F.lit("junk"), F.lit("2000-01-01").cast("timestamp_ntz")).alias("junk"), P.parse_utc(F.lit("junk")).alias("now"),
    ).first()
    assert row.ns == dt.datetime(2024, 1, 5, 14, 29, 59, 123456) and row.none is None and row.z == T0 and row.junk.year == 2000 and row.now is not None


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_block_scan_is_the_recursion(spark, size):
    xs = [float((i * 37) % 23) for i in range(150)]
    d = block_scan(bars(spark, xs, step=dt.timedelta(minutes=30)), [("e", "close", 0.2), ("f", "close", 1 / 14)], size)
    for name, a in (("e", 0.2), ("f", 1 / 14)):
        y, want = None, []
        for x in xs:
            y = x if y is None else (1 - a) * y + a * x
            want.append(y)
        assert values(d, name) == pytest.approx(want, rel=1e-9)


def test_block_scan_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(sequence, "STRETCH", 3)
    xs = [float((i * 37) % 23) for i in range(100)]
    y, want = None, []
    for x in xs:
        y = x if y is None else 0.8 * y + 0.2 * x
        want.append(y)
    d = block_scan(bars(spark, xs, step=dt.timedelta(minutes=30)), [("e", "close", 0.2)], 4)
    assert values(d, "e") == pytest.approx(want, rel=1e-9) and values(d, "rn") == list(range(100))


@pytest.mark.parametrize(("block", "step"), [(None, 1), (7, 1), (1, 45), (None, 2000), (3, 700)])
def test_indicators_are_the_recursions(spark, block, step):
    xs = [100 + float((i * 37) % 23) - float((i * 11) % 7) for i in range(70)]
    rows = I.recursions(bars(spark, xs, step=dt.timedelta(minutes=step)), block=block).orderBy("timestamp").collect()
    e = {n: xs[0] for n in (9, 12, 20, 26)}
    sig, up, down = 0.0, None, None
    for i, (r, x) in enumerate(zip(rows, xs, strict=True)):
        if i:
            e = {n: e[n] + (x - e[n]) * 2 / (n + 1) for n in e}
            sig += (e[12] - e[26] - sig) * 0.2
            g, lo = max(x - xs[i - 1], 0), max(xs[i - 1] - x, 0)
            up, down = (g, lo) if i == 1 else (up + (g - up) / 14, down + (lo - down) / 14)
        assert r.rn == i
        assert r.ema_20 == (pytest.approx(e[20], rel=1e-9) if i >= 19 else None) and r.ema_9 == (pytest.approx(e[9], rel=1e-9) if i >= 8 else None)
        assert r.macd_signal == (pytest.approx(sig, rel=1e-7, abs=1e-9) if i >= 33 else None)
        assert r.rsi_14 == (pytest.approx(100 - 100 / (1 + up / down), rel=1e-9) if i >= 14 else None)


def test_row_index_ignores_the_order_of_input(spark):
    b = bars(spark, [float(i) for i in range(60)], step=dt.timedelta(hours=1))
    assert values(row_index(b.orderBy(F.rand(1))), "rn") == list(range(60))


def test_halo_frames_are_whole(spark):
    xs = [float((i * 7) % 11) for i in range(90)]
    d, over = with_halo(row_index(bars(spark, xs)), 5, 8)
    d = d.withColumn("m", F.max("close").over(over.rowsBetween(-5, 0))).where("not _halo")
    assert values(d, "m") == [max(xs[max(0, i - 5) : i + 1]) for i in range(90)]


def test_indicators_start_when_warm(spark):
    n = {r.indicator_type: r["count"] for r in I.indicators_long(bars(spark, [float(i % 9 + 1) for i in range(60)])).groupBy("indicator_type").count().collect()}
    assert n == {"SMA_5": 56, "SMA_9": 52, "SMA_12": 49, "SMA_20": 41, "SMA_50": 11, "EMA_9": 52, "EMA_12": 49, "EMA_20": 41, "MACD": 27, "RSI": 46}


def test_rsi_without_losses(spark):
    assert set(values(I.rsi(bars(spark, [float(i) for i in range(20)])), "value")) == {100.0}


def test_minmax_guards(spark):
    flat, one = bars(spark, [3.0, 3.0]), bars(spark, [3.0, 4.0])
    assert values(normalize_minmax(flat), "close") == [None, None]
    assert values(normalize_minmax(one), "close") == [None, 5.0]
    assert values(normalize_minmax(one, guard=1), "close") == [None, None]


def test_minmax_frame(spark):
    xs = [float((i * 29) % 31) for i in range(120)]
    want = [(lambda f: None if max(f) == min(f) else round(5 * (xs[i] - min(f)) / (max(f) - min(f)) + 1e-9, 2))(xs[max(0, i - 10) : i + 1]) for i in range(120)]
    assert values(normalize_minmax(bars(spark, xs), 10), "close") == pytest.approx(want, abs=0.0101, nan_ok=True)


def test_dedup_is_idempotent(spark):
    rows = [("A", T0, 1, 0), ("A", T0, 2, 1), ("B", T0, 3, 0)]
    d = spark.createDataFrame(rows, "ticker string, sip_timestamp timestamp_ntz, price int, ingest_seq int")
    once = D.dedup_last(d, ["ticker", "sip_timestamp"], ["ingest_seq"])
    assert sorted(r.price for r in once.collect()) == [2, 3]
    assert sorted(r.price for r in D.dedup_last(once, ["ticker", "sip_timestamp"], ["ingest_seq"]).collect()) == [2, 3]


def test_dedup_ms_by_time_alone(spark):
    rows = [("A", T0, 1), ("B", T0 + dt.timedelta(microseconds=400), 2), ("A", T0 + dt.timedelta(microseconds=500), 3)]
    d = spark.createDataFrame(rows, "ticker string, sip_timestamp timestamp_ntz, sequence_number int")
    assert sorted(r.sequence_number for r in D.dedup_ms(d).collect()) == [1, 2]
    assert [r.sequence_number for r in D.dedup_ms(d, by=()).collect()] == [1]


def test_resolve_cols(spark):
    assert D.resolve_cols(bars(spark, [1.0]).schema) == ("ticker", "timestamp")
    assert D.resolve_cols(spark.createDataFrame([], S.NEWS).schema) == ("tickers", "published_utc")


def test_empty_tables(spark):
    b, q, t, i = (spark.createDataFrame([], s) for s in (S.BARS, S.QUOTES, S.TRADES, S.INDICATORS))
    assert master(b, q, t, i).columns == list(MASTER) and master(b, q, t, i).count() == 0
    assert I.indicators_long(b).count() == 0 and Q.dup_by_ts(b).first()[:] == (0, 0, 0, 0.0)


def test_no_python_in_batch_plans(spark):
    b, q, t, i = (spark.createDataFrame([], s) for s in (S.BARS, S.QUOTES, S.TRADES, S.INDICATORS))
    plan = master(b, q, t, i)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan


def test_subscribe(spark):
    t = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert S.subscribe(t, ["T.A", "Q.B"]).count() == 1 and S.subscribe(t, ["T.*"]).count() == 2 and S.subscribe(t, ["Q.A"]).count() == 0

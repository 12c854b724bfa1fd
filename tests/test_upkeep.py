"""Stored tables: removal of duplicates with crashes at each step, profiles kept while writing, two writers, latest rows by state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.operators import quality as Q
from tickframe.sources import feeds as S
from tickframe.sources import sinks, upkeep
from tickframe.streaming import streams as ST

FRIDAY = dt.datetime(2024, 1, 5, 15, 0)
KEYS = ["ticker", "timestamp"]


def bars(spark, closes, start=FRIDAY, ticker="A", step=dt.timedelta(minutes=1)):
    return spark.createDataFrame([(ticker, start + step * i, c, c, c, c, 1, c, 1) for i, c in enumerate(closes)], S.BARS)


def stored(spark, path):
    return sorted((r.ticker, str(r.timestamp), r.close) for r in spark.read.parquet(path).collect())


def doubled(spark, path):
    rows = bars(spark, [1.0, 2.0, 3.0], step=dt.timedelta(days=1))
    sinks.append(rows.withColumn("seq", F.lit(0)), path)
    sinks.append(rows.where("close > 1").withColumn("close", -F.col("close")).withColumn("seq", F.lit(1)), path)
    sinks.append(spark.createDataFrame([(None, None, 5.0, 5.0, 5.0, 5.0, 1, 5.0, 1)] * 2, S.BARS).withColumn("seq", F.lit(2)), path)


WANT = [("A", "2024-01-05 15:00:00", 1.0), ("A", "2024-01-06 15:00:00", -2.0), ("A", "2024-01-07 15:00:00", -3.0), (None, "None", 5.0)]


def test_dedup_of_a_stored_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    doubled(spark, path)
    assert tuple(upkeep.stored_duplicates(spark, path, KEYS).first()) == (7, 4, 3)
    assert len(stored_rows := spark.read.parquet(path).collect()) == 7 and len(stored_rows[0]) == 11
    assert upkeep.dedup_stored(spark, path, KEYS, ["seq"]) == 3
    got = sorted(((r.ticker, str(r.timestamp), r.close) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted(WANT, key=str)
    assert upkeep.dedup_stored(spark, path, KEYS, ["seq"]) == 0
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and sinks.days_of(spark, path)[0] == FRIDAY.date()


@pytest.mark.parametrize("step", range(6))
def test_dedup_dies_at_each_step(spark, tmp_path, monkeypatch, step):
    """Before its mark, before and between the renames, before each removal: no row is lost at any."""
    path = f"{tmp_path}/t"
    doubled(spark, path)
    calls = iter(range(100))
    dead = lambda f: lambda *a: (_ for _ in ()).throw(KeyboardInterrupt) if next(calls) == step else f(*a)
    with monkeypatch.context() as m:
        m.setattr(upkeep, "recover", lambda *a: None)
        for name in ("create", "rename", "remove"):
            m.setattr(sinks, name, dead(getattr(sinks, name)))
        if step < 5:
            with pytest.raises(KeyboardInterrupt):
                upkeep.dedup_stored(spark, path, KEYS, ["seq"])
        else:
            upkeep.dedup_stored(spark, path, KEYS, ["seq"])
    upkeep.recover(spark, path)
    assert spark.read.parquet(path).count() == (7 if step < 2 else 4)
    upkeep.dedup_stored(spark, path, KEYS, ["seq"])
    assert sorted(((r.ticker, str(r.timestamp), r.close) for r in spark.read.parquet(path).collect()), key=str) == sorted(WANT, key=str)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_dedup_beside_an_append(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    doubled(spark, path)
    whole = upkeep.dedup_last

    def slow(*a):
        sinks.append(bars(spark, [9.0], ticker="B").withColumn("seq", F.lit(0)), path)
        return whole(*a)

    with monkeypatch.context() as m:
        m.setattr(upkeep, "dedup_last", slow)
        with pytest.raises(upkeep.TableChanged):
            upkeep.dedup_stored(spark, path, KEYS, ["seq"])
    assert spark.read.parquet(path).count() == 8 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_profiles_follow_writes(spark, tmp_path):
    """Appends, an empty frame, replaced rows with other nulls and zeros: the kept profile is the scan's."""
    path = f"{tmp_path}/t"
    assert upkeep.profile_stats(spark, path).first()[0] == 0
    zeros = bars(spark, [0.0, 2.0, 0.0], ticker="B").withColumn("vwap", F.lit(None).cast("double"))
    upkeep.append_profiled(bars(spark, [1.0, 0.0, 3.0], step=dt.timedelta(days=1)), path)
    upkeep.append_profiled(bars(spark, []), path)
    upkeep.append_profiled(zeros, path)
    upkeep.upsert_profiled(zeros.withColumn("close", F.lit(0.0)).withColumn("vwap", F.lit(0.0)).unionByName(bars(spark, [4.0], FRIDAY + dt.timedelta(days=30), "C")), path, KEYS)
    upkeep.upsert_profiled(bars(spark, []), path, KEYS)
    table = sinks.read_table(spark, path)

    def same():
        assert upkeep.profile_stats(spark, path).collect() == Q.table_stats(table).collect()
        assert sorted(map(tuple, upkeep.profile_quality(spark, path).collect())) == sorted(map(tuple, Q.quality(table).collect()))

    same()
    with pytest.raises(ValueError):
        upkeep.upsert_profiled(zeros, path, ["ticker"])
    sinks.create(spark, f"{path}_profile/_open-x")
    with pytest.raises(RuntimeError, match="under way"):
        upkeep.profile_stats(spark, path)
    upkeep.reprofile(spark, path)
    same()


def test_two_writers_of_a_day(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.upsert(bars(spark, [1.0]), path, KEYS)
    held = sinks._claim(spark, path, [FRIDAY.date()], "other", 0)
    with pytest.raises(sinks.DaysTaken):
        sinks.upsert(bars(spark, [2.0]), path, KEYS)
    sinks.upsert(bars(spark, [3.0], FRIDAY + dt.timedelta(days=1)), path, KEYS)  # another day is free
    with pytest.raises(sinks.DaysTaken):  # all days or none
        sinks.upsert(bars(spark, [4.0, 5.0], step=dt.timedelta(days=-1)), path, KEYS)
    assert [x[2] for x in stored(spark, path)] == [1.0, 3.0]
    for name in held:
        sinks.remove(spark, name)
    sinks.upsert(bars(spark, [4.0, 5.0], step=dt.timedelta(days=-1)), path, KEYS, wait=5)
    assert [x[2] for x in stored(spark, path)] == [5.0, 4.0, 3.0] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_writer_dies(spark, tmp_path, monkeypatch):
    """Before its days are staged nothing of it stays; after that `settle` puts them in place."""
    path = f"{tmp_path}/t"
    sinks.upsert(bars(spark, [1.0]), path, KEYS)

    def dies(*a):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(sinks, "create", dies)
        sinks.upsert(bars(spark, [2.0]), path, KEYS)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(sinks, "_place", dies)
        sinks.upsert(bars(spark, [3.0]), path, KEYS)
    with pytest.raises(sinks.DaysTaken):
        sinks.upsert(bars(spark, [4.0]), path, KEYS)
    sinks.settle(spark, path)
    assert [x[2] for x in stored(spark, path)] == [3.0] and [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.upsert(bars(spark, [4.0]), path, KEYS)
    assert [x[2] for x in stored(spark, path)] == [4.0]


def test_latest_by_state(spark, tmp_path):
    """One row a ticker; rows later than the watermark's delay, a repeated batch and a restart change nothing."""
    path = f"{tmp_path}/in"
    minute = dt.timedelta(minutes=1)

    def land(*parts):
        for p in parts:
            p.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(S.BARS).option("maxFilesPerTrigger", 1).parquet(path)
        ST.start_latest(stream, f"{tmp_path}/out", f"{tmp_path}/state", open_only=False, available=True).awaitTermination()
        return sorted((r.ticker, r.timestamp, r.close) for r in ST.latest_rows(spark, f"{tmp_path}/out").collect())

    first = land(bars(spark, [1.0, 2.0]), bars(spark, [5.0], ticker="B"), bars(spark, [3.0], FRIDAY + 5 * minute))
    assert first == [("A", FRIDAY + 5 * minute, 3.0), ("B", FRIDAY, 5.0)]
    late = land(bars(spark, [9.0], FRIDAY - minute), bars(spark, [8.0], FRIDAY + minute, "LATE"), bars(spark, [7.0], FRIDAY + 5 * minute - dt.timedelta(seconds=5), "NEW"))
    assert late == [*first, ("NEW", FRIDAY + 5 * minute - dt.timedelta(seconds=5), 7.0)]
    versions = ST._versions(spark, f"{tmp_path}/out")
    assert len(versions) <= 2
    # the last batch again, as after a crash between its write and its commit
    for _ in range(2):
        ST._merge_latest(bars(spark, [7.0], FRIDAY + 5 * minute - dt.timedelta(seconds=5), "NEW"), f"{tmp_path}/out", versions[-1], "timestamp")
    assert sorted((r.ticker, r.timestamp, r.close) for r in ST.latest_rows(spark, f"{tmp_path}/out").collect()) == late
    assert ST._versions(spark, f"{tmp_path}/out") == versions


def test_upsert_moves_whole_days(spark, tmp_path, monkeypatch):
    """Days are written once where they are staged and then moved; one that was moved before a crash isn't
    staged any more, and the rest follow. Days of many rows are spread over tasks."""
    path, day = f"{tmp_path}/t", dt.timedelta(days=1)
    written, parquet = [], type(spark.range(0).write).parquet
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda w, p, *a, **k: written.append(p.rsplit("/", 1)[1]) or parquet(w, p, *a, **k))
    null = bars(spark, [9.0]).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    rows = bars(spark, [float(i) for i in range(40)], step=day).unionByName(null)
    sinks.upsert(rows, path, KEYS)
    assert written == ["new", "days"] and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("date=")]) == 41
    move, moved = sinks.rename, []

    def dies(spark, old, new):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(new)
        move(spark, old, new)

    again = bars(spark, [100.0 + i for i in range(4)], step=day)
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(sinks, "_at_once", lambda do, names: [do(n) for n in names])
        m.setattr(sinks, "rename", dies)
        sinks.upsert(again, path, KEYS)
    sinks.settle(spark, path)
    monkeypatch.setattr(sinks, "_DAY_ROWS", 0)
    sinks.upsert(bars(spark, [200.0], FRIDAY + 50 * day), path, KEYS)
    got = sorted(r.close for r in sinks.read_table(spark, path).collect())
    assert got == sorted([9.0, *[float(i) for i in range(4, 40)], *[100.0 + i for i in range(4)], 200.0]) and [p.name for p in tmp_path.iterdir()] == ["t"]

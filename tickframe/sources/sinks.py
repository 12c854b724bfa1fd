"""Tables: create, append, replace in part, export."""

from __future__ import annotations

import datetime as dt
import math
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache, reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def ensure_table(spark: SparkSession, name: str, schema: str, partition: str | None = None, buckets: tuple[Sequence[str], Sequence[str], int] | None = None) -> None:
    """buckets: (columns that choose a row's bucket, columns to sort by, how many)."""
    by = f" partitioned by ({partition})" if partition else ""
    if buckets:
        by += f" clustered by ({', '.join(buckets[0])}) sorted by ({', '.join(buckets[1])}) into {buckets[2]} buckets"
    spark.sql(f"create table if not exists {name} ({schema}) using parquet{by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"drop table if exists {name}")


def recreate_table(spark: SparkSession, name: str, schema: str, partition: str | None = None) -> None:
    drop_table(spark, name)
    ensure_table(spark, name, schema, partition)


def append(df: DataFrame, path: str, ts: str = "timestamp", seen: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """Add rows to Parquet files by day; an empty frame adds none. Days of many rows get several files,
    each sorted by time. seen: an observation and what it measures of the rows written."""
    day = df.withColumn("date", F.to_date(ts))
    order = [c for c in (ts, "ticker") if c in df.columns]
    rows = day.hint("rebalance", "date").sortWithinPartitions("date", *order)
    # after the last exchange: a stage made again for a lost executor would be measured twice
    (rows.observe(seen[0], *seen[1]) if seen else rows).write.mode("append").partitionBy("date").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path).drop("date")


@cache
def _paths(jvm):
    """The class of paths: to find it by its name each time costs far more than a file operation."""
    return jvm.org.apache.hadoop.fs.Path


@cache
def _system(spark: SparkSession, root: str):
    """The file system of scheme and authority, asked for once: three calls to the JVM, of which a table of many
    days would make some thousands."""
    return _paths(spark._jvm)(root or "/").getFileSystem(spark._jsc.hadoopConfiguration())


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    root = re.match(r"[^:/]+:(//[^/]*)?", path)
    return _system(spark, f"{root[0]}/" if root else ""), _paths(spark._jvm)(path)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = files_of(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = files_of(spark, path)
    files.delete(place, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    files, place = files_of(spark, path)
    if not files.rename(place, files_of(spark, new)[1]):
        raise OSError(f"{path} can't be renamed to {new}")


def create(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file; an error where it is there already."""
    files, place = files_of(spark, path)
    out = files.create(place, False)
    out.write(text.encode())
    out.close()


def _at_once(do: Callable[[Any], Any], names: Iterable[Any]) -> list[Any]:
    """do for each name, several at a time: of a table of many days each file operation is a wait of its own."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(do, names))


def _beside(spark: SparkSession, path: str, tag: str) -> list[str]:
    """Files and folders beside a table whose names are the table's with the tag and more."""
    files, place = files_of(spark, path.rstrip("/") + tag)
    parent, name = place.getParent(), place.getName()
    found = [x.getPath() for x in files.listStatus(parent)] if files.exists(parent) else []
    return sorted(x.toString() for x in found if x.getName().startswith(name))


class DaysTaken(RuntimeError):
    """Another writer holds a day of the table."""


def _claim(spark: SparkSession, path: str, days: Sequence[dt.date | None], owner: str, wait: float) -> list[str]:
    """Take the days, all or none; of two writers the later one waits up to `wait` seconds. The first day is
    taken before the others, so that writers of the same days don't turn each other away."""
    until = time.monotonic() + wait
    names = [f"{path.rstrip('/')}_claim-{day}" for day in sorted(map(str, days))]

    def take(name: str) -> Exception | None:
        try:
            create(spark, name, owner)
        except Exception as error:  # whatever it is, what was taken is given back first
            return error
        return None

    while True:
        answers = _at_once(take, names[:1])
        if answers == [None]:
            answers += _at_once(take, names[1:])
        failed = [(name, error) for name, error in zip(names, answers, strict=False) if error is not None]
        if not failed:
            return names
        _at_once(lambda name: remove(spark, name), [name for name, error in zip(names, answers, strict=False) if error is None])
        asked, error = failed[0]
        for _, e in failed:
            if not (isinstance(e, Py4JJavaError) and e.java_exception.getClass().getName().endswith("FileAlreadyExistsException")):
                raise e
        if time.monotonic() >= until:
            raise DaysTaken(f"{asked}: another writer has the day, or has died with it (then call settle)") from error
        time.sleep(min(1.0, wait))


def settle(spark: SparkSession, path: str) -> None:
    """After a writer has died: days that it had staged whole are put in place, what it had not is thrown
    away, and its claims go. Not to be called beside a living writer of the table."""
    for staged in _beside(spark, path, "_staging-"):
        if exists(spark, f"{staged}/ready"):
            _place(spark, path, staged)
        remove(spark, staged)
    _at_once(lambda claim: remove(spark, claim), _beside(spark, path, "_claim-"))


def _place(spark: SparkSession, path: str, staged: str) -> None:
    """Staged days are moved to where the table's were. A day that was moved isn't staged any more, so after
    a crash the rest can be."""
    files, place = files_of(spark, path)
    files.mkdirs(place)

    def move(name: str) -> None:
        remove(spark, f"{path.rstrip('/')}/{name}")
        rename(spark, f"{staged}/days/{name}", f"{path.rstrip('/')}/{name}")

    names = [x.getPath().getName() for x in files.listStatus(files_of(spark, f"{staged}/days")[1])]
    _at_once(move, [n for n in names if n.startswith("date=")])


#: Rows of a day that one task can write; days of more are spread over several.
_DAY_ROWS = 1 << 18


def upsert(
    df: DataFrame, path: str, keys: list[str], ts: str = "timestamp", order: Sequence[str] = (), wait: float = 0.0,
    before: Callable[[DataFrame], None] | None = None, seen: tuple[Observation, Sequence[Column]] | None = None,
) -> bool:
    """Rows of df replace those of their keys; only the days that df touches are read and written. Of
    several rows of a key in df the last by `order` stays (any one without it). An empty frame changes
    nothing; the answer is whether anything was written.

    The new rows, and then the new days, are staged beside the table first, in a folder of this call's
    own, since a plan can't overwrite what it reads, and df is evaluated once. The days are claimed
    between these: a second writer of one of them waits so many seconds for it, then fails (DaysTaken)
    with the table as it was, and what it reads is what the first one left. Once the days are staged
    whole, a crash is mended by `settle`. before is given the touched days as they were; seen as in
    `append`."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}_staging-{uuid.uuid4().hex[:12]}"
    whole = df.withColumn("date", F.to_date(ts))
    schema = whole.schema
    held: list[str] = []
    try:
        whole.write.parquet(f"{staged}/new")
        new = spark.read.schema(schema).parquet(f"{staged}/new")
        counts = {r["date"]: r["count"] for r in new.groupBy("date").count().collect()}
        days = list(counts)
        if days:
            held = _claim(spark, path, days, staged, wait)
            both = new.withColumn("_new", F.lit(1))
            if exists(spark, path):
                known = [d for d in days if d is not None]
                touched = F.col("date").isin(known) if known else F.lit(False)
                touched = touched | F.col("date").isNull() if None in days else touched
                old = spark.read.schema(schema).parquet(path).where(touched)
                if before is not None:
                    before(old)
                both = both.unionByName(old.withColumn("_new", F.lit(0)))
            apart = ts in keys and max(counts.values()) <= _DAY_ROWS
            if apart:  # a day is one task, which has all rows of its keys
                both = both.repartition(max(math.ceil(len(days) / 32), min(len(days), sum(counts.values()) >> 16)), "date")
            last = Window.partitionBy(*(["date"] if apart else []), *keys).orderBy(F.col("_new").desc(), *[F.col(c).desc() for c in order])
            kept = both.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_new")
            kept = kept if apart else kept.hint("rebalance", "date")
            # after the last exchange: a stage made again for a lost executor would be measured twice
            (kept.observe(seen[0], *seen[1]) if seen else kept).write.partitionBy("date").parquet(f"{staged}/days")
            create(spark, f"{staged}/ready")
    except BaseException:
        _at_once(lambda name: remove(spark, name), (staged, *held))
        raise
    if days:
        _place(spark, path, staged)  # where this fails, staged days and claims stay for `settle`
    remove(spark, staged)
    _at_once(lambda name: remove(spark, name), held)
    return bool(days)


def days_of(spark: SparkSession, path: str) -> list[dt.date]:
    """The days of a stored table, by the names of its partitions."""
    files, place = files_of(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(dt.date.fromisoformat(n[5:]) for n in names if re.fullmatch(r"date=\d{4}-\d\d-\d\d", n))


def first_days(path: str, rows: DataFrame) -> DataFrame:
    """(ticker, first): the first day of every ticker of the table at path, of which `rows` are part. It is
    kept beside the table, to which a row is added for a new ticker or an earlier day."""
    spark, kept = rows.sparkSession, f"{path.rstrip('/')}_firsts"
    if exists(spark, kept):
        known = spark.read.parquet(kept).groupBy("ticker").agg(F.min("first").alias("first"))
        own = rows.groupBy("ticker").agg(F.to_date(F.min("timestamp")).alias("own")).join(known, "ticker", "left")
        new = own.where("first is null or own < first").select("ticker", F.col("own").alias("first"))
    else:
        new = spark.read.parquet(path).groupBy("ticker").agg(F.to_date(F.min("timestamp")).alias("first"))
    new.write.mode("append").parquet(kept)
    return spark.read.parquet(kept).groupBy("ticker").agg(F.min("first").alias("first"))


def last_before(path: str, tickers: DataFrame, start) -> DataFrame:
    """Of each of the tickers the last row of the stored table at path before the day `start`. Days are read
    back from start, twice as many each time, until every ticker has one; those whose first day isn't
    before start (`first_days`) have none and aren't waited for."""
    spark, day = tickers.sparkSession, dt.date.fromisoformat(str(start)[:10])
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c != "date"]
    rest = [c for c in columns if c != "ticker"]
    days = [d for d in reversed(days_of(spark, path)) if d < day]
    none = stored.select(*columns).limit(0)
    if not days:
        return none
    missing = tickers.join(first_days(path, none).where(F.col("first") < F.lit(day)), "ticker").select("ticker").persist()
    found, at, step = [none], 0, 1
    while at < len(days) and not missing.isEmpty():
        part = stored.where(F.col("date").between(F.lit(days[min(at + step, len(days)) - 1]), F.lit(days[at]))).join(missing, "ticker", "left_semi")
        part = part.groupBy("ticker").agg(F.max_by(F.struct(*rest), "timestamp").alias("_r")).select("ticker", "_r.*").persist()
        found.append(part)
        missing, at, step = missing.join(part, "ticker", "left_anti").persist(), at + step, 2 * step
    return reduce(DataFrame.unionByName, found)


def export_sorted(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).orderBy("timestamp", "ticker")


def export_normalized(df: DataFrame, path: str, columns: list[str]) -> None:
    """Range-sorted Parquet files."""
    export_sorted(df, columns).write.mode("overwrite").parquet(path)

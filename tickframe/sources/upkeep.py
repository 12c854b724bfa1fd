"""Upkeep of stored tables: removal of duplicates with a swap, and profiles kept while writing."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StructType

from tickframe.operators.dedup import dedup_last
from tickframe.sources import sinks


class TableChanged(RuntimeError):
    """Files came or went while a table was read."""


def stored_duplicates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The dry run: rows of the stored table, keys (that many stay), rows that would go."""
    copies = spark.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("c"))
    counted = copies.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows"))
    return counted.withColumn("would_delete", F.col("total_rows") - F.col("unique_rows"))


def dedup_stored(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], ts: str = "timestamp") -> int:
    """Of each key of a table stored by day the last row by order stays; the answer is how many went.

    The rows that stay are written beside the table and counted against the dry run, then two renames put
    them in its place. A call that died is first mended by `recover`; readers meet the table whole, or
    for the moment between the renames none. Where files came while it was read, the table stays as it
    was and TableChanged is raised. Rows of a null time have a day of their own, null keys are keys, and
    an empty table or one without duplicates isn't written."""
    path = path.rstrip("/")
    recover(spark, path)
    files = _names(spark, path)
    total, stay, go = stored_duplicates(spark, path, keys).first()
    if not go:
        return 0
    rows = dedup_last(spark.read.parquet(path), keys, order).hint("rebalance", "date")
    rows.sortWithinPartitions("date", ts).write.mode("overwrite").partitionBy("date").parquet(f"{path}_fresh")
    if (written := spark.read.parquet(f"{path}_fresh").count()) != stay:
        sinks.remove(spark, f"{path}_fresh")
        raise TableChanged(f"{written} rows were written for {stay} keys")
    if _names(spark, path) != files:
        sinks.remove(spark, f"{path}_fresh")
        raise TableChanged(path)
    sinks.create(spark, f"{path}_fresh/_checked")
    sinks.rename(spark, path, f"{path}_old")
    sinks.rename(spark, f"{path}_fresh", path)
    sinks.remove(spark, f"{path}_old")
    sinks.remove(spark, f"{path}/_checked")
    return go


def recover(spark: SparkSession, path: str) -> None:
    """Mend a table whose `dedup_stored` died: before the first rename the table is the old one, after it
    the new one; rows are lost at no step."""
    path = path.rstrip("/")
    if sinks.exists(spark, f"{path}_old"):
        if not sinks.exists(spark, path):
            checked = sinks.exists(spark, f"{path}_fresh/_checked")
            sinks.rename(spark, f"{path}_fresh" if checked else f"{path}_old", path)
        sinks.remove(spark, f"{path}_old")
    sinks.remove(spark, f"{path}_fresh")
    sinks.remove(spark, f"{path}/_checked")


def _names(spark: SparkSession, path: str) -> set[str]:
    files, place = sinks.files_of(spark, path)
    found, each = set(), files.listFiles(place, True)
    while each.hasNext():
        found.add(each.next().getPath().toString())
    return found


_PROFILE = "sign int, total long, nulls map<string,long>, zeros map<string,long>, earliest timestamp_ntz, latest timestamp_ntz, tickers array<string>, days array<date>"


def _measures(schema: StructType, ts: str) -> list[Column]:
    """What a profile needs of rows, as aggregates. Tickers are gathered by name: listed instruments, some
    ten thousand at most."""
    out = [F.count("*").alias("total"), F.min(ts).alias("earliest"), F.max(ts).alias("latest"), F.collect_set("ticker").alias("tickers"), F.collect_set(F.to_date(ts)).alias("days")]
    for k, f in enumerate(_fields(schema)):
        out.append(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{k}"))
        if isinstance(f.dataType, NumericType):
            out.append(F.count_if(F.col(f"`{f.name}`") == 0).alias(f"z{k}"))
    return out


def _fields(schema: StructType) -> list:
    return [f for f in schema.fields if not isinstance(f.dataType, ArrayType) and f.name != "date"]


def _note(spark: SparkSession, path: str, schema: StructType, found: dict, sign: int) -> tuple:
    names = [f.name for f in _fields(schema)]
    nulls = {n: found[f"n{k}"] for k, n in enumerate(names)}
    zeros = {n: found[f"z{k}"] for k, n in enumerate(names) if f"z{k}" in found}
    return sign, found["total"], nulls, zeros, found["earliest"], found["latest"], list(found["tickers"]), list(found["days"])


def _profiled(spark: SparkSession, path: str, write) -> None:
    """Run write(), which gives rows of the profile, between a mark and its removal: where the mark stays,
    the profile isn't to be trusted."""
    mark = f"{path}_profile/_open-{uuid.uuid4().hex[:12]}"
    sinks.create(spark, mark)
    if rows := write():
        spark.createDataFrame(rows, _PROFILE).coalesce(1).write.mode("append").parquet(f"{path}_profile")
    sinks.remove(spark, mark)


def append_profiled(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """`append`, of which the rows written are measured on their way and a row is added to the profile."""
    spark, path = df.sparkSession, path.rstrip("/")

    def write() -> list[tuple]:
        seen = Observation()
        sinks.append(df, path, ts, (seen, _measures(df.schema, ts)))
        found = seen.get
        return [_note(spark, path, df.schema, found, 1)] if found.get("total") else []

    _profiled(spark, path, write)


def upsert_profiled(df: DataFrame, path: str, keys: list[str], ts: str = "timestamp", order: Sequence[str] = (), wait: float = 0.0) -> None:
    """`upsert` whose touched days leave the profile as they were and enter it as they are written. Keys
    must name ticker and time, so no ticker, day or extreme time ever goes."""
    spark, path = df.sparkSession, path.rstrip("/")
    if not {"ticker", ts} <= set(keys):
        raise ValueError("keys without ticker and time")

    def write() -> list[tuple]:
        seen, old = Observation(), []
        measures = _measures(df.schema, ts)
        before = lambda rows: old.append(rows.agg(*measures).first().asDict())
        if not sinks.upsert(df, path, keys, ts, order, wait, before, (seen, measures)):
            return []
        return [_note(spark, path, df.schema, x, -1) for x in old if x["total"]] + [_note(spark, path, df.schema, seen.get, 1)]

    _profiled(spark, path, write)


def reprofile(spark: SparkSession, path: str, ts: str = "timestamp") -> None:
    """The profile anew, by a scan of the table: for one that was written without, or after a crash."""
    path = path.rstrip("/")
    sinks.remove(spark, f"{path}_profile")
    rows = spark.read.parquet(path).drop("date")
    _profiled(spark, path, lambda: [_note(spark, path, rows.schema, rows.agg(*_measures(rows.schema, ts)).first().asDict(), 1)])


def _kept(spark: SparkSession, path: str) -> DataFrame:
    path = path.rstrip("/")
    if sinks._beside(spark, f"{path}_profile/", "/_open-"):
        raise RuntimeError(f"{path}: a write is under way, or has died (then call settle and reprofile)")
    found = sinks.exists(spark, f"{path}_profile") and sinks._beside(spark, f"{path}_profile/", "/part-")
    return spark.read.schema(_PROFILE).parquet(f"{path}_profile") if found else spark.createDataFrame([], _PROFILE)


def profile_stats(spark: SparkSession, path: str) -> DataFrame:
    """`table_stats` of a profiled table, of which no row is read."""
    kept = _kept(spark, path)
    one = kept.agg(F.coalesce(F.sum(F.col("sign") * F.col("total")), F.lit(0)).alias("total_rows"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))
    tickers = kept.select(F.explode("tickers").alias("t")).agg(F.countDistinct("t").alias("unique_tickers"))
    days = kept.select(F.explode("days").alias("d")).agg(F.countDistinct("d").alias("unique_days"))
    return one.join(tickers, F.lit(True)).join(days, F.lit(True)).select("total_rows", "unique_tickers", "earliest", "latest", "unique_days")  # one row each


def profile_quality(spark: SparkSession, path: str) -> DataFrame:
    """`quality` of a profiled table, of which no row is read; no rows before the first write."""
    kept = _kept(spark, path)
    nulls = kept.select("sign", F.explode("nulls").alias("column_name", "n")).groupBy("column_name").agg(F.sum(F.col("sign") * F.col("n")).alias("null_count"))
    zeros = kept.select("sign", F.explode("zeros").alias("column_name", "n")).groupBy("column_name").agg(F.sum(F.col("sign") * F.col("n")).alias("zero_count"))
    return nulls.join(zeros, "column_name", "left")

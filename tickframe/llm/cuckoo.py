"""Exact dedup: a sharded cuckoo-filter index of live text digests, with the stored keys beside it.

State is a chain of versions in one folder; a version holds what it adds, and counts from the moment its
entry is in log/:
  v<n>/keys     (digest, keep_id, copies, version)  live digests that changed: smallest doc_id, rows; 0 copies: gone
  v<n>/members  (digest, doc_id, n)                 rows that came (n > 0) or went (n < 0)
  v<n>/filters  (shard, cells)                      the cuckoo filters of all shards, about 2.5 octets a key
The filter decides what happens to a digest: one that it misses is new and is looked up nowhere; one that
it hits is verified against the stored keys. Tasks only see distinct digests,
so a text that a third of all rows share is one key."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.storage import discard, materialise, new_path

SLOTS = 4
KICKS = 500
KEYS_PER_SHARD = 100_000
BATCHES = 4
_KEYS = "digest binary, keep_id long, copies long, version long"
_MEMBERS = "digest binary, doc_id long, n long"
_FILTERS = "shard int, cells binary"


def digest_of(text):
    """SHA-256 of a text column (null: empty) with each run of ASCII white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256))


class CuckooFilter:
    """Partial-key cuckoo filter of 16-bit tags, four slots a bucket. Keys are SHA-256 digests, so
    bucket and tag are read from the digest itself."""

    def __init__(self, buckets: int = 16, cells: np.ndarray | None = None):
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells
        self.mask = len(self.cells) - 1

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(cells=np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, digests: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)
        tag = (words[:, 3] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)  # 0 marks an empty slot
        first = (words[:, 2] & np.uint64(self.mask)).astype(np.int64)
        return tag, first, self._other(first, tag)

    def _other(self, bucket, tag):
        return (bucket ^ (tag.astype(np.int64) * 0x5BD1E995)) & self.mask

    def contains(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        tag, a, b = self._places(digests)
        return ((self.cells[a] == tag[:, None]) | (self.cells[b] == tag[:, None])).any(axis=1)

    def insert(self, digests: list[bytes]) -> bool:
        """False when a key found no place: the caller then resizes from its stored keys. Keys go to the
        free slots of their two buckets all at once; those that are left push others out one by one."""
        if not digests:
            return True
        tag, a, b = self._places(digests)
        left = np.arange(len(tag))
        for bucket in (a, b):
            order = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)  # among the keys of the same bucket
            taken = self.cells != 0
            free = np.argsort(taken, axis=1, kind="stable")  # the free slots come first
            fits = rank < SLOTS - taken.sum(axis=1)[at]
            self.cells[at[fits], free[at[fits], rank[fits]]] = tag[order[fits]]
            left = order[~fits]
        rng = np.random.default_rng(len(digests))
        for own, bucket in zip(tag[left], np.where(rng.random(len(left)) < 0.5, a[left], b[left]), strict=True):
            for _ in range(KICKS):
                slot = rng.integers(SLOTS)
                own, self.cells[bucket, slot] = self.cells[bucket, slot], own
                bucket = self._other(np.int64(bucket), own)
                free = np.flatnonzero(self.cells[bucket] == 0)
                if len(free):
                    self.cells[bucket, free[0]] = own
                    break
            else:
                return False
        return True

    def delete(self, digests: list[bytes]) -> None:
        """Remove one tag per key; only keys that were inserted may be given."""
        if not digests:
            return
        for tag, a, b in zip(*self._places(digests), strict=True):
            for bucket in (a, b):
                own = np.flatnonzero(self.cells[bucket] == tag)
                if len(own):
                    self.cells[bucket, own[0]] = 0
                    break

    @classmethod
    def holding(cls, digests: list[bytes], buckets: int = 16) -> CuckooFilter:
        """A filter of all these keys; it doubles until they fit."""
        while buckets * SLOTS * 0.9 < len(digests):
            buckets *= 2
        while not (made := cls(buckets)).insert(digests):
            buckets *= 2
        return made


def _changed(held: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter with the digests of changes put in (sign 1) or taken out (sign -1); no cells
    where they overflow. Without changes it stays as it is."""
    shard = int((held if len(held) else changes).shard.iloc[0])
    live = CuckooFilter.from_bytes(held.cells.iloc[0]) if len(held) else CuckooFilter()
    live.delete(list(changes.digest[changes.sign < 0]))
    fits = live.insert(list(changes.digest[changes.sign > 0]))
    return pd.DataFrame({"shard": [shard], "cells": [live.to_bytes() if fits else None]})


class CuckooIndex:
    """Live digests of documents. insert() and delete() take frames (doc_id long, digest binary); a row
    that is there from an earlier commit, or is to go and isn't there, changes nothing. An index at a
    path that holds one is opened as it was left. One writer at a time: a second one that starts from
    the same version fails, as the version's folder is taken."""

    def __init__(self, spark: SparkSession, path: str | None = None, keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.path, self.keys_per_shard = spark, path or new_path(spark, "cuckoo"), keys_per_shard
        self.version, self.shards, self.total, self.resized = 0, 1, 0, 0
        self._regrown: DataFrame | None = None  # filters of more shards than the last version has
        fs, place = self._fs(f"{self.path}/log")
        if fs.exists(place):
            self.version = max((int(x.getPath().getName()) for x in fs.listStatus(place) if x.getPath().getName().isdigit()), default=0)
        if self.version:
            stream = fs.open(self._fs(f"{self.path}/log/{self.version}")[1])
            entry = json.loads(bytes(stream.readAllBytes()).decode())
            stream.close()
            self.shards, self.total = entry["shards"], entry["keys"]

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _read(self, name: str, schema: str, versions=None) -> DataFrame:
        found = [f"{self.path}/v{k}/{name}" for k in versions or range(1, self.version + 1)]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def keys(self, of: DataFrame | None = None) -> DataFrame:
        """(digest, keep_id, copies) of the live digests, or of those among `of`: the last version's word."""
        rows = self._read("keys", _KEYS)
        rows = rows.join(of.select("digest"), "digest", "left_semi") if of is not None else rows
        last = rows.groupBy("digest").agg(F.max_by(F.struct("keep_id", "copies"), "version").alias("k")) if self.version != 1 else rows.select("digest", F.struct("keep_id", "copies").alias("k"))
        return last.select("digest", "k.*").where("copies > 0")

    def members(self, of: DataFrame | None = None) -> DataFrame:
        """(digest, doc_id, n): how many rows of a document are live, of the digests among `of`."""
        rows = self._read("members", _MEMBERS)
        rows = rows.join(of.select("digest").distinct(), "digest", "left_semi") if of is not None else rows
        return rows.groupBy("digest", "doc_id").agg(F.sum("n").alias("n")).where("n > 0")

    def filters(self) -> DataFrame:
        if self._regrown is not None:
            return self._regrown
        return self._read("filters", _FILTERS, [self.version]) if self.version else self.spark.createDataFrame([], _FILTERS)

    def _shard(self, df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int"))

    def _make_room(self, coming: int) -> None:
        """Shards for so many more keys, before any row is dealt to one: no shard is ever given many more than
        twice keys_per_shard. What there is of filters is made anew from the stored keys."""
        shards = self.shards
        while self.total + coming > 2 * shards * self.keys_per_shard:
            shards *= 2
        if shards == self.shards:
            return
        self.shards = shards
        if self.version:
            self.resized += 1
            self._regrown = materialise(self._shard(self.keys().select("digest")).groupBy("shard").applyInPandas(_made, _FILTERS), "filters")

    def probe(self, digests: DataFrame) -> DataFrame:
        """digests(digest) with hit: whether its shard's filter has it (it may be wrong where it says yes)."""

        def ask(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            hit = CuckooFilter.from_bytes(held.cells.iloc[0]).contains(list(asked.digest)) if len(held) and len(asked) else np.zeros(len(asked), bool)
            return pd.DataFrame({"digest": asked.digest, "hit": hit})

        asked = self._shard(digests.select("digest"))
        return materialise(asked.groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInPandas(ask, "digest binary, hit boolean"), "probed")

    def insert(self, rows: DataFrame) -> None:
        pairs = materialise(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "pairs")
        asked = materialise(pairs.select("digest").distinct(), "asked")
        self._make_room(asked.count())
        probed = self.probe(asked)
        hits = probed.where("hit")
        stored = materialise(self.keys(hits), "stored")  # what the filter hit, and rightly so
        there = self.members(stored).select(F.col("digest").alias("d"), F.col("doc_id").alias("i"))
        again = pairs.join(stored.select("digest"), "digest", "left_semi").join(there, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_anti")
        fresh = pairs.join(stored.select("digest"), "digest", "left_anti")
        came = materialise(fresh.unionByName(again), "came")
        groups = came.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("copies"))
        old = stored.select("digest", F.col("keep_id").alias("k"), F.col("copies").alias("c"))
        keys = materialise(groups.join(old, "digest", "left").select("digest", F.least("keep_id", "k").alias("keep_id"), (F.col("copies") + F.coalesce("c", F.lit(0))).alias("copies"), F.col("c").isNull().alias("new")), "keys")
        self._commit(keys, came, keys.where("new").select("digest", F.lit(1).alias("sign")))
        for old in (pairs, asked, probed, stored, came, keys):
            discard(old)

    def delete(self, rows: DataFrame) -> None:
        pairs = materialise(rows.select("digest", "doc_id").distinct(), "pairs")
        probed = self.probe(pairs.select("digest").distinct())
        there = materialise(self.members(probed.where("hit")), "there")
        asked = pairs.select(F.col("digest").alias("d"), F.col("doc_id").alias("i"))
        same = (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i"))
        went = materialise(there.join(asked, same, "left_semi").withColumn("n", -F.col("n")), "went")
        left = there.join(asked, same, "left_anti").groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("copies"))
        keys = materialise(went.select("digest").distinct().join(left, "digest", "left").select("digest", "keep_id", F.coalesce("copies", F.lit(0)).cast("long").alias("copies")), "keys")
        self._commit(keys, went, keys.where("copies = 0").select("digest", F.lit(-1).alias("sign")))
        for old in (pairs, probed, there, went, keys):
            discard(old)

    def _commit(self, keys: DataFrame, members: DataFrame, changes: DataFrame) -> None:
        """Write the next version. changes(digest, sign): what goes into the filters and out of them. A
        filter that overflows is made anew, larger, from the stored keys of its shard."""
        filters, last = self.filters(), self.version + 1
        place = f"{self.path}/v{last}"
        keys.select("digest", "keep_id", "copies", F.lit(last).cast("long").alias("version")).write.parquet(f"{place}/keys")
        members.select("digest", "doc_id", "n").write.parquet(f"{place}/members")
        changed = materialise(filters.groupBy("shard").cogroup(self._shard(changes).groupBy("shard")).applyInPandas(_changed, _FILTERS), "filters")
        self.version = last
        self.total += changes.agg(F.sum("sign")).first()[0] or 0
        whole, again = changed.where("cells is not null"), changed.where("cells is null").select("shard")
        if not again.isEmpty():
            self.resized += 1
            held = self._shard(self.keys().select("digest")).join(again, "shard", "left_semi")
            whole = whole.unionByName(held.groupBy("shard").applyInPandas(_made, _FILTERS))
        whole.write.parquet(f"{place}/filters")
        self._regrown = None
        fs, entry = self._fs(f"{self.path}/log/{last}")
        out = fs.create(entry, False)
        out.write(json.dumps({"shards": self.shards, "keys": self.total}).encode())
        out.close()

    def lookup(self, rows: DataFrame) -> DataFrame:
        """rows with keep_id and copies of their digest; both null where it isn't live. Distinct
        digests probe their shard's filter, hits are verified against the stored keys, and the answer
        goes back to the rows by an equi-join, whose hot digests adaptive execution can split."""
        hits = self.probe(rows.select("digest").distinct()).where("hit")
        return rows.join(materialise(self.keys(hits), "found"), "digest", "left")


def _made(held: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter from its stored keys."""
    return pd.DataFrame({"shard": [int(held.shard.iloc[0])], "cells": [CuckooFilter.holding(list(held.digest)).to_bytes()]})


def digests_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, text_hash) of every row of docs, written out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest_of(F.col(text_col)).alias("digest"), F.xxhash64(text).alias("text_hash")), "digests")


def portion(rows: DataFrame, k: int, batches: int) -> DataFrame:
    """The k-th of `batches` parts of rows, by document."""
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k)


def indexed(rows: DataFrame, keys_per_shard: int = KEYS_PER_SHARD, batches: int = BATCHES) -> CuckooIndex:
    """A new index of rows(doc_id, digest), inserted in `batches` parts."""
    index = CuckooIndex(rows.sparkSession, keys_per_shard=keys_per_shard)
    for k in range(batches):
        index.insert(portion(rows, k, batches))
    return index


def answer(rows: DataFrame, index: CuckooIndex) -> DataFrame:
    """Every row of digests_of as (doc_id, digest, keep_id, group_size, kept, text_hash)."""
    return index.lookup(rows).select("doc_id", "digest", "keep_id", F.col("copies").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_hash")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys_per_shard: int = KEYS_PER_SHARD, batches: int = BATCHES) -> DataFrame:
    """Every row of docs as (doc_id, digest, keep_id, group_size, kept, text_hash), through a new
    CuckooIndex that takes them in `batches` parts; text_hash is xxhash64 of the whole text.

    Texts are equal when identical after white-space runs are made one space; null counts as empty;
    the smallest doc_id of a group stays. Repeated rows are counted in group_size and come back as
    often as read, each flagged as its document is; a null doc_id doesn't stay unless its whole group
    has none (keep_id is then null and kept true). Empty tables give an empty result; other columns
    aren't looked at. Shards grow in number with the distinct digests (up to twice keys_per_shard each)."""
    rows = digests_of(docs, id_col, text_col)
    return answer(rows, indexed(rows, keys_per_shard, batches))

"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.llm.bpe import Encoder
from tickframe.llm.storage import materialise

CAPACITY = 2048
END = 0
#: Rows of one size that are ranked by one task.
SALT_ROWS = 1000
ITEM, GAP = 0, 1


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a text's ids, then END; where longer than capacity,
    cut into pieces of capacity ids, of which the first has the rest. Null texts are empty (END alone)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer).ids
        for b in batches:
            rows = []
            for doc, text in zip(b.doc_id, b.text, strict=True):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4", copy=False)
                bounds = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                rows += [(doc, i, s, e - s, zlib.crc32(ids[s:e])) for i, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _totals(open_: DataFrame) -> dict[tuple[int, int], int]:
    """How many rows there are of each (kind, size): at most two for each size up to the capacity."""
    return {(r["kind"], r["size"]): r["c"] for r in open_.groupBy("kind", "size").agg(F.count("*").alias("c")).collect()}


def _ranked(open_: DataFrame, totals: dict[tuple[int, int], int], marks: dict[tuple[int, int], int]) -> DataFrame:
    """open_(kind, size, id, slot) with `rank`, 0, 1, ... among the rows of the same kind and size, and
    with the mark of that kind and size.

    No size is one task's: its rows are dealt to salts of about SALT_ROWS, ranked within their salt, and
    moved up by the number of rows in lower salts (none where no size has more rows than a salt). totals
    and marks hold a row for each kind and size, at most two for each size up to the capacity."""
    keys, counts = np.array(list(totals), np.int64).reshape(-1, 2), np.array(list(totals.values()), np.int64)
    spec = pa.table({"kind": keys[:, 0].astype(np.int32), "size": keys[:, 1], "salts": -(-counts // SALT_ROWS), "mark": np.array([marks.get(k, 0) for k in totals], np.int64)})
    rows = open_.join(F.broadcast(open_.sparkSession.createDataFrame(spec)), ["kind", "size"])
    if max(totals.values(), default=0) <= SALT_ROWS:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("kind", "size").orderBy("id", "slot")) - 1).drop("salts")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "slot"), F.col("salts")).cast("int")).drop("salts")
    parts = rows.groupBy("kind", "size", "salt").agg(F.count("*").alias("c"))  # one row per SALT_ROWS rows and size
    before = F.sum("c").over(Window.partitionBy("kind", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    below = parts.select("kind", "size", "salt", F.coalesce(before, F.lit(0)).alias("below"))
    own = F.row_number().over(Window.partitionBy("kind", "size", "salt").orderBy("id", "slot"))
    return rows.withColumn("own", own).join(below, ["kind", "size", "salt"]).withColumn("rank", F.col("own") - 1 + F.col("below")).drop("own", "below", "salt")


def _slotted(open_: DataFrame, totals: dict[tuple[int, int], int], longest: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Gaps that have room for several of the longest pieces take that many at once: each is cut into
    slots of equal size. (rows by slot, their totals.)"""
    n = F.when(F.col("kind") == GAP, F.greatest(F.lit(1), F.floor(F.col("size") / longest))).otherwise(F.lit(1))
    rows = open_.withColumn("n", n).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    out: dict[tuple[int, int], int] = {}
    for (kind, size), c in totals.items():
        k = max(1, size // longest) if kind == GAP else 1
        out[kind, size // k] = out.get((kind, size // k), 0) + c * k
    return rows.select("kind", F.floor(F.col("size") / F.col("n")).cast("long").alias("size"), "id", "slot", F.col("size").alias("room")), out


def _sweep(rows: DataFrame, totals: dict[tuple[int, int], int]) -> DataFrame:
    """One sweep upwards through the sizes: each slot takes the longest piece that fits it and that no
    smaller slot has taken. rows(kind, size, id, slot, room) with `mate` and `other`, the partner's id and size.

    In the order of sizes, pieces before slots of their size, pieces open and slots close a level, like
    parentheses: a piece meets the next slot that closes its level. Levels are prefix sums, by kinds and
    sizes over their totals and within one by rank, which settles the conflicts of equal sizes. A level
    has at most one piece and one slot of each size, so the levels spread over all tasks."""
    marks, depth = {}, 0
    for kind, size in sorted(totals, key=lambda k: (k[1], k[0])):
        marks[kind, size] = depth
        depth += totals[kind, size] if kind == ITEM else -totals[kind, size]
    level = F.when(F.col("kind") == ITEM, F.col("mark") + F.col("rank") + 1).otherwise(F.col("mark") - F.col("rank"))
    along = Window.partitionBy("level").orderBy("size", "kind")
    row = F.struct("kind", "id", "size")
    swept = _ranked(rows, totals, marks).withColumn("level", level).select("kind", "size", "id", "slot", "room", F.lead(row).over(along).alias("after"), F.lag(row).over(along).alias("before"))
    mate = F.when((F.col("kind") == ITEM) & (F.col("after.kind") == GAP), F.col("after")).when((F.col("kind") == GAP) & (F.col("before.kind") == ITEM), F.col("before"))
    return swept.select("kind", "size", "id", "slot", "room", mate["id"].alias("mate"), mate["size"].alias("other"))


def place(items: DataFrame, capacity: int) -> DataFrame:
    """items(id, size) -> (id, sequence_id, offset), bulk-synchronous best fit: the longest pieces open
    as many sequences as all need at the least, sweeps match pieces and gaps and shorten the gaps until
    nothing fits, the longest pieces left open as many as the rest needs, and so on until all are
    placed. A sequence is named by the piece that opened it. A round is a job over what is still open;
    there are about ten, whatever the number of pieces."""

    def opening(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.col("id").alias("sequence_id"), F.lit(0).alias("round"), F.lit(0).cast("long").alias("slot"), "size")

    placed, at = [opening(items.where(F.col("size") == capacity))], 0
    open_ = items.where(F.col("size") < capacity).select(F.lit(ITEM).alias("kind"), F.col("size").cast("long").alias("size"), "id", F.lit(0).cast("long").alias("slot"))
    totals = _totals(open_)
    while _sizes(totals, ITEM):
        need, take = -(-sum(n * totals[ITEM, n] for n in _sizes(totals, ITEM)) // capacity), {}
        for n in reversed(_sizes(totals, ITEM)):
            if need > 0 or 2 * n > capacity:  # two above one half never share
                take[ITEM, n] = totals[ITEM, n] if 2 * n > capacity else min(need, totals[ITEM, n])
                need -= take[ITEM, n]
        opens = (F.col("kind") == ITEM) & (F.col("rank") < F.col("mark"))
        moved = materialise(_ranked(open_, totals, take).select("kind", "size", "id", "slot", opens.alias("opens")), "opened")
        placed.append(opening(moved.where("opens")))
        kind, room = F.when(F.col("opens"), F.lit(GAP)).otherwise(F.col("kind")), F.when(F.col("opens"), capacity - F.col("size")).otherwise(F.col("size"))
        open_ = moved.select(kind.alias("kind"), room.alias("size"), "id", "slot")
        totals = _totals(open_)
        while left := _sizes(totals, ITEM):
            totals = {k: c for k, c in totals.items() if k[0] == ITEM or k[1] >= left[0]}  # smaller gaps are done with
            if not _sizes(totals, GAP):
                break
            at += 1
            rows, slots = _slotted(open_.where((F.col("kind") == ITEM) | (F.col("size") >= left[0])), totals, left[-1])
            swept = materialise(_sweep(rows, slots), "swept")
            gaps = swept.where(F.col("kind") == GAP)
            placed.append(gaps.where("mate is not null").select(F.col("mate").alias("id"), F.col("id").alias("sequence_id"), F.lit(at).alias("round"), "slot", F.col("other").alias("size")))
            rest = gaps.groupBy("id").agg((F.max("room") - F.coalesce(F.sum("other"), F.lit(0))).alias("size"))
            open_ = swept.where((F.col("kind") == ITEM) & F.col("mate").isNull()).select("kind", "size", "id", "slot")
            open_, before = open_.unionByName(rest.select(F.lit(GAP).alias("kind"), "size", "id", F.lit(0).cast("long").alias("slot"))), totals
            totals = _totals(open_)
            if sum(totals[ITEM, n] for n in _sizes(totals, ITEM)) == sum(before[ITEM, n] for n in _sizes(before, ITEM)):
                break
    before = Window.partitionBy("sequence_id").orderBy("round", "slot").rowsBetween(Window.unboundedPreceding, -1)  # at most capacity rows
    return reduce(DataFrame.unionByName, placed).select("id", "sequence_id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))


def _sizes(totals: dict[tuple[int, int], int], kind: int) -> list[int]:
    return sorted(n for k, n in totals if k == kind)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row of docs as (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Pieces and gaps are ranked in order of size over all tasks, matched by sweeps, and the gaps
    updated, until all pieces have a place (see `place`). What comes to the driver is how many pieces
    and gaps there are of each size, at most `capacity` of each.

    A null or empty text is one piece of length 1; repeated rows are packed as often as read; null ids
    stay null; an empty table gives an empty result; other columns aren't looked at."""
    cut = materialise(pieces(docs, tokenizer, id_col, text_col, capacity).withColumn("id", F.monotonically_increasing_id()), "pieces")
    placed = place(cut.select("id", F.col("length").alias("size")), capacity)
    return cut.join(placed, "id").drop("id")

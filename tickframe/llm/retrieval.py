"""Packing by lexical retrieval: neighbours from a sharded BM25 index fill each seed document's window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.bpe import Encoder
from tickframe.llm.storage import materialise

CAPACITY = 1024
END = 0
#: BM25's two constants (usual values).
K1, B = 1.2, 0.75
#: Buckets that words are hashed to; the index knows words by bucket, so counts of documents for each have a
#: fixed size (16 MB) however many words there are.
BUCKETS = 1 << 22
#: Ranges of buckets whose counts are summed by one task each.
RANGES = 256
#: A bucket that more than this share of all documents holds says nothing about neighbours and isn't indexed.
MOST = 1 / 8
#: A document's place among the shards goes by its weightiest bucket that so many documents hold.
TOPIC = 32
#: Documents of a shard, and the share of a shard's tokens that goes on to the next one.
SHARD, CARRIED = 1024, 1 / 8

_FEATURES = "doc_id long, tokens long, sequence long, crcs array<bigint>, ids binary, words long, buckets binary, times binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """Words straight from ids: a word is the tokens of letters, digits and octets above ASCII that follow
    each other; any other token is a word by itself. Case and a space before it make no difference to a
    token that the vocabulary has in both forms."""

    def __init__(self, encoder: Encoder):
        n = encoder.most + 1
        place = {token: i for i, token in encoder.octets.items()}
        self._own, self._begins, self._ends = np.arange(n, dtype=np.uint64), np.zeros(n, bool), np.zeros(n, bool)
        for i, token in encoder.octets.items():
            plain = token.lower().removeprefix(b" ") or token
            self._own[i] = place.get(plain, i)
            self._begins[i], self._ends[i] = _letter(token[0]), _letter(token[-1])
        self._own = _mixed(self._own + np.uint64(1))

    def bags(self, texts: list[np.ndarray]) -> list[tuple[int, bytes, bytes]]:
        """For the ids of each text its number of words, its buckets in order, and how often it has each (255
        at most)."""
        ids, sizes = np.concatenate(texts), np.array([len(t) for t in texts], np.int64)
        new = np.ones(len(ids), bool)
        new[1:] = ~(self._begins[ids[1:]] & self._ends[ids[:-1]])
        new[np.cumsum(sizes)[:-1]] = True  # texts end with END, so none is empty
        first = np.flatnonzero(new)
        within = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        power = np.cumprod(np.full(int(within.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        word = _mixed(np.add.reduceat(self._own[ids] * power[within], first)) % np.uint64(BUCKETS)
        doc = np.repeat(np.arange(len(texts)), sizes)[first]
        keys, times = np.unique(doc * BUCKETS + word.astype(np.int64), return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS)
        own, often = (keys % BUCKETS).astype("<u4"), np.minimum(times, 255).astype("u1")
        return [(int(n), own[a:z].tobytes(), often[a:z].tobytes()) for n, a, z in zip(np.bincount(doc, minlength=len(texts)), cuts, cuts[1:], strict=False)]


def _letter(octet: int) -> bool:
    return octet >= 128 or chr(octet).isalnum()


@cache
def _encoder(path: str) -> tuple[Encoder, str, _Words]:
    encoder = Encoder(path)
    return encoder, "<u2" if encoder.most < 1 << 16 else "<u4", _Words(encoder)


def features(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """A row for each of docs: its ids are cut into whole windows, named from `sequence` on by twos, and
    a tail, whose ids are kept; and its words for the index."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, kind, words = _encoder(tokenizer)
        at = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = []
            texts = [np.append(encoder.ids(t), np.uint32(END)).astype("<u4", copy=False) for t in b.text]
            for doc, ids, bag in zip(b.doc_id, texts, chain.from_iterable(words.bags(texts[k : k + 64]) for k in range(0, len(texts), 64)), strict=True):
                whole = len(ids) // capacity
                crcs = [zlib.crc32(ids[k * capacity : (k + 1) * capacity]) for k in range(whole)]
                rows.append((doc, len(ids), 2 * at, crcs, ids[whole * capacity :].astype(kind).tobytes(), *bag))
                at += whole
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _FEATURES.split(", ")]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, _FEATURES)


def document_counts(bags: DataFrame) -> np.ndarray:
    """How many of all documents hold each bucket. Tasks send the buckets that they met, by ranges; each
    range is summed by one task, and the ranges (BUCKETS numbers in all) come to the driver."""

    width = BUCKETS // RANGES

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for buckets in b.buckets:
                seen[np.frombuffer(buckets, "<u4")] += 1  # a document has a bucket once
        own = np.flatnonzero(seen)
        cuts = np.searchsorted(own, np.arange(RANGES + 1) * width)
        rows = [(k, (own[a:z] - k * width).astype("<u4").tobytes(), seen[own[a:z]].astype("<i8").tobytes()) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a]
        yield pd.DataFrame(rows, columns=["range", "places", "counts"])

    def summed(key: tuple[Any, ...], groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(width, np.int64)
        for g in groups:
            for places, counts in zip(g.places, g.counts, strict=True):
                out[np.frombuffer(places, "<u4")] += np.frombuffer(counts, "<i8")
        yield pd.DataFrame([(key[0], out.astype("<i8").tobytes())], columns=["range", "counts"])

    out = np.zeros(BUCKETS, np.int64)
    rows = bags.select("buckets").mapInPandas(met, "range int, places binary, counts binary")
    for r in rows.groupBy("range").applyInPandas(summed, "range int, counts binary").collect():
        out[r["range"] * width :][:width] = np.frombuffer(r["counts"], "<i8")
    return out


def weights(times: np.ndarray, held_by: np.ndarray, words: np.ndarray, documents: int, mean_words: float) -> np.ndarray:
    """BM25 weights of words in documents: how often there, documents that hold the word, words of the document."""
    rare = np.log1p((documents - held_by + 0.5) / (held_by + 0.5))
    return rare * times * (K1 + 1) / (times + K1 * (1 - B + B * words / max(mean_words, 1.0)))


class _Shard:
    """An inverted index of some items, which hands out those that no window has."""

    def __init__(self, items: pd.DataFrame):
        self.items = items.reset_index(drop=True)
        self.left = self.items["size"].to_numpy(np.int64).copy()  # ids not yet given out
        counts = np.array([len(x) // 4 for x in items.buckets], np.int64)
        buckets, weight = np.frombuffer(b"".join(items.buckets), "<u4"), np.frombuffer(b"".join(items.weights), "<f4")
        _, self.term = np.unique(buckets, return_inverse=True)
        self.cuts = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(self.term, kind="stable")
        self.post, self.weight = np.repeat(np.arange(len(items)), counts)[order], weight[order].astype(np.float64)
        self.starts = np.searchsorted(self.term[order], np.arange(int(self.term.max(initial=-1)) + 2))

    def scores(self, item: int) -> np.ndarray:
        """BM25 of all items for the words of one."""
        own = self.term[self.cuts[item] : self.cuts[item + 1]]
        first, n = self.starts[own], self.starts[own + 1] - self.starts[own]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        return np.bincount(self.post[at], self.weight[at], len(self.left))

    def take(self, item: int, most: int) -> tuple[int, int, int]:
        """(item, start in its tail, length) of its next ids."""
        n = min(most, int(self.left[item]))
        start = int(self.items["size"].iat[item] - self.left[item])
        self.left[item] -= n
        return item, start, n

    def windows(self, capacity: int, keep: int) -> Iterator[list[tuple[int, int, int]]]:
        """Whole windows until at most `keep` ids are left, or less than a window: the item that was
        the longest of the unused ones is the seed; its neighbours follow in order of their scores as long as they fit whole, and the best
        one that is left is cut to fill the gap. Items without a score come last."""
        order, at, indexed = np.argsort(-self.left, kind="stable"), 0, len(self.left)
        while (total := int(self.left.sum())) >= capacity and total > keep:
            while not self.left[order[at]]:
                at += 1
            if 2 * (left := int(np.count_nonzero(self.left))) < indexed:
                self._thin()
                indexed = left
            score = self.scores(order[at])
            window = [self.take(order[at], capacity)]
            gap = capacity - window[0][2]
            while gap:
                open_ = self.left > 0
                fits = open_ & (self.left <= gap)
                window.append(self.take(int(np.argmax(np.where(fits if fits.any() else open_, score, -1.0))), gap))
                gap -= window[-1][2]
            yield window

    def _thin(self) -> None:
        """Leaves items that are given out out of the index."""
        stay = self.left[self.post] > 0
        self.starts = np.concatenate([[0], np.cumsum(stay)])[self.starts]
        self.post, self.weight = self.post[stay], self.weight[stay]

    def rest(self, capacity: int) -> Iterator[list[tuple[int, int, int]]]:
        """What is left, less than a window, in sequences of powers of two, which need no padding."""
        open_, total = [int(i) for i in np.flatnonzero(self.left)], int(self.left.sum())
        for power in reversed(range(capacity.bit_length())):
            if total >> power & 1:
                window, gap = [], 1 << power
                while gap:
                    window.append(self.take(open_[0], gap))
                    gap -= window[-1][2]
                    if not self.left[open_[0]]:
                        open_.pop(0)
                yield window


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Every id of every row of docs in one piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset). capacity is a power of two.

    A text's ids and END are cut into whole windows, which are sequences of their own, and a tail. Tails
    are packed by what their documents have in common: documents are sorted by their weightiest words (one
    that at least TOPIC documents hold, then one that two do), a range of that order is dealt to each task,
    and every `shard` documents of it have an inverted index with BM25 weights, whose counts of documents
    come from all of docs. A seed's unused neighbours fill its window; what the last ones leave goes on to
    the next shard, and at the end of a task into sequences of powers of two. So all sequences but a few for
    each task are full, and none is padded. Work is linear in the documents, as a shard's size is fixed;
    copies beyond a shard's size and hot words fill several shards and never one task, since ranges are
    cut between rows, not between words.

    A null or empty text is END alone; long texts are packed whole; repeated rows are packed as often as
    read; null ids stay null; documents without indexed words come behind all that have some; an empty
    table gives an empty result; other columns aren't looked at."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    made = materialise(features(docs, tokenizer, id_col, text_col, capacity), "features")
    n, mean = made.agg(F.count("*"), F.avg("words")).first()
    held_by = document_counts(made)
    most = max(2, int(n * MOST))
    kind = _encoder(tokenizer)[1]
    shared = made.sparkSession.sparkContext.broadcast(held_by.astype(np.float32 if n < 1 << 24 else np.float64))

    @F.pandas_udf("topic int, second int, buckets binary, weights binary")
    def indexed(buckets: pd.Series, times: pd.Series, words: pd.Series) -> pd.DataFrame:
        sizes = np.array([len(x) for x in times], np.int64)
        own, often = np.frombuffer(b"".join(buckets), "<u4"), np.frombuffer(b"".join(times), "u1").astype(np.float64)
        doc, held = np.repeat(np.arange(len(sizes)), sizes), shared.value[own].astype(np.float64)
        keep = (held >= 2) & (held <= most)
        doc, own, held, often = doc[keep], own[keep], held[keep], often[keep]
        weight = weights(often, held, words.to_numpy(np.float64)[doc], n, mean or 0.0).astype("<f4")
        cuts = np.searchsorted(doc, np.arange(len(sizes) + 1))
        return pd.DataFrame(
            {
                "topic": _weightiest(doc, own, np.where(held >= TOPIC, weight, 0), len(sizes)), "second": _weightiest(doc, own, weight, len(sizes)),
                "buckets": [own[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)], "weights": [weight[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId() << 40
        have: list[pd.DataFrame] = []

        def put(windows: Iterator[list[tuple[int, int, int]]], items: pd.DataFrame) -> pd.DataFrame:
            nonlocal at
            rows = []
            doc, tokens, tails = items.doc_id.tolist(), items.tokens.tolist(), [np.frombuffer(t, kind).astype("<u4") for t in items.ids]
            for window in windows:
                offset = 0
                for item, start, length in window:
                    rows.append((doc[item], tokens[item] - len(tails[item]) + start, length, zlib.crc32(tails[item][start : start + length]), tokens[item], 2 * at + 1, offset))
                    offset += length
                at += 1
            return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _PIECES.split(", ")]).astype({"doc_id": "Int64"})

        def packed(last: bool) -> Iterator[pd.DataFrame]:
            one = _Shard(pd.concat(have))
            have.clear()
            yield put(one.windows(capacity, 0 if last else int(one.left.sum() * CARRIED)), one.items)
            if last:
                yield put(one.rest(capacity), one.items)
                return
            on = one.items[one.left > 0].copy()
            on["size"] = one.left[one.left > 0]
            on["ids"] = [t[len(t) - n * np.dtype(kind).itemsize :] for t, n in zip(on.ids, on["size"], strict=True)]
            have.append(on)

        for b in batches:
            b = b.assign(doc_id=b.doc_id.astype("Int64"), size=[len(t) // np.dtype(kind).itemsize for t in b.ids])
            for k in range(0, len(b), shard):
                have.append(b.iloc[k : k + shard])
                if sum(map(len, have)) >= shard:
                    yield from packed(False)
        if have:
            yield from packed(True)

    rows = made.where(F.length("ids") > 0).withColumn("i", indexed("buckets", "times", "words"))
    rows = rows.select("doc_id", "tokens", "ids", "i.buckets", "i.weights", F.col("i.topic").alias("topic"), F.col("i.second").alias("second"), F.xxhash64("doc_id", "tokens", "ids").alias("tie"))
    dealt = rows.repartitionByRange("topic", "second", "tie").sortWithinPartitions("topic", "second", "tie", "doc_id")
    tails = dealt.select("doc_id", "tokens", "ids", "buckets", "weights").mapInPandas(run, _PIECES)
    whole = made.select("doc_id", "tokens", "sequence", F.posexplode("crcs").alias("k", "crc"))
    whole = whole.select(
        "doc_id", (F.col("k").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        (F.col("sequence") + 2 * F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return whole.unionByName(tails)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _weightiest(doc: np.ndarray, own: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """For each document the bucket of the greatest weight above 0 (of equal ones the lowest), or -1."""
    out = np.full(n, -1, np.int32)
    doc, own, weight = doc[weight > 0], own[weight > 0], weight[weight > 0]
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        best = np.repeat(np.maximum.reduceat(weight, first), np.diff(np.append(first, len(doc))))
        at = np.flatnonzero(weight == best)  # buckets are in order within a document
        at = at[np.concatenate([[True], doc[at][1:] != doc[at][:-1]])]
        out[doc[at]] = own[at]
    return out

"""SentencePiece encoding and decoding: piece occurrences from a suffix array, then merges by score."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
STEP_CHARS = 2_000_000
REMEMBERED = 300_000
#: Longer parts are merged one by one.
LONG = 256
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of text sorted by their next `depth` symbols at least (prefix doubling)."""
    rank, have = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        after = np.zeros_like(rank)
        after[: len(rank) - have] = rank[have:] if have < len(rank) else rank[:0]
        key = rank * (len(rank) + 2) + after
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
        rank[order] = step + 1
        have *= 2
        if have >= depth or step[-1] == len(rank) - 1:
            return order


class Codec:
    """A SentencePiece BPE model with byte fallback, a space put in front and no other normalisation."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        texts = [model.id_to_piece(i) for i in plain]
        order = sorted(range(len(plain)), key=texts.__getitem__)
        self.ids = np.array([plain[k] for k in order])
        self.texts = [texts[k] for k in order]
        self._scores = np.array([model.get_score(i) for i in range(size)])
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.longest = max(map(len, texts))
        self._shift = self.longest.bit_length()
        if any("\n" in t or SPACE in t.lstrip(SPACE) for t in texts):
            raise ValueError("pieces may hold no newline, and the space mark only at their start")
        self._chars = np.zeros((len(order), self.longest), np.uint32)
        for k, t in enumerate(self.texts):
            self._chars[k, : len(t)] = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        self._lengths = np.array([len(t) for t in self.texts])
        self._octets = [b""] * size
        for i, t in zip(plain, texts, strict=True):
            self._octets[i] = t.replace(SPACE, " ").encode()
        for b, i in self.bytes.items():
            self._octets[i] = bytes([b])
        pairs = {(ord(a) << 21) | ord(b) for t in texts for a, b in zip(t, t[1:], strict=False)}
        self._pairs = np.array(sorted(pairs), np.int64)
        self._memory: dict[str, bytes] = {}  # ids as 32-bit numbers, as in _parts
        self._parts: dict[str, bytes] = {}

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of all pieces in text as (start, length, id), sorted by position. Every
        piece narrows its range of the suffix array symbol by symbol, all pieces at once."""
        symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        order = suffix_array(symbols, self.longest)
        padded = np.concatenate([symbols, np.zeros(self.longest, np.uint32)])
        low, high = np.zeros(len(self.texts), np.int64), np.full(len(self.texts), len(order))
        for depth in range(self.longest):
            live = np.flatnonzero((self._lengths > depth) & (low < high))
            if not len(live):
                break
            want = self._chars[live, depth]
            bounds = []
            for above in (False, True):
                a, b = low[live], high[live]
                while (a < b).any():
                    mid = (a + b) // 2
                    at = padded[order[np.minimum(mid, len(order) - 1)] + depth]
                    right = (a < b) & ((at <= want) if above else (at < want))
                    b = np.where((a < b) & ~right, mid, b)
                    a = np.where(right, mid + 1, a)
                bounds.append(a)
            low[live], high[live] = bounds
        count = high - low
        piece = np.repeat(np.arange(len(count)), count)
        start = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
        by_place = np.lexsort((self._lengths[piece], start))
        return start[by_place], self._lengths[piece][by_place], self.ids[piece][by_place]

    def _learn(self, chunks: list[str]) -> None:
        """Chunks fall apart where no piece has these two symbols side by side; the distinct parts are
        indexed and merged."""
        text = "\n".join(chunks)
        symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pair = (symbols[:-1] << 21) | symbols[1:]
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        apart = np.flatnonzero(self._pairs[at] != pair) + 1
        ends = np.cumsum([len(c) + 1 for c in chunks]) - 1
        cuts = np.unique(np.concatenate([[0], apart, ends, ends[:-1] + 1])).tolist()  # a newline is a part by itself
        parts = [text[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
        known = self._parts
        new = list({p for p in parts if p not in known})
        if new:
            known.update(zip(new, self._encode_parts(new), strict=True))
        ids = [known[p] for p in parts]
        upto = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        flat = b"".join(ids)
        first = np.searchsorted(cuts, np.concatenate([[0], ends[:-1] + 1]))
        last = np.searchsorted(cuts, ends)
        self._memory.update((c, flat[x:y]) for c, x, y in zip(chunks, upto[first].tolist(), upto[last].tolist(), strict=True))

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        text = "\n".join(parts)
        start, length, ids = self.edges(text)
        keys = (start << self._shift) | length  # sorted, as edges are

        def found(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """ids of the spans a..b, -1 where there is no edge."""
            want = (a << self._shift) | (b - a)
            at = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
            return np.where((b - a <= self.longest) & (keys[at] == want), ids[at], -1) if len(keys) else np.full(len(a), -1)

        sizes = np.array([len(p) for p in parts])
        firsts = np.cumsum(sizes + 1) - sizes - 1
        short = np.flatnonzero(sizes <= LONG)
        begin, end, part = self._rounds(firsts[short], sizes[short], short, found)
        for k in np.flatnonzero(sizes > LONG):
            x, y = self._relax(int(firsts[k]), int(firsts[k] + sizes[k]), found)
            begin, end, part = np.append(begin, x), np.append(end, y), np.append(part, np.full(len(x), k))
        order = np.argsort(begin)
        begin, end, part = begin[order], end[order], part[order]
        own = found(begin, end)
        missing = np.flatnonzero(own < 0)
        octets = [[self.bytes[x] for x in text[a:b].encode("utf-8", "surrogatepass")] for a, b in zip(begin[missing].tolist(), end[missing].tolist(), strict=True)]
        width = np.ones(len(own), np.int64)
        width[missing] = [len(x) for x in octets]
        flat = np.repeat(own, width).astype(np.int32)
        flat[flat < 0] = [x for some in octets for x in some]
        bounds = (4 * np.concatenate([[0], np.cumsum(np.bincount(part, width, len(parts)).astype(np.int64))])).tolist()
        raw = flat.tobytes()
        return [raw[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]

    def _rounds(self, firsts: np.ndarray, sizes: np.ndarray, names: np.ndarray, found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols (begin, end, part) after all merges. Every round makes one merge in each part that
        still has one: its best pair of neighbours, the leftmost among equals."""
        part = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.repeat(firsts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        end, done = begin + 1, []

        def pairs(at: np.ndarray) -> np.ndarray:
            """Score of symbol `at` with the next one; -inf at a part's end or without an edge."""
            out = np.full(len(at), -np.inf)
            ok = np.flatnonzero(at + 1 < len(part))
            ok = ok[part[at[ok]] == part[at[ok] + 1]]
            piece = found(begin[at[ok]], end[at[ok] + 1])
            out[ok] = np.where(piece < 0, -np.inf, self._scores[piece])
            return out

        best_next = pairs(np.arange(len(part)))
        while len(part):
            head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            top = np.maximum.reduceat(best_next, head)
            ended = np.repeat(top == -np.inf, np.diff(np.append(head, len(part))))
            if ended.any():
                done.append((begin[ended], end[ended], names[part[ended]]))
                begin, end, part, best_next = begin[~ended], end[~ended], part[~ended], best_next[~ended]
                continue
            at = np.flatnonzero(best_next == np.repeat(top, np.diff(np.append(head, len(part)))))
            at = at[np.concatenate([[True], part[at[1:]] != part[at[:-1]]])]
            end[at] = end[at + 1]
            keep = np.ones(len(part), bool)
            keep[at + 1] = False
            begin, end, part, best_next = begin[keep], end[keep], part[keep], best_next[keep]
            at = at - np.arange(len(at))  # one symbol went in each part before
            left = at[at > 0] - 1
            left = left[part[left] == part[left + 1]]
            best_next[at], best_next[left] = pairs(at), pairs(left)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 3

    def _relax(self, first: int, last: int, found) -> tuple[list[int], list[int]]:
        """Symbols (begins, ends) of one long part after all merges, by an agenda: as _rounds, in
        n log n steps."""
        span = np.arange(first, last)
        edge = {}
        for n in range(2, self.longest + 1):
            ids = found(span[: len(span) - n + 1], span[: len(span) - n + 1] + n)
            some = np.flatnonzero(ids >= 0)
            edge.update(zip(((span[some] << self._shift) | n).tolist(), self._scores[ids[some]].tolist(), strict=True))
        end = list(range(first + 1, last + 1))  # by start of a symbol; 0 once it is merged away
        before = list(range(first - 1, last - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int, c: int) -> None:
            score = edge.get((a << self._shift) | (c - a)) if c - a <= self.longest else None
            if score is not None:
                heapq.heappush(agenda, (-score, a, b, c))

        for a in range(first, last - 1):
            offer(a, a + 1, a + 2)
        while agenda:
            _, a, b, c = heapq.heappop(agenda)
            if end[a - first] != b or end[b - first] != c:
                continue
            end[a - first], end[b - first] = c, 0
            if c < last:
                before[c - first] = a
                offer(a, c, end[c - first])
            if a > first:
                offer(before[a - first], a, c)
        begins = [first + k for k, e in enumerate(end) if e]
        return begins, [end[a - first] for a in begins]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """Pieces hold the space mark at their start only, so no merge crosses into the next mark."""
        return _CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text; the distinct chunks of a batch are one indexed text."""
        out, at = [], 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= STEP_CHARS):
                size += len(texts[upto])
                upto += 1
            cut = [self._chunks(t) for t in texts[at:upto]]
            for memory in (self._memory, self._parts):
                if len(memory) > REMEMBERED:
                    memory.clear()
            known = self._memory
            new = list({c for chunks in cut for c in chunks if c not in known})
            if new:
                self._learn(new)
            out += [np.frombuffer(b"".join([known[c] for c in chunks]), np.int32) for chunks in cut]
            at = upto
        return out

    def decode(self, ids) -> str:
        """The text of ids: the inverse of encode, but that a literal space mark becomes a space."""
        octets = self._octets
        text = b"".join([octets[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(text: Column, model: str) -> Column:
    """Array of ids of a text column; null gives an empty array, as an empty text does."""

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(codec(model).encode(s.tolist()), dtype=object)

    return of(F.coalesce(text, F.lit("")))


def decode(ids: Column, model: str) -> Column:
    """Text of an array of ids; null gives an empty text."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([codec(model).decode(x.tolist()) for x in s], dtype=object)

    return of(F.coalesce(ids, F.expr("cast(array() as array<int>)")))


def coded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs as (doc_id, n_ids, ids_crc32, round_trip): the text is encoded, its ids are
    counted and summed up by CRC-32 (little-endian unsigned 32-bit), and decoded again; round_trip tells
    whether the text came back. One pass in one worker, so ids never cross to the JVM.

    A null text counts as empty (no ids, round trip true); repeated rows come back as often as read, null
    ids stay null; an empty table gives an empty result; other columns aren't looked at. A literal space
    mark in a text decodes to a space: round_trip is false there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model)
        for b in batches:
            ids = own.encode(b.text.tolist())
            yield pd.DataFrame(
                {
                    "doc_id": b.doc_id.astype("Int64"),
                    "n_ids": np.array([len(x) for x in ids], np.int64),
                    "ids_crc32": np.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], np.int64),
                    "round_trip": np.array([own.decode(x.tolist()) == t for x, t in zip(ids, b.text, strict=True)], bool),
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")

"""LM scoring: a bigram model whose counts live in a log-frequency Bloom filter."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import discard, materialise

STEP_BYTES = 2_000_000
FLUSH = 3_000_000
#: Tokens whose distinct hashes ask the shards together: more ask for less in all, and a task holds more.
BATCH = 1_000_000
#: Tokens of all texts for each shard, at most, where texts are learnt and scored in one pass.
SHARD = 2_000_000
#: Hashes that are set or probed in a part of the filter together.
PIECE = 1 << 17
#: Probes of an entry: of level 1, which decides whether an n-gram is there at all, and of further levels.
FIRST_PROBES, PROBES = 12, 5
#: With half of the bits set, so many of the pairs that were never seen are taken for pairs seen once. Of V
#: words a context has V * FALSE false successors; its total is raised by as many, so it stays a probability.
FALSE = 0.5**FIRST_PROBES
PRIOR = 30.0
#: A node takes filter and vocabulary as files up to this size; beyond it they stay sharded.
MOST_BYTES = 1 << 30
#: Least counts of the levels: powers of the fourth root of two (1 to 6 are exact). A count's level is the last that it reaches.
LEVELS = np.unique(np.floor(2.0 ** (np.arange(200) / 4))).astype(np.int64)
#: What a level stands for: the middle of its range, in ratio.
MIDDLE = np.concatenate([[0.0], np.sqrt(LEVELS[:-1] * (LEVELS[1:] - 1.0)), [float(LEVELS[-1])]])
_ONE = np.ones(1, np.uint64)  # a plain 1 beside uint64 would make floats
SEED = 7


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


END = _mixed(np.array([1], np.uint64))[0]


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes (XXH64) of the lower-cased words of all texts, each text followed by END, and the
    number of tokens of each text. Octets are lowered and split, so A-Z and ASCII white space alone."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    words = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(split), repeat(SEED)), np.uint64, int(sizes.sum()))
    out = np.full(len(words) + len(texts), END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), sizes)] = words
    return out, sizes + 1


def _portions(texts: pd.Series) -> Iterator[list[str]]:
    have, size = [], 0
    for t in texts:
        have.append(t)
        size += 4 * len(t) if not t.isascii() else len(t)
        if size > STEP_BYTES:
            yield have
            have, size = [], 0
    if have:
        yield have


def _before(words: np.ndarray) -> np.ndarray:
    return np.concatenate([_ONE * END, words[:-1]])  # a text's first token follows the END before it


def bigrams(words: np.ndarray) -> np.ndarray:
    return _mixed(_before(words) * np.uint64(0x9E3779B97F4A7C15) + words)


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often each is there. They are sorted in place: an order beside them
    would take as much room again, and twice the time."""
    hashes.sort()
    first = _firsts(hashes)
    return hashes[first], np.diff(first, append=len(hashes))


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = _firsts(hashes)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def _walk(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the probes for entry (hash, level)."""
    a = _mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    return a, _mixed(a) | np.uint64(1)


def _bit(a: np.ndarray, size) -> np.ndarray:
    return ((a >> np.uint64(32)) * size) >> np.uint64(32)


def _probes(level: int) -> int:
    return FIRST_PROBES if level == 1 else PROBES


def _filter(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Bloom filter of the entries (hash, 1), ..., (hash, level of its count), of which half the bits are set."""
    levels = np.searchsorted(LEVELS, counts, "right")
    probes = len(levels) * FIRST_PROBES + int((levels - 1).sum()) * PROBES
    size = max(64, int(probes / np.log(2)) // 8 * 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = hashes[levels >= level]
        for i in range(0, len(own), PIECE):
            a, step = _walk(own[i : i + PIECE], level)
            for _ in range(_probes(level)):
                bits[_bit(a, np.uint64(size)).astype(np.int64)] = True
                a = a + step
    return np.packbits(bits, bitorder="little").tobytes()


def _levels(hashes: np.ndarray, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Level of each hash, 0 if it isn't there: level 1, 2, ... is probed until one is missing. bits:
    octets of all parts of the filter; starts, sizes: of the hash's own part, in octets and bits."""
    out, alive = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
    for level in range(1, len(LEVELS) + 1):
        a, step = _walk(hashes[alive], level)
        for _ in range(_probes(level)):
            place = _bit(a, sizes[alive])
            hit = np.flatnonzero((bits[starts[alive] + (place >> np.uint64(3)).view(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
            if len(hit) < len(alive):
                alive, a, step = alive[hit], a[hit], step[hit]
            a = a + step
        if not len(alive):
            break
        out[alive] = level
    return out


def _count(batches: Iterator[pd.DataFrame], shard_bits: int) -> Iterator[pd.DataFrame]:
    """Per shard of the hashes: sorted hashes and counts of a few million tokens each time."""
    have: list[list[np.ndarray]] = [[], []]
    for b in _with_last(batches):
        for texts in _portions(b.text) if b is not None else ():
            words, _ = tokens(texts)
            have[0].append(words)
            have[1].append(bigrams(words))
        if have[0] and (b is None or sum(map(len, have[0])) > FLUSH):
            for kind in (0, 1):
                joined, have[kind] = np.concatenate(have[kind]), []
                hashes, counts = _counted(joined)
                shards = hashes >> np.uint64(64 - shard_bits)
                cuts = _firsts(shards)
                rows = [(int(shards[a]), kind, hashes[a:z].tobytes(), counts[a:z].astype("<u4").tobytes()) for a, z in zip(cuts, [*cuts[1:], len(hashes)], strict=True)]
                yield pd.DataFrame(rows, columns=["shard", "kind", "hashes", "counts"])


def _with_last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _gather(g: pd.DataFrame) -> pd.DataFrame:
    """One shard: its words with their exact counts, and the filter of its words and bigrams."""
    kinds = []
    for kind in (0, 1):
        own = g[g.kind == kind]
        kinds.append(_summed(np.frombuffer(b"".join(own.hashes), "<u8"), np.frombuffer(b"".join(own.counts), "<u4").astype(np.int64)))
    (words, often), (pairs, pairs_often) = kinds
    made = _filter(np.concatenate([words, pairs]), np.concatenate([often, pairs_often]))
    return pd.DataFrame([(int(g.shard.iloc[0]), words.tobytes(), often.astype("<u8").tobytes(), made, int(often.sum()), len(words), len(made))], columns=_PARTS.replace(" binary", "").replace(" long", "").replace(" int", "").split(", "))


_PARTS = "shard int, words binary, often binary, bits binary, n long, v long, octets long"


@dataclass
class Model:
    """parts: a row per shard (the top bits of a hash); N tokens and V distinct words were learnt from."""

    parts: DataFrame
    shard_bits: int
    n: int
    v: int
    octets: int
    files: dict[str, str] = field(default_factory=dict)


def _bits(shards: float) -> int:
    return int(np.clip(np.ceil(np.log2(max(1, shards))), 4, 30))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts over all texts of docs (null: empty). Batches are counted where they are read, the
    shuffle moves sorted hashes and counts, and each shard makes its part of the filter; the number
    of shards follows the number of input partitions, so a shard's size doesn't grow. Where there are
    more shards than distinct hashes in a batch, a batch sends a row for each of its hashes at most."""
    shard_bits = _bits(4 * docs.rdd.getNumPartitions())
    counted = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(lambda x: _count(x, shard_bits), "shard int, kind int, hashes binary, counts binary")
    parts = materialise(counted.groupBy("shard").applyInPandas(_gather, _PARTS), "lm")
    total = parts.agg(F.sum("n"), F.sum("v"), F.sum("octets")).first()
    return Model(parts, shard_bits, total[0] or 0, total[1] or 0, (total[2] or 0) + 16 * (total[1] or 0))


def _ship(model: Model) -> None:
    """Lay the parts out in three files and send these to every node, where workers map them: the
    words' hashes (sorted, as shards are), their counts, and the filter. One part at a time passes
    through the driver."""
    spark = model.parts.sparkSession
    place, tag = tempfile.mkdtemp(prefix="tickframe-lm-"), uuid.uuid4().hex[:12]
    names = {k: f"{k}-{tag}.bin" for k in ("words", "often", "bits")}
    starts, sizes, at = np.zeros(1 << model.shard_bits, np.int64), np.zeros(1 << model.shard_bits, np.uint64), 0
    files = {k: open(os.path.join(place, n), "wb") for k, n in names.items()}
    for row in model.parts.select("shard", "words", "often", "bits").orderBy("shard").toLocalIterator():
        for k, f in files.items():
            f.write(row[k])
        starts[row["shard"]], sizes[row["shard"]] = at, 8 * len(row["bits"])
        at += len(row["bits"])
    for k, f in files.items():
        f.write(b"" if f.tell() else bytes(8))
        f.close()
        spark.sparkContext.addFile(os.path.join(place, names[k]))
    model.files = names | {"starts": starts.tobytes(), "sizes": sizes.tobytes()}


def _mapped(name: str, kind: str) -> np.ndarray:
    with open(SparkFiles.get(name), "rb") as f:
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), kind)


def _place(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.minimum(np.searchsorted(words, hashes), max(0, len(words) - 1))


def _known(hashes: np.ndarray, words: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Exact counts: 0 where a hash isn't among the sorted ones."""
    at = _place(hashes, words)
    return np.where(words[at] == hashes, often[at], 0).astype(np.int64) if len(words) else np.zeros(len(hashes), np.int64)


def _logs(c_pair, c_before, c_word, n: int, v: int, least):
    """The smoothed probability: the pair's count, with PRIOR words' worth of the unigrams (which are
    smoothed by one) mixed in. Counts of pairs and words are estimates: a pair's is held to its context's
    (which is exact), and a word's share to one. The false successors that a context is expected to have
    are in its total, so over all words it sums to one but for the steps between levels and the chance of
    having more or fewer of these, some per cent. Columns or arrays, with their function `least`."""
    return (least(c_pair, c_before) + PRIOR * least((c_word + 1.0) / (n + v + 1.0), 0 * c_word + 1.0)) / (c_before + v * FALSE * least(c_before + 0.0, 0 * c_before + 1.0) + PRIOR)


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _sums(sizes: np.ndarray, at: np.ndarray, c: np.ndarray, estimated: np.ndarray, pairs: np.ndarray, pair_at: np.ndarray, before: np.ndarray, n: int, v: int) -> tuple[np.ndarray, ...]:
    """Known tokens, base score and score of each text. c, estimated: of the distinct words, at: each token's
    place among these; pairs, pair_at: likewise; before: counts of the contexts."""
    first = np.cumsum(sizes) - sizes
    p = np.log10(_logs(pairs[pair_at], before, estimated[at], n, v, np.minimum))
    return np.add.reduceat((c > 0)[at].astype(np.int64), first), np.add.reduceat(np.log10((c + 1.0) / (n + v + 1.0))[at], first), np.add.reduceat(p, first)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """Every row of docs as (doc_id, n_tokens, n_known, base_score, score); null texts count as empty
    and have the end token alone; repeated rows come back as often as read, null ids stay null; an
    empty table gives an empty result, and an empty training set a uniform model.

    base_score uses exact counts of words, held by 64-bit hashes. score uses them for contexts, and the
    filter for pairs and for the words that smooth them; a filter has false hits and misses none, so no count is estimated below its level. Up to
    most_bytes the model goes to every node; a larger one stays in its shards, and the distinct
    hashes of the texts are sent there."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if model.octets > most_bytes:
        return _score_sharded(rows, model)
    if not model.files:
        _ship(model)
    files, n, v, shift = model.files, model.n, model.v, np.uint64(64 - model.shard_bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, often, bits = _mapped(files["words"], "<u8"), _mapped(files["often"], "<u8"), _mapped(files["bits"], "u1")
        words, often = (words, often) if v else (words[:0], often[:0])
        starts, sizes = np.frombuffer(files["starts"], np.int64), np.frombuffer(files["sizes"], np.uint64)

        def estimate(hashes: np.ndarray) -> np.ndarray:
            shard = (hashes >> shift).astype(np.int64)
            return MIDDLE[_levels(hashes, bits, starts[shard], sizes[shard])]

        levels = np.full(len(words), 255, np.uint8)  # of the words that this task has met: frequent ones have the most levels to probe

        def estimate_words(hashes: np.ndarray, c: np.ndarray) -> np.ndarray:
            at, there = _place(hashes, words), c > 0
            out = np.full(len(hashes), 255, np.int64)
            out[there] = levels[at[there]]
            new = np.flatnonzero(out == 255)
            shard = (hashes[new] >> shift).astype(np.int64)
            out[new] = _levels(hashes[new], bits, starts[shard], sizes[shard])
            levels[at[there]] = out[there]
            return MIDDLE[out]

        for b in batches:
            known, exact, base, own = [], [], [], []
            for texts in _portions(b.text):
                seq, sizes_of = tokens(texts)
                distinct, at = np.unique(seq, return_inverse=True)
                c = _known(distinct, words, often)
                estimated = estimate_words(distinct, c)
                pairs, pair_at = np.unique(bigrams(seq), return_inverse=True)
                before = np.concatenate([_known(np.array([END]), words, often), c[at][:-1]])
                sums = _sums(sizes_of, at, c, estimated, estimate(pairs), pair_at, before, n, v)
                for held, x in zip((known, exact, base, own), (sizes_of, *sums), strict=True):
                    held.append(x)
            out = [np.concatenate(x) if x else np.zeros(0) for x in (known, exact, base, own)]
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "n_tokens": out[0].astype(np.int64), "n_known": out[1].astype(np.int64), "base_score": out[2], "score": out[3]})

    return rows.mapInPandas(run, _SCORES)


def _planes(x: np.ndarray) -> bytes:
    """First the least octets of all numbers and so on, so that the upper ones, mostly zero, compress."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _numbers(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _gaps(hashes: np.ndarray) -> bytes:
    return _planes(np.diff(hashes, prepend=np.uint64(0)))


def _from_gaps(x: bytes) -> np.ndarray:
    return np.cumsum(_numbers(x, "<u8"), dtype=np.uint64)


_SEEN = "batch long, learn boolean, tokens long, ids binary, there binary, sizes binary, words binary, at binary"
_ASKED = "shard int, batch long, words binary, pairs binary, words_often binary, pairs_often binary"
_ANSWERS = "batch long, shard int, words binary, pairs binary, often binary, n long, v long"


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each BATCH tokens of texts to learn from, or of others."""
    batch, held = TaskContext.get().partitionId() << 40, {True: [], False: []}
    for b in _with_last(batches):
        for learn, have in held.items():
            own, at = b[b.learn == learn] if b is not None else None, 0
            for texts in _portions(own.text) if b is not None else ():
                have.append((own.doc_id.iloc[at : at + len(texts)].astype("Int64"), *tokens(texts)))
                at += len(texts)
                if sum(len(x[1]) for x in have) > BATCH:
                    yield _seen_row(batch, learn, have)
                    batch += 1
            if b is None and have:
                yield _seen_row(batch, learn, have)
                batch += 1


def _seen_row(batch: int, learn: bool, have: list) -> pd.DataFrame:
    """Ids and sizes of the texts, their distinct words, the most frequent first, and each token's place among these."""
    ids, seqs, sizes = zip(*have, strict=True)
    have.clear()
    every = pd.concat(ids)
    words, at, often = np.unique(np.concatenate(seqs), return_inverse=True, return_counts=True)
    order = np.argsort(-often, kind="stable")
    place = np.empty(len(words), "<u4")
    place[order] = np.arange(len(words))
    packed = pa.compress(_planes(place[at]), codec="zstd", asbytes=True)
    return pd.DataFrame([(batch, learn, len(at), every.fillna(0).to_numpy(np.int64).tobytes(), every.notna().to_numpy(bool).tobytes(), np.concatenate(sizes).tobytes(), words[order].tobytes(), packed)], columns=["batch", "learn", "tokens", "ids", "there", "sizes", "words", "at"])


def _tokens_of(words: bytes, sizes: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.frombuffer(sizes, np.int64)
    return np.frombuffer(words, "<u8"), sizes, _numbers(pa.decompress(at, decompressed_size=4 * int(sizes.sum()), codec="zstd", asbytes=True), "<u4")


def _asked(batches: Iterator[pd.DataFrame], shard_bits: int) -> Iterator[pd.DataFrame]:
    """Per shard of the hashes: the distinct words and pairs of a row of _seen, sorted, and how often each is there, if they are learnt."""
    for b in batches:
        for row in b.itertuples():
            words, _, at = _tokens_of(row.words, row.sizes, row.at)
            pairs, pairs_often = _counted(bigrams(words[at]))
            order = np.argsort(words)
            kinds = (words[order], np.bincount(at, minlength=len(words))[order]), (pairs, pairs_often)
            shards = [x >> np.uint64(64 - shard_bits) for x, _ in kinds]
            present = np.union1d(*(x[_firsts(x)] for x in shards))
            cuts = [[*np.searchsorted(x, present), len(x)] for x in shards]
            rows = []
            for k, shard in enumerate(present):
                own = [(x[c[k] : c[k + 1]], often[c[k] : c[k + 1]]) for (x, often), c in zip(kinds, cuts, strict=True)]
                rows.append((int(shard), row.batch, *(_gaps(x) for x, _ in own), *(_planes(often.astype("<u4")) if row.learn else b"" for _, often in own)))
            yield pd.DataFrame(rows, columns=["shard", "batch", "words", "pairs", "words_often", "pairs_often"])


def _placed(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the place of each hash among them: np.unique's inverse in half the room."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    at = np.empty(len(hashes), np.uint32)
    at[order] = np.cumsum(first, dtype=np.uint32) - np.uint32(1)
    return hashes[first], at


def _distinct(asked: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes that are asked for, how often those that are learnt are there, the place of each asked
    among the distinct ones, and where each row of asked ends."""
    sizes = asked[kind].str.len().to_numpy(np.int64) // 8
    distinct, at = _placed(np.concatenate([_from_gaps(x) for x in asked[kind]]))
    often = np.concatenate([_numbers(x, "<u4") if len(x) else np.zeros(size, "<u4") for x, size in zip(asked[f"{kind}_often"], sizes, strict=True)])
    return distinct, np.bincount(at, often, len(distinct)).astype(np.int64), at, np.cumsum(sizes)


def _probed(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Level of each hash in one part of the filter, a piece of the hashes at a time."""
    starts, sizes, out = np.zeros(PIECE, np.int64), np.full(PIECE, 8 * len(bits), np.uint64), np.zeros(len(hashes), np.uint8)
    for i in range(0, len(hashes), PIECE):
        own = hashes[i : i + PIECE]
        out[i : i + PIECE] = _levels(own, bits, starts[: len(own)], sizes[: len(own)])
    return out


def _answered(asked: pd.DataFrame, part: pd.DataFrame | None) -> pd.DataFrame:
    """One shard: exact counts of words, and levels of words and pairs, for the hashes that are asked for, in
    their order. The filter is the one of part or, without it, is made of what is learnt. Each distinct
    hash is probed once."""
    kinds = [_distinct(asked, k) for k in ("words", "pairs")]
    (words, often, *_), (pairs, pairs_often, *_) = kinds
    n, v = int(often.sum()), int((often > 0).sum())
    if part is None:
        bits = _filter(*(np.concatenate([x[often > 0], y[pairs_often > 0]]) for x, y in ((words, pairs), (often, pairs_often))))
    elif len(part):
        bits = part.bits.iloc[0]
        often = _known(words, np.frombuffer(part.words.iloc[0], "<u8"), np.frombuffer(part.often.iloc[0], "<u8"))
    else:
        bits = bytes(8)
    bits = np.frombuffer(bits, np.uint8)
    out = asked[["batch", "shard"]].copy()
    for name, (distinct, _, at, ends) in zip(("words", "pairs"), kinds, strict=True):
        found = _probed(distinct, bits)[at]
        out[name] = [x.tobytes() for x in np.split(found, ends[:-1])]
    out["often"] = [_planes(x) for x in np.split(often.astype("<u8")[kinds[0][2]], kinds[0][3][:-1])]
    first = np.arange(len(out)) == 0
    return out.assign(n=np.where(first, n, 0), v=np.where(first, v, 0))


def _summed_up(seen: DataFrame, got: DataFrame, n: int, v: int) -> DataFrame:
    def summed(seen: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        row, got = seen.iloc[0], got.sort_values("shard")
        words, sizes, at = _tokens_of(row["words"], row["sizes"], row["at"])
        order, (c, estimated) = np.argsort(words), np.zeros((2, len(words)))
        c[order] = np.concatenate([_numbers(x, "<u8") for x in got.often])
        estimated[order] = MIDDLE[np.frombuffer(b"".join(got.words), np.uint8)]
        _, pair_at = np.unique(bigrams(words[at]), return_inverse=True)
        before = np.concatenate([c[words == END], c[at[:-1]]])
        known, base, own = _sums(sizes, at, c, estimated, MIDDLE[np.frombuffer(b"".join(got.pairs), np.uint8)], pair_at, before, n, v)
        ids = pd.Series(np.frombuffer(row["ids"], np.int64)).astype("Int64").where(np.frombuffer(row["there"], bool))
        return pd.DataFrame({"doc_id": ids, "n_tokens": sizes, "n_known": known, "base_score": base, "score": own})

    out = materialise(seen.groupBy("batch").cogroup(got.groupBy("batch")).applyInPandas(summed, _SCORES), "scores")
    discard(seen)
    return out


def _score_sharded(rows: DataFrame, model: Model) -> DataFrame:
    """The same scores with the model left where it is: BATCH tokens at a time ask the shards for their
    distinct hashes, packed, and get an octet for each (and a word's count) in the same order."""
    bits = model.shard_bits
    seen = materialise(rows.withColumn("learn", F.lit(False)).mapInPandas(_seen, _SEEN), "tokens")
    asked = seen.mapInPandas(lambda x: _asked(x, bits), _ASKED)
    got = asked.groupBy("shard").cogroup(model.parts.groupBy("shard")).applyInPandas(lambda a, part: _answered(a, part) if len(a) else pd.DataFrame(columns=[x.split()[0] for x in _ANSWERS.split(", ")]), _ANSWERS)
    return _summed_up(seen, got, model.n, model.v)


def train_and_score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """score(docs, train(docs.where(learn))), and the number of tokens learnt from, for models of any size (the
    scores differ only in the filter's false hits, where train makes another number of shards). Texts are
    read and split once: a shard of the hashes gets what is learnt and what is to be scored together, makes
    its part of the filter and answers from it, so no model is sent to a node, and no task needs more of it
    than one part, whose size doesn't grow."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    seen = materialise(rows.mapInPandas(_seen, _SEEN), "tokens")
    bits = _bits((seen.agg(F.sum("tokens")).first()[0] or 0) / SHARD)
    got = materialise(seen.mapInPandas(lambda x: _asked(x, bits), _ASKED).groupBy("shard").applyInPandas(lambda a: _answered(a, None), _ANSWERS), "levels")
    n, v = (x or 0 for x in got.agg(F.sum("n"), F.sum("v")).first())
    out = _summed_up(seen, got, n, v)
    discard(got)
    return out, n

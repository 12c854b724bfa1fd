"""SimHash near-dedup: exact pairs within a Hamming radius by a forest of vantage-point trees, and the
pairs of a Jaccard similarity that lie beyond the radius by a prefix join."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.components import connected_components, smallest_of_component
from tickframe.llm.storage import discard, gathered, materialise, sampled

SEED = 42
BINS = 128
#: Shingles that the order of the prefix join knows as common, shingles counted by one task at a time, and bits of the map of linked texts.
COMMON, COUNTED_AT_ONCE, ID_BITS = 500_000, 1 << 22, 1 << 22
LEAF = 256
#: Room for the rounding of a similarity times a count.
EPS = 1e-9


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of each run of `width` words of the lower-cased text; of all words where there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    ends = list(accumulate([len(w) + 1 for w in words]))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[width - 1 :], strict=False)], "<u8")


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint, as a signed long: the bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_of(text: str, width: int) -> int:
    return majority_bits(shingle_hashes(text, width))


def sketch_of(hashes: np.ndarray) -> bytes:
    """One-permutation min-hash: for each of BINS ranges of the hashes the low octet of its smallest
    one, and whether the range is empty."""
    values = np.zeros(2 * BINS, np.uint8)
    bins, first = np.unique((hashes := np.sort(hashes)) >> np.uint64(64 - BINS.bit_length() + 1), return_index=True)
    values[bins.astype(np.int64)] = (hashes[first] & np.uint64(255)).astype(np.uint8)
    values[BINS + bins.astype(np.int64)] = 1
    return values[:BINS].tobytes() + np.packbits(values[BINS:]).tobytes()


def prefix_of(hashes: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of n distinct hashes (sorted) the first n - ceil(similarity * n) + 1 in the order of (count, hash).
    Two sets of that Jaccard similarity share at least ceil(similarity * n) hashes of either, and so one
    of their prefixes; this holds for any order, and rare hashes first keep the shared ones few."""
    n = len(hashes)
    if not n:
        return hashes
    seen = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        seen = np.where(common[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, seen))[: n - math.ceil(similarity * n - EPS) + 1]]


def parity_of(hashes: np.ndarray) -> bytes:
    """Whether each of about 2 to 4 bins for a hash holds an odd number of the distinct hashes. A bin whose
    parity differs between two sets holds a hash that only one of them has, so the number of such bins is
    a lower bound of the symmetric difference, whatever the hashes are."""
    bins = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """The lower bound of the symmetric difference of two sets by their parities; the finer one is folded."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


class Forest:
    """Vantage-point trees, one for each of `len(masks)` disjoint groups of bits.

    A pair within `radius` differs by at most radius // trees in one of the groups, so the tree of
    that group, under the Hamming distance over its bits, needs only that smaller search radius r.
    A node with vantage point p and bound mu sends x inside if d(x,p) <= mu + r and outside if
    d(x,p) > mu. By the triangle inequality two points within r always share a child: either both
    lie within mu + r, or one lies beyond it and then the other lies beyond mu. Points in the
    overlap belong to both shards; all others are pruned from one of them."""

    def __init__(self, sample: np.ndarray, radius: int, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        cuts = [64 * i // trees for i in range(trees + 1)]
        self.masks = [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.reach, self.depth = radius // trees, depth
        self.nodes = [self._fit(sample & m, m, rng) for m in self.masks]

    def _fit(self, sample: np.ndarray, mask: np.uint64, rng) -> tuple[np.ndarray, np.ndarray]:
        size = (1 << self.depth) - 1
        points, bounds, subsets = np.zeros(size, np.uint64), np.zeros(size, np.int64), {0: sample}
        width = int(np.bitwise_count(mask))
        for k in range(size):
            own = subsets.pop(k)
            best = self._split(own, width, rng) if len(own) else (0.0, rng.integers(0, 2**63, dtype=np.uint64) & mask, width // 2)
            points[k], bounds[k] = best[1], best[2]
            if 2 * k + 2 < size:
                d = np.bitwise_count(own ^ best[1]).astype(np.int64)
                subsets[2 * k + 1], subsets[2 * k + 2] = own[d <= best[2] + self.reach], own[d > best[2]]
        return points, bounds

    def leaves(self, prints: np.ndarray, tree: int, most: int = LEAF, seed: int = 1) -> Iterator[np.ndarray]:
        """Row numbers by leaf: a shard of a tree is split on as its nodes are, by vantage points of its
        own, while that saves comparisons. Two points within the search radius share a leaf."""
        rng, mask = np.random.default_rng(seed), self.masks[tree]
        points, width = prints & mask, int(np.bitwise_count(mask))
        stack = [np.arange(len(prints))]
        while stack:
            own = stack.pop()
            if len(own) > most:
                cost, p, mu = self._split(points[own[rng.integers(len(own), size=1024)]], width, rng)
                d = np.bitwise_count(points[own] ^ p).astype(np.int64)
                inside, outside = own[d <= mu + self.reach], own[d > mu]
                if len(inside) ** 2 + len(outside) ** 2 < 0.9 * len(own) ** 2:
                    stack += [inside, outside]
                    continue
            yield own

    def _split(self, own: np.ndarray, width: int, rng) -> tuple[float, np.uint64, int]:
        """Of a few vantage points the one that splits best: (cost, point, bound)."""
        best = None
        for _ in range(6):
            p = own[rng.integers(len(own))]
            held = np.bincount(np.bitwise_count(own ^ p).astype(np.int64), minlength=width + self.reach + 2)
            upto = np.cumsum(held)
            inside, outside = upto[self.reach : width + self.reach + 1], len(own) - upto[: width + 1]
            cost = np.maximum(inside, outside) + 0.25 * (inside + outside)
            mu = int(np.argmin(cost))
            if best is None or cost[mu] < best[0]:
                best = (cost[mu], p, mu)
        return best

    def shards(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the shards that they belong to; a row may belong to several."""
        rows, shards = [], []
        for t, (mask, (points, bounds)) in enumerate(zip(self.masks, self.nodes, strict=True)):
            row, node = np.arange(len(prints)), np.zeros(len(prints), np.int64)
            for _ in range(self.depth):
                d = np.bitwise_count((prints[row] & mask) ^ points[node]).astype(np.int64)
                inside, outside = d <= bounds[node] + self.reach, d > bounds[node]
                row, node = np.concatenate([row[inside], row[outside]]), np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2])
            rows.append(row)
            shards.append((t << 32) + node)
        return np.concatenate(rows), np.concatenate(shards)


class Links:
    """Which rows of a shard are linked: fingerprints within `radius` bits, and, where sketches are
    given, an estimated Jaccard similarity of the shingles of at least `similarity`."""

    def __init__(self, prints: np.ndarray, radius: int, sketches: list[bytes] | None = None, similarity: float | None = None):
        self.prints, self.radius, self.similarity = prints, radius, similarity
        if similarity is not None:
            raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(prints), -1)
            self.values, self.full = raw[:, :BINS], np.unpackbits(raw[:, BINS:], axis=1).astype(bool)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Matrix of links of rows a with rows b."""
        near = np.bitwise_count(self.prints[a][:, None] ^ self.prints[b][None, :]) <= self.radius
        if self.similarity is not None:
            i, j = np.nonzero(near)
            for k in range(0, len(i), 100_000):
                near[i[k : k + 100_000], j[k : k + 100_000]] = self.alike(a[i[k : k + 100_000]], b[j[k : k + 100_000]])
        return near

    def alike(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the sketches of rows x and y, one by one, show at least the similarity."""
        both, either = self.full[x] & self.full[y], self.full[x] | self.full[y]
        return ((self.values[x] == self.values[y]) & both).sum(axis=1) >= self.similarity * either.sum(axis=1)

    def roots(self, direct: bool = False) -> np.ndarray:
        """Per row the first row of its component, or if direct the row that the walk reached it from,
        which it has a link with; itself if alone. Linear memory: blocks of comparisons, then a
        breadth-first walk over the rows that have a link."""
        n = len(self.prints)
        every, out, some = np.arange(n), np.arange(n), np.zeros(n, bool)
        step = max(1, 2_000_000 // max(1, n))
        for a in range(0, n, step):
            some[a : a + step] = self.between(every[a : a + step], every).sum(axis=1) > 1
        rest = np.flatnonzero(some)
        while len(rest):
            root, frontier, rest = rest[0], rest[:1], rest[1:]
            while len(frontier) and len(rest):
                now, frontier = frontier[:256], frontier[256:]
                links = self.between(now, rest)
                hit = links.any(axis=0)
                out[rest[hit]] = now[links.argmax(axis=0)[hit]] if direct else root
                frontier, rest = np.concatenate([frontier, rest[hit]]), rest[~hit]
        return out


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    radius: int = 4,
    trees: int = 3,
    similarity: float | None = None,
    shard_rows: int = 8192,
    max_depth: int = 16,
    sample_rows: int = 1 << 16,
    leaf_rows: int = LEAF,
) -> DataFrame:
    """Every row of docs as (doc_id, fingerprint long, component_id, text_hash): rows whose fingerprints
    differ by at most `radius` bits are linked, component_id is the smallest id reachable by links.
    With a similarity, rows are linked if and only if the Jaccard similarity of their whole sets of
    shingles (as 64-bit hashes) is at least that, whatever their fingerprints: the forest's links, less
    those that min-hash sketches estimate as less similar, are verified and group most copies; all pairs
    between these groups come by a prefix join and are verified too, but for those that a lower bound of
    their difference (parities of bins) rules out for certain. The prefixes are of the shingles that the
    fewest of all texts have. text_hash is xxhash64 of the whole text.

    Rows of one fingerprint (with a similarity, of one set of shingles) are merged first, so copies of
    any number count once; such a class goes by its fingerprint (or its set's hash), and ids only come
    back in with the answer. The forest is fitted on about `sample_rows` fingerprints (twice that at most) and routes every
    one; its depth follows the number of different ones, and it is broadcast with at most
    trees * 2**max_depth nodes of 16 bytes. Within its task a shard is split on by vantage points of its
    own down to leaves of leaf_rows, within which all pairs are compared. A shard above 4 * shard_rows is cut into blocks and its pairs of blocks go to
    separate tasks, so a task's memory is bounded and no pair is lost. Shards return one edge per
    linked row, never the pairs.

    Null or blank texts have fingerprint zero and link like others; repeated rows come back as often
    as read, and rows of one id with different texts are documents of their own; a null id links but
    never names a component (a group of nulls alone has a null component); an empty table gives an
    empty result; other columns of docs are not looked at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    common = docs.sparkSession.sparkContext.broadcast(_common(source, width) if similarity is not None else None)

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes = [shingle_hashes(t, width) for t in b.text]
            out = pd.DataFrame(
                {
                    "doc_id": b.doc_id.astype("Int64"),
                    "fp": np.array([majority_bits(h) for h in hashes], np.int64),
                    "sketch": [sketch_of(h) if similarity is not None else b"" for h in hashes],
                    "text_hash": b.text_hash,
                }
            )
            if similarity is None:
                out["key"] = out.fp
            else:
                sets = [np.unique(h) for h in hashes]
                out["key"] = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in sets], np.uint64).view("<i8")
                out["n"] = np.array([len(h) for h in sets], np.int32)
                out["parity"] = [parity_of(h) for h in sets]
                out["prefix"] = [prefix_of(h, similarity, *common.value).view("<i8") for h in sets]
            yield out

    more = ", n int, parity binary, prefix array<long>" if similarity is not None else ""
    rows = materialise(source.mapInPandas(prints, "doc_id long, fp long, sketch binary, text_hash long, key long" + more), "prints")
    of_class = [F.min(c).alias(c) for c in ("fp", "sketch", "text_hash", *(["n", "parity"] if similarity is not None else []))]
    named = rows.groupBy("key").agg(F.min("doc_id").alias("rep"), *of_class)
    named = materialise(named, "classes")
    n = named.count()
    depth = min(max_depth, max(0, math.ceil(math.log2(max(n, 1) / shard_rows))))
    sample = sampled(named.select("fp"), sample_rows, n, "fp").toPandas().fp.to_numpy(np.int64).view(np.uint64) if depth else np.zeros(0, np.uint64)
    forest = docs.sparkSession.sparkContext.broadcast(Forest(sample, radius, trees, depth))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, shard = forest.value.shards(b.fp.to_numpy(np.int64).view(np.uint64))
            yield b.iloc[row].assign(shard=shard)

    routed = materialise(named.select("key", "fp", "sketch").mapInPandas(route, "key long, fp long, sketch binary, shard long"), "shards")
    edges = blocked(routed, "shard", "key", 4 * shard_rows).groupBy("shard", "i", "j").applyInPandas(lambda g: _edges(g, forest.value, radius, similarity, leaf_rows), "src long, dst long")
    edges = materialise(edges.distinct(), "links")
    discard(routed)
    if similarity is not None:
        edges = _verified(edges, named, source, width, similarity)
        edges = edges.unionByName(_verified(_possible(_beyond(rows, connected_components(edges), similarity), named, similarity), named, source, width, similarity))
    known = smallest_of_component(named.select("key", "rep"), connected_components(edges), "key", "rep")
    known = materialise(known.select("key", "component_id"), "known")
    discard(named)
    return rows.join(known, "key").select("doc_id", F.col("fp").alias("fingerprint"), "component_id", "text_hash")


def _common(source: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that several of all texts have, sorted, with the number of these texts: the most
    frequent ones, COMMON at most (of a number of texts all its shingles or none). They only set the
    order of the prefixes, which holds for any counts.

    Each batch of texts is counted where it is read, so a shingle that all texts have is one entry of a
    batch; entries travel as packed arrays to shards of hashes, whose number follows the texts' length."""
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(6, math.ceil(math.log2(max(1, size / (6 * COUNTED_AT_ONCE)))))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                h, n = np.unique(np.concatenate([np.unique(shingle_hashes(t, width)) for t in b.text]), return_counts=True)
                shard, first = np.unique(h >> np.uint64(64 - bits), return_index=True)
                ends = [*first[1:], len(h)]
                yield pd.DataFrame(
                    {
                        "shard": shard.astype(np.int64),
                        "h": [h[s:e].tobytes() for s, e in zip(first, ends, strict=True)],
                        "n": [n[s:e].astype("<u4").tobytes() for s, e in zip(first, ends, strict=True)],
                    }
                )

    def added(g: pd.DataFrame) -> pd.DataFrame:
        h, at = np.unique(np.frombuffer(b"".join(g.h), "<u8"), return_inverse=True)
        n = np.bincount(at, np.frombuffer(b"".join(g.n), "<u4"), len(h)).astype(np.int64)
        return pd.DataFrame({"h": h[n > 1].view("<i8"), "n": n[n > 1]})

    several = source.select("text").mapInPandas(counted, "shard long, h binary, n binary").groupBy("shard").applyInPandas(added, "h long, n long")
    several = materialise(several, "common")
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = several.groupBy(level.alias("level")).count().orderBy(F.desc("level")).toPandas()
    levels = levels[levels["count"].cumsum() <= COMMON]
    hashes, counts = gathered(several.where(level >= int(levels.level.min()) if len(levels) else F.lit(False)).select("h", "n"))
    discard(several)
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _beyond(rows: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """(src, dst): pairs of classes in different components that may have the similarity by a hash that
    their prefixes share.

    Sets of x and y hashes have it if they share k (x + y) or more, k = similarity / (1 + similarity). In
    the common order of hashes the first one that they share has all others behind it in both, so as
    many must be left from there on in either: `room`, what is left less k times the own number, is at
    least k times the other's number. This keeps sets apart that share a passage behind their own rarer
    shingles. A hash that a single set or component has goes before any join of its rows, and inside a
    component no pair is made, so a group of linked copies stays linear."""
    k = similarity / (1 + similarity)
    entries = rows.select("key", "n", F.posexplode("prefix").alias("at", "h"))
    entries = entries.select("h", "key", "n", (F.col("n") - F.col("at") - k * F.col("n") + EPS).alias("room")).repartition("h")
    # the smaller set of a pair has room for its own number
    both = [F.max(F.col("room") >= k * F.col("n")).alias("_small")]
    shared = entries.groupBy("h").agg(F.min("key").alias("_a"), F.max("key").alias("_b"), *both).where("_a < _b and _small").select("h")
    entries = entries.join(shared, "h", "left_semi").join(parts.withColumnRenamed("node", "key"), "key", "left")
    entries = materialise(entries.select("h", "key", "n", "room", F.coalesce("component", "key").alias("c")).distinct(), "entries")
    shared = entries.groupBy("h").agg(F.min("c").alias("_a"), F.max("c").alias("_b")).where("_a < _b").select("h")
    entries = materialise(entries.join(shared, "h", "left_semi"), "entries")
    groups = entries.groupBy("h", "c").agg(F.min("n").alias("n"), F.max("room").alias("room"))
    left, right = (groups.select("h", *[F.col(c).alias(f"{c}_{end}") for c in ("c", "n", "room")]) for end in "ab")
    fits = (F.col("room_a") >= k * F.col("n_b")) & (F.col("room_b") >= k * F.col("n_a"))
    pairs = left.join(right, "h").where(F.col("c_a") < F.col("c_b")).where(fits).select("h", "c_a", "c_b")
    for end in "ab":
        pairs = pairs.join(entries.select("h", *[F.col(c).alias(f"{c}_{end}") for c in ("c", "key", "n", "room")]), ["h", f"c_{end}"])
    return materialise(pairs.where(fits).select(F.col("key_a").alias("src"), F.col("key_b").alias("dst")).distinct(), "pairs")


def _possible(pairs: DataFrame, named: DataFrame, similarity: float) -> DataFrame:
    """The pairs that their parities don't rule out: sets of x and y hashes have the similarity if and only
    if they differ in (x + y) (1 - similarity) / (1 + similarity) hashes at most. No pair is lost."""
    parities = named.select("key", "n", "parity")
    for end in ("src", "dst"):
        pairs = pairs.join(parities.select(*[F.col(c).alias(a) for c, a in (("key", end), ("n", f"n_{end}"), ("parity", f"parity_{end}"))]), end)

    def possible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            least = np.array([least_difference(x, y) for x, y in zip(b.parity_src, b.parity_dst, strict=True)], np.int64)
            yield b.loc[least <= (b.n_src + b.n_dst).to_numpy() * (1 - similarity) / (1 + similarity) + EPS, ["src", "dst"]]

    return pairs.mapInPandas(possible, "src long, dst long")


def _verified(pairs: DataFrame, named: DataFrame, source: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs of classes (written out) whose whole sets of shingles have the similarity. One text
    travels for each class of a pair: a map of ID_BITS bits keeps others back, and the join those that
    it lets by."""
    hashes = named.select("key", "text_hash")
    for end in ("src", "dst"):
        pairs = pairs.join(hashes.select(F.col("key").alias(end), F.col("text_hash").alias(f"text_{end}")), end)
    pairs = materialise(pairs, "pairs")
    bit = F.pmod(F.xxhash64("text_hash"), F.lit(ID_BITS)).cast("int").alias("bit")
    linked = np.zeros(ID_BITS, bool)
    linked[gathered(pairs.select(F.explode(F.array("text_src", "text_dst")).alias("text_hash")).select(bit.cast("long").alias("bit")).distinct())[0]] = True
    linked = source.sparkSession.sparkContext.broadcast(np.packbits(linked))

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.unpackbits(linked.value).astype(bool)
        for b in batches:
            yield b.loc[held[b.bit.to_numpy(np.int64)], ["text", "text_hash"]]

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = np.array([jaccard(np.unique(shingle_hashes(x, width)), np.unique(shingle_hashes(y, width))) >= similarity - EPS for x, y in zip(b.a, b.b, strict=True)], bool)
            yield b.loc[keep, ["src", "dst"]]

    texts = source.select("text", "text_hash", bit).mapInPandas(wanted, "text string, text_hash long")
    texts = texts.repartition("text_hash").dropDuplicates(["text_hash"])
    both = pairs.join(texts.select(F.col("text_hash").alias("text_src"), F.col("text").alias("a")), "text_src").join(texts.select(F.col("text_hash").alias("text_dst"), F.col("text").alias("b")), "text_dst")
    return materialise(both.select("src", "dst", "a", "b").mapInPandas(alike, "src long, dst long").distinct(), "links")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets of hashes; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _edges(g: pd.DataFrame, forest: Forest, radius: int, similarity: float | None, leaf_rows: int) -> pd.DataFrame:
    """A shard's links, searched leaf by leaf: each linked row with the row that the walk reached it from
    (with a similarity) or the first of its leaf's component."""
    key, prints, sketches = g.key.to_numpy(), g.fp.to_numpy(np.int64).view(np.uint64), g.sketch.to_numpy()
    found = []
    for own in forest.leaves(prints, int(g.shard.iloc[0]) >> 32, leaf_rows):
        root = Links(prints[own], radius, sketches[own], similarity).roots(direct=similarity is not None)
        linked = root != np.arange(len(root))
        found.append(np.stack([key[own[linked]], key[own[root[linked]]]]))
    src, dst = np.concatenate(found, axis=1)
    return pd.DataFrame({"src": src, "dst": dst})


def blocked(df: DataFrame, group: str, row: str, most: int) -> DataFrame:
    """df with columns i, j, block, blocks: rows of a group of over `most` rows are dealt to blocks of
    about most/2, and every pair of blocks is a task of its own (i < j); other groups are (0, 0)."""
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    cut = df.join(materialise(sizes, "sizes"), group, "left").withColumn("blocks", F.ceil(F.coalesce("_n", F.lit(1)) / F.lit(most / 2)).cast("int"))
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))
    cut = cut.withColumn("block", F.pmod(F.xxhash64(F.col(row)), F.col("blocks")).cast("int")).withColumn("_other", F.explode(other))
    return cut.withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other")).drop("_n", "_other")

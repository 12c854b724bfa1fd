"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.components import connected_components, smallest_of_component
from tickframe.llm.simhash import blocked
from tickframe.llm.storage import discard, materialise, sampled

BITS = 64
TABLES = 4
REACH = 2
WIDTH = BITS // TABLES
SHARD_ROWS = 16384


class Quantiser:
    """Balanced 64-bit codes of unit vectors: centred, projected on principal directions, and turned
    by rotations that are learnt to bring each vector near its code (iterative quantisation). Vectors
    of fewer than 64 dimensions get several rotations from different starts."""

    def __init__(self, sample: np.ndarray, dim: int, seed: int = 3, rounds: int = 30):
        rng = np.random.default_rng(seed + dim)
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(dim)
        width = min(dim, BITS)
        centred = sample - self.mean
        basis = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :width] if len(sample) > width else np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :width]
        flat, turned = centred @ basis, []
        for _ in range(math.ceil(BITS / width)):
            r = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(rounds if len(sample) else 0):
                u, _, vt = np.linalg.svd(np.where(flat @ r >= 0, 1.0, -1.0).T @ flat)
                r = (u @ vt).T
            turned.append(basis @ r)
        self.planes = np.concatenate(turned, axis=1)[:, :BITS]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.planes >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _part(codes: np.ndarray, table: int) -> np.ndarray:
    return ((codes >> np.uint64(WIDTH * table)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def _patterns() -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(REACH + 1) for c in combinations(range(WIDTH), n)], np.int64)


def _pairs(keys: np.ndarray, near: np.ndarray, most: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose keys (group number, substring) differ in at most REACH bits of the substring,
    each pair once, in portions of about `most`."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    for pattern in near:
        low, high = np.searchsorted(held, keys ^ pattern, "left"), np.searchsorted(held, keys ^ pattern, "right")
        sizes = high - low
        upto = np.cumsum(sizes)
        a = 0
        while a < len(keys):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, "right")))
            n = sizes[a:b]
            left = np.repeat(np.arange(a, b), n)
            right = order[np.repeat(low[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            once = left < right
            yield left[once], right[once]
            a = b


def _search(g: pd.DataFrame, least: float, floats: str) -> pd.DataFrame:
    """One shard of one table: (node, links, root), the weight of a class's partners found here and the
    smallest class that its links here lead to. Vectors of unequal dimensions never meet."""
    return pd.concat([_search_even(own, least, floats) for _, own in g.groupby("dim")])


def _search_even(g: pd.DataFrame, least: float, floats: str) -> pd.DataFrame:
    """_search of vectors of one dimension. A pair is counted in one place only: in the first table that
    finds it, there in the lowest prefix that has both, and of a shard in blocks in one task."""
    g = g.sort_values("node", ignore_index=True)
    table, i, j, blocks = (int(g[c].iloc[0]) for c in ("t", "i", "j", "blocks"))
    codes, node, copies, block, shard = g.code.to_numpy(np.int64).view(np.uint64), g.node.to_numpy(), g.copies.to_numpy(np.int64), g.block.to_numpy(), g.prefix.to_numpy(np.int64)
    group = pd.factorize(g.label)[0].astype(np.int64)
    vectors = _unit(np.frombuffer(b"".join(g.vector), floats).reshape(len(g), -1).astype(float))
    substring, shift = _part(codes, table), WIDTH - g.depth.to_numpy(np.int64)
    links, parent = np.zeros(len(g), np.int64), np.arange(len(g))
    for a, b in _pairs((group << WIDTH) | substring, _patterns()):
        own = (blocks == 1) | (block[a] != block[b]) | ((block[a] == i) & (j == i + 1)) | ((block[a] == j) & (i == j - 1) & (j == blocks - 1))
        own &= (shard[a] == shard[b]) & (_first_common(substring[a] >> shift[a], substring[b] >> shift[b]) == shard[a])
        for earlier in range(table):
            own &= np.bitwise_count(_part(codes[a], earlier) ^ _part(codes[b], earlier)) > REACH
        a, b = a[own], b[own]
        linked = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= least
        a, b = a[linked], b[linked]
        links += np.bincount(a, copies[b], len(g)).astype(np.int64) + np.bincount(b, copies[a], len(g)).astype(np.int64)
        parent = _joined(parent, a, b)
    some = links > 0
    return pd.DataFrame({"node": node[some], "links": links[some], "root": node[parent][some]})


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest prefix within one bit of both, of prefixes that differ in two bits at most; the own
    one of two equal prefixes."""
    x = a ^ b
    low = x & -x
    return np.where(x == 0, a, np.where(x == low, np.minimum(a, b), np.minimum(a ^ low, b ^ low)))


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of components: parents are pulled to the smaller root until nothing moves."""
    while len(a):
        ra, rb = parent[a], parent[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        differ = low != high
        if not differ.any():
            break
        a, b = a[differ], b[differ]
        np.minimum.at(parent, high[differ], low[differ])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent


def near_duplicates(embeddings: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", sample_rows: int = 4096) -> DataFrame:
    """Every row of embeddings as (vec_id, n_links, component_id, kept): rows of equal labels (not
    null) and dimensions are linked at a cosine of at least `least`, computed in double precision.

    Equal vectors of a label are merged first, into classes with numbers of their own: ids only come
    back in with the answer. Codes are learnt on about `sample_rows` vectors
    (twice that at most) for all; every vector is indexed in TABLES tables by a part of its code, and a pair is retrieved by
    any part that differs in at most REACH bits: at a cosine of 0.93 the expected recall is 0.99, and
    higher above (the tests measure it against brute force). All retrieved pairs are reranked by the original
    vectors, so no link is wrong. A label of more than SHARD_ROWS vectors is sharded by the leading
    bits of the part, each vector also being sent to the prefixes one bit away; what is still too large
    (close vectors in great number) goes to tasks by pairs of blocks. Tasks return a row per vector. The
    quantisers that are broadcast hold 64 planes for each dimension in the sample, so their size is
    bounded by 65 times that of the sample.

    Vectors that are null, empty, all zero or hold null or non-finite components, and null labels,
    link with nothing: 0, their own id, kept. Repeated rows count as vectors of their own, and so do
    rows of one id with different vectors or labels. A row with a null id links like others and is
    counted, but names no component: one of such rows alone has a null component_id. An empty table
    gives an empty result; other columns aren't looked at."""
    spark = embeddings.sparkSession
    floats = "<f8" if dict(embeddings.dtypes)[vector_col] == "array<double>" else "<f4"
    kind = "array<double>" if floats == "<f8" else "array<float>"
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("vector"))
    good = "label is not null and vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x <> 0)"
    rows = materialise(rows.withColumn("good", F.expr(f"coalesce({good}, false)")), "vectors")
    reps = rows.where("good").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = materialise(reps.withColumn("node", F.monotonically_increasing_id()), "distinct")  # numbers are fixed once written
    named = reps.withColumn("dim", F.size("vector")).drop("rep")
    total = named.count()
    sample = sampled(named, sample_rows, total, "label", "vector").select("dim", "vector").toPandas()
    made: dict[int, Quantiser] = {int(d): Quantiser(_unit(np.stack(list(x)).astype(float)), int(d)) for d, x in sample.groupby("dim").vector}
    quantisers = spark.sparkContext.broadcast(made)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes = np.zeros(len(b), np.uint64)
            for d, own in b.groupby("dim").indices.items():
                model = quantisers.value.get(int(d)) or Quantiser(np.zeros((0, d)), int(d))
                codes[own] = model.codes(_unit(np.stack(list(b.vector.iloc[own])).astype(float)))
            yield b.assign(code=codes.view(np.int64), vector=[np.asarray(v).astype(floats).tobytes() for v in b.vector])

    coded = materialise(named.mapInPandas(encode, "label string, vector binary, copies long, node long, dim int, code long"), "codes")
    sizes = coded.groupBy("label").agg(F.count("*").alias("n"))
    depth = F.greatest(F.lit(0), F.least(F.lit(WIDTH), F.ceil(F.log2(F.col("n") / SHARD_ROWS)))).cast("int")
    tables = coded.join(materialise(sizes.select("label", depth.alias("depth")), "labels"), "label").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))))
    own = F.expr(f"cast(shiftrightunsigned(shiftright(code, {WIDTH} * t) & {(1 << WIDTH) - 1}, {WIDTH} - depth) as int)")
    flips = F.expr("concat(array(own), transform(filter(sequence(0, 16), b -> b < depth), b -> own ^ shiftleft(1, b)))")
    tables = tables.withColumn("own", own).withColumn("prefix", F.explode(flips)).drop("own")
    small = F.pmod(F.xxhash64("label"), F.lit(max(1, math.ceil(total / SHARD_ROWS))))
    shard = F.when(F.col("depth") == 0, F.xxhash64(small)).otherwise(F.xxhash64("label", "prefix"))
    tables = tables.withColumn("shard", shard.bitwiseAND(F.lit(-TABLES)).bitwiseOR(F.col("t").cast("long")))
    found = blocked(tables, "shard", "node", 4 * SHARD_ROWS).groupBy("shard", "i", "j").applyInPandas(lambda g: _search(g, least, floats), "node long, links long, root long")
    found = materialise(found, "links")
    discard(coded)
    known = reps.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    known = smallest_of_component(known, connected_components(found.select(F.col("node").alias("src"), F.col("root").alias("dst"))), "node", "rep")
    known = materialise(known.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classes")
    discard(found)
    discard(reps)
    linked = rows.where("good").join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

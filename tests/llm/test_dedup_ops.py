"""Embedding, exact and SimHash dedup against brute force, with the edges of the input."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

import tickframe.llm.hamming as hamming
import tickframe.llm.simhash as simhash
from tickframe.llm.components import connected_components
from tickframe.llm.cuckoo import CuckooFilter, CuckooIndex, digest_of, exact_duplicates
from tickframe.llm.simhash import Forest, Links, fingerprint_of, near_duplicates, shingle_hashes, sketch_of

DOCS = "doc_id long, text string, fp int, rep string, sketch int, digest string, block int"


def docs(spark, rows):
    """Rows (doc_id, text) beside columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3) for i, t in rows], DOCS)


def closure(linked):
    label = np.arange(len(linked))
    while True:
        new = np.array([min(label[i], label[linked[i]].min() if linked[i].any() else label[i]) for i in range(len(label))])
        if (new == label).all():
            return label
        label = new


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, None), (None, 5), (7, 7)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert out == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def vectors(rng, n, dim=24, copies=40):
    base = rng.normal(size=(n, dim))
    near = base[rng.integers(0, 6, copies)] + rng.normal(size=(copies, dim)) * rng.uniform(0.02, 0.45, (copies, 1))
    return np.concatenate([base, near, base[:5] * 3, base[:5]]).astype(np.float32)


@pytest.mark.parametrize(("shard_rows", "most"), [(16384, None), (40, None), (8, 4)])
def test_embeddings_recall_and_precision(spark, monkeypatch, shard_rows, most):
    monkeypatch.setattr(hamming, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(5)
    x = vectors(rng, 160)
    labels = [int(v) for v in rng.integers(0, 2, len(x))]
    rows = [(i, [float(v) for v in x[i]], labels[i], 0, "z") for i in range(len(x))]
    odd = [(1000, None, 1, 0, "z"), (1001, [0.0] * 24, 1, 0, "z"), (1002, [1.0, None] + [1.0] * 22, 1, 0, "z"), (1003, [float("nan")] * 24, 1, 0, "z"), (1004, rows[0][1], None, 0, "z"),
           (1005, [], 1, 0, "z"), (1006, [1.0, 2.0], 1, 0, "z"), (1007, [1.0, 2.0], 1, 0, "z"), (0, rows[0][1], labels[0], 0, "z")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, code int, vector string")
    got = sorted(hamming.near_duplicates(frame).collect(), key=lambda r: (r.vec_id, r.n_links))
    by = {r.vec_id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = ((unit @ unit.T) >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None])
    np.fill_diagonal(linked, False)
    want = linked.sum(axis=1) + linked[0] * 1  # row 0 is repeated
    want[0] += 1
    mine = np.array([by[i].n_links for i in range(len(x))])
    assert (mine <= want).all() and mine.sum() >= 0.9 * want.sum()
    if (mine == want).all():
        assert [by[i].component_id for i in range(len(x))] == closure(linked).tolist()
    for k in (1000, 1001, 1002, 1003, 1004, 1005):
        assert (by[k].n_links, by[k].component_id, by[k].kept) == (0, k, True)
    assert (by[1006].n_links, by[1007].component_id, by[1007].kept) == (1, 1006, False)
    assert hamming.near_duplicates(frame.where("false")).count() == 0


def test_embeddings_of_null_and_repeated_ids(spark):
    def at(*degrees):
        return [float(np.cos(np.radians(degrees[0]))), float(np.sin(np.radians(degrees[0]))), *[0.0] * 6]

    rows = [(1, at(0), "a"), (2, at(40), "a"), (None, at(20), "a"), (10, at(90), "a"), (10, at(180), "a"), (11, at(185), "a"), (3, at(0), "b"), (1, at(270), "b"), (1, at(90), "b"), (None, at(90), "b"),
            (None, at(0), "c"), (None, at(5), "c"), (None, at(90), "c"), (1, at(300), "a")]
    got = hamming.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    unit = np.array([v for _, v, _ in rows])
    linked = ((unit @ unit.T) >= 0.93) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(linked, False)
    label = closure(linked)
    want = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[k]) if rows[j][0] is not None]
        want.append((i, int(linked[k].sum()), min(ids, default=None), i is not None and i == min(ids, default=None)))
    assert sorted(map(repr, want)) == sorted(repr((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got)


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a\n b"), (4, ""), (2, None), (7, "x" * 200_000), (8, "x" * 200_000), (6, "a\u00a0b"), (None, "a b"), (None, "only none"), (3, "a\tb"), (1, " ")]
    got = exact_duplicates(docs(spark, rows)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).digest() == bytes(r.digest))
        ids = [i for i in groups[text] if i is not None]
        assert (r.keep_id, r.group_size, r.kept) == (min(ids, default=None), len(groups[text]), r.doc_id == min(ids, default=None))
    assert exact_duplicates(docs(spark, [])).count() == 0


def test_index_inserts_and_deletes(spark):
    index = CuckooIndex(spark, keys_per_shard=20)

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "doc_id long, text string").select("doc_id", digest_of("text").alias("digest"))

    def known(text):
        r = index.lookup(rows((0, text))).first()
        return r.keep_id, r.copies

    index.insert(rows(*[(i, f"t{i % 50}") for i in range(100)]))
    index.insert(rows((200, "t7"), (201, "new"), (7, "t7")))
    assert known("t7") == (7, 3) and known("new") == (201, 1) and known("absent") == (None, None)
    index.delete(rows((7, "t7"), (201, "new"), (999, "t3")))
    assert known("t7") == (57, 2) and known("new") == (None, None) and known("t3") == (3, 2)
    before = index.shards
    index.insert(rows(*[(1000 + i, f"grow{i}") for i in range(600)]))  # more shards
    assert known("grow599") == (1599, 1) and known("t9") == (9, 2) and index.shards > before and index.resized
    index = CuckooIndex(spark, index.path, keys_per_shard=20)  # reopened
    assert known("grow0") == (1000, 1) and known("t7") == (57, 2) and known("new") == (None, None)
    index.insert(rows((3, "new"), (None, "t7"), (2, "t7"), (2, "t7")))
    assert known("new") == (3, 1) and known("t7") == (2, 5)
    index.delete(rows((2, "t7"), (None, "t7")))
    assert known("t7") == (57, 2)
    wide = CuckooIndex(spark)
    wide.insert(rows(*[(i, f"a{i}") for i in range(60)]))
    assert not wide.resized
    wide.insert(rows(*[(i, f"b{i}") for i in range(400)], (500, "a3")))  # the only shard's filter overflows
    assert wide.resized == 1 and wide.shards == 1
    found = wide.lookup(rows(*[(0, f"{k}{i}") for k in "abc" for i in range(60)])).where("copies is not null")
    assert found.count() == 120 and found.where("keep_id = 3 and copies = 2").count() == 1


def test_only_hits_are_looked_up(spark, monkeypatch):
    index, asked = CuckooIndex(spark), []
    keys = CuckooIndex.keys

    def watched(self, of=None):
        asked.extend(bytes(r.digest) for r in of.collect()) if of is not None else None
        return keys(self, of)

    monkeypatch.setattr(CuckooIndex, "keys", watched)

    def rows(*texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").select("doc_id", digest_of("text").alias("digest"))

    index.insert(rows("a", "b", "b"))
    assert not asked
    index.insert(rows("c", "d", "b", "e"))
    assert asked == [hashlib.sha256(b"b").digest()]


def test_filter_overflow_and_deletion():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    assert not CuckooFilter(16).insert(keys)
    made = CuckooFilter.holding(keys)
    assert made.contains(keys).all()
    made.delete(keys[:250])
    assert made.contains(keys[250:]).all() and made.contains(keys[:250]).mean() < 0.02


def test_fingerprint_bits():
    import xxhash

    text = "One two\tTHREE four five\u00a0x one two three four"
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(len(words) - 3)]
    want = sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))
    assert fingerprint_of(text, 4) % 2**64 == want
    assert fingerprint_of("", 4) == 0 and fingerprint_of(" \n", 4) == 0
    assert fingerprint_of("a B", 4) % 2**64 == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize(("radius", "trees"), [(4, 3), (4, 1), (9, 5), (4, 5)])
def test_forest_keeps_every_pair_together(radius, trees):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    flips = np.zeros(400, np.uint64)
    for _ in range(radius):
        flips ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    prints = np.concatenate([base, base ^ flips])
    row, shard = Forest(prints, radius, trees, 4).shards(prints)
    homes = {}
    for r, s in zip(row.tolist(), shard.tolist(), strict=True):
        homes.setdefault(r, set()).add(s)
    assert all(homes[i] & homes[i + 400] for i in range(400))


@pytest.mark.parametrize(("shard_rows", "leaf"), [(4096, 256), (4096, 4), (16, 8), (4, 256)])
def test_near_duplicates(spark, shard_rows, leaf):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, 120)) for _ in range(40)]
    texts += [t + " tail" for t in texts[:12]] + [" ".join(t.split()[1:]) for t in texts[:8]] + texts[:5] + ["", None, " ", "one", "ONE", "a b c d"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (1000, texts[0]), (1000, texts[20]), (951, texts[21] + " more"), (None, " ".join(rng.choice(vocabulary, 120)))]
    prints = [fingerprint_of(t or "", 4) % 2**64 for _, t in rows]
    edge = [k for k in range(12) if prints[k] != prints[40 + k]]
    rows = [(None if k in edge[:4] else i, t) for k, (i, t) in enumerate(rows)]  # nulls beside others, and between some
    got = near_duplicates(docs(spark, rows), shard_rows=shard_rows, leaf_rows=leaf).collect()
    prints = np.array([fingerprint_of(t or "", 4) for _, t in rows], np.int64).view(np.uint64)
    linked = np.bitwise_count(prints[:, None] ^ prints[None]) <= 4
    label = closure(linked)
    want = {}
    for k, (i, _) in enumerate(rows):
        want[label[k]] = min(x for x in (i, want.get(label[k])) if x is not None) if (i, want.get(label[k])) != (None, None) else None
    expected = sorted(((-1 if i is None else i), int(prints[k].view(np.int64)), want[label[k]]) for k, (i, _) in enumerate(rows))
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.fingerprint, r.component_id) for r in got) == expected
    assert near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("radius", "trees"), [(4, 3), (9, 5)])
def test_leaves_keep_every_pair_together(radius, trees):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)[rng.integers(0, 40, 700)] ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64))
    forest = Forest(np.zeros(0, np.uint64), radius, trees, 0)
    for tree, mask in enumerate(forest.masks):
        together = np.zeros((700, 700), bool)
        parts = list(forest.leaves(base, tree, most=50))
        assert len(parts) > 1
        for own in parts:
            together[np.ix_(own, own)] = True
        near = np.bitwise_count((base[:, None] ^ base[None]) & mask) <= radius // trees
        assert together[near].all()


def test_a_bridge_without_id(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    text = list(rng.choice(words, 300))
    middle = [*text[:-20], *rng.choice(words, 20)]
    rows = [(9, " ".join(text)), (None, " ".join(middle)), (4, " ".join([*rng.choice(words, 20), *middle[20:]])), (4, "another text of id four"), (None, "alone")]
    got = near_duplicates(docs(spark, rows), width=5, radius=9, trees=5, similarity=0.8).collect()
    sets = [set(shingle_hashes(t, 5).tolist()) for _, t in rows]
    linked = np.array([[len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets] for a in sets])
    assert linked[0, 1] and linked[1, 2] and not linked[0, 2]
    assert sorted(repr((r.doc_id, r.component_id)) for r in got) == sorted(map(repr, [(9, 4), (None, 4), (4, 4), (4, 4), (None, None)]))


def test_similarity_by_sketches(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(2000)]
    text = list(rng.choice(words, 400))
    near = text.copy()
    near[100] = "changed"
    far = text[:200] + list(rng.choice(words, 200))
    rows = [(1, " ".join(text)), (2, " ".join(near)), (3, " ".join(far)), (4, "spam " * 500), (5, "spam " * 500 + " ".join(text[:90]))]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, rows), width=5, radius=9, trees=5, similarity=0.8).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    a, b = sketch_of(shingle_hashes(rows[0][1], 5)), sketch_of(shingle_hashes(rows[1][1], 5))
    link = Links(np.zeros(2, np.uint64), 0, [a, b], 0.8)
    assert link.between(np.array([0]), np.array([1]))[0, 0]


def brute_force_components(rows, least):
    """Per id the smallest id reachable by links of that Jaccard similarity of shingles of five words."""
    sets = [set(shingle_hashes(t, 5).tolist()) for _, t in rows]
    linked = np.array([[len(a & b) >= least * len(a | b) - 1e-9 for b in sets] for a in sets])
    label = closure(linked)
    ids = np.array([i for i, _ in rows])
    return {i: int(ids[label == label[k]].min()) for k, (i, _) in enumerate(rows)}


def near_copies(rng, vocabulary, n, edits, length=150):
    """n texts and an altered copy of each, with edits(k) words of the copy replaced."""
    rows = []
    for k in range(n):
        words = list(rng.choice(vocabulary, length))
        copy = words.copy()
        for p in np.linspace(2, length - 8, edits(k)).astype(int):
            copy[p] = f"new{k}x{p}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    return rows


def test_similarity_beyond_the_radius(spark):
    rng = np.random.default_rng(11)
    line = " ".join(f"c{i}" for i in range(12))
    rows = near_copies(rng, [f"w{i}" for i in range(5000)], 60, lambda k: 1 + k % 3)  # 0.81 to 0.94
    rows = [(i, t + " " + line if i % 3 else t) for i, t in rows] + [(500, ""), (501, line), (502, line + " c12")]
    rows += [(700 - k, rows[k][1].upper()) for k in range(12)]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, rows), width=5, radius=9, trees=5, similarity=0.8).collect()}
    assert got == brute_force_components(rows, 0.8)
    prints = np.array([fingerprint_of(t, 5) for _, t in rows[:120]], np.int64).view(np.uint64)
    assert (np.bitwise_count(prints[::2] ^ prints[1::2]) > 9).any()


def test_similarity_is_verified(spark):
    rng = np.random.default_rng(12)
    rows = near_copies(rng, [f"w{i}" for i in range(5000)], 60, lambda k: 13 + k % 4, 500)  # 0.74 to 0.80
    rows += [(900, "two words and more of them"), (901, "Two  words and more of them"), (902, "x " * 40), (903, "x " * 50)]
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(spark, rows), width=5, radius=9, trees=5, similarity=0.8).collect()}
    assert got == brute_force_components(rows, 0.8)
    prints = np.array([fingerprint_of(t, 5) for _, t in rows], np.int64).view(np.uint64)
    links = Links(prints, 9, [sketch_of(shingle_hashes(t, 5)) for _, t in rows], 0.8)
    estimated = [bool(links.between(np.array([k]), np.array([k + 1]))[0, 0]) for k in range(0, 120, 2)]
    assert any(e and got[2 * k] != got[2 * k + 1] for k, e in enumerate(estimated))


def test_shards_before_rows(spark, monkeypatch):
    """A first insert, and a larger second one, never put many more keys than twice keys_per_shard into one group."""
    from tickframe.llm import cuckoo

    index, sizes = CuckooIndex(spark, keys_per_shard=50), []
    shard = CuckooIndex._shard

    def seen(self, df):
        out = shard(self, df)
        sizes.append(max((r["count"] for r in out.groupBy("shard").count().collect()), default=0))
        return out

    monkeypatch.setattr(CuckooIndex, "_shard", seen)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), digest_of(F.col("id").cast("string")).alias("digest"))
    index.insert(rows.where("doc_id < 700"))
    assert index.shards == 8 and index.total == 700 and max(sizes) < 130
    index.insert(rows)
    assert index.shards == 64 and index.total == 3000 and max(sizes) < 140 and index.resized >= 1  # room for all that came, repeats too
    again = cuckoo.CuckooIndex(spark, index.path, keys_per_shard=50)
    assert again.lookup(rows).where("keep_id = doc_id and copies = 1").count() == 3000


def test_parity_never_exceeds_the_difference():
    """The bound by parities holds for sets of any two sizes, and rules out most pairs far below 0.8."""
    rng, ruled_out = np.random.default_rng(3), 0
    for k in range(400):
        pool = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 3000)), dtype=np.uint64))
        a, b = (np.sort(rng.choice(pool, int(rng.integers(0, len(pool) + 1)), replace=False)) for _ in "ab")
        if k % 2:
            b = np.setdiff1d(a, rng.choice(a, len(a) // 9, replace=False)) if len(a) else a
        least, real = simhash.least_difference(simhash.parity_of(a), simhash.parity_of(b)), len(np.setxor1d(a, b))
        assert least <= real and (least - real) % 2 == 0
        if len(a) + len(b) > 500 and simhash.jaccard(a, b) < 0.5:
            ruled_out += least > (len(a) + len(b)) / 9
    assert ruled_out > 40


def test_common_shingles_are_counted_over_all_texts(spark):
    texts = [f"one passage that all of these share number {i % 7} and then {i} words of its own {'x ' * (i % 3)}" for i in range(60)] + ["", " ", "alone"]
    source = spark.createDataFrame([(t,) for t in texts], "text string").repartition(9)
    hashes, counts = simhash._common(source, 5)
    plain = Counter(h for t in texts for h in set(simhash.shingle_hashes(t, 5).tolist()))
    assert dict(zip(hashes.tolist(), counts.tolist(), strict=True)) == {h: n for h, n in plain.items() if n > 1}
    none, _ = simhash._common(source.limit(0), 5)
    assert len(none) == 0


def test_shared_passages_make_few_pairs_and_lose_no_link(spark, monkeypatch):
    """Six hundred texts that share a passage of a tenth to nineteen twentieths of their words: links equal
    brute force, and the join's pairs stay in proportion to the texts but for those that the passage fills."""
    rng = np.random.default_rng(5)
    passage, texts = [f"p{i}" for i in range(200)], []
    for i in range(600):
        own = int(rng.integers(20, 1800)) if i % 15 else int(rng.integers(5, 60))
        at = int(rng.integers(0, own + 1))
        words = [f"w{x}" for x in rng.integers(0, 10**6, own)]
        texts.append(" ".join([*words[:at], *passage, *words[at:]]))
    texts += [t + " tail" for t in texts[:40]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    pairs, beyond = [], simhash._beyond

    def counted(*args):
        pairs.append(out := beyond(*args))
        return out

    monkeypatch.setattr(simhash, "_beyond", counted)
    found = simhash.near_duplicates(docs, width=5, radius=9, trees=5, similarity=0.8).collect()
    sets = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    label = np.arange(len(texts))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if simhash.jaccard(sets[i], sets[j]) >= 0.8 - 1e-9]
    while True:
        before = label.copy()
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if (before == label).all():
            break
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(label.tolist()))
    assert len(links) > 60 and pairs[0].count() < 3 * len(texts)

"""Whitening, retrieval packing and periodic runs against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

DOCS = "doc_id long, text string"


# operator 13


def plain_runs(words, min_length=6, min_repeats=4):
    out = []
    for q in range(1, len(words) // min_repeats + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(min_length, min_repeats * q) and not any(all(words[x] == words[x - d] for x in range(start + d, start + length)) for d in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def run_texts():
    rng, texts = random.Random(3), ["", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "A a " * 5, "a\x0ba\x0ca\ra a\ta", "           ", "x " * 500]
    for _ in range(150):
        words = rng.choices("ab", k=rng.randint(1, 60))
        for _ in range(rng.randint(0, 3)):
            unit, times = rng.choices("abc", k=rng.randint(1, 9)), rng.randint(2, 7)
            at = rng.randint(0, len(words))
            words[at:at] = (unit * times)[: rng.randint(1, len(unit) * times)]
        texts.append(" ".join(words))
    unit = [f"w{i}" for i in range(37)]
    texts += [" ".join(["x", *unit * 4]), " ".join([*unit * 4, "y"][1:]), " ".join((unit * 4)[:-1] + ["z"] * 3), " ".join("the a the b the c".split() * 9)]
    return texts


@pytest.mark.parametrize("portion", [50, 4_000_000])
def test_runs_against_plain(spark, monkeypatch, portion):
    from tickframe.llm import periodic

    monkeypatch.setattr(periodic, "PORTION", portion)
    texts = run_texts()
    for lengths in ((6, 4), (1, 3)):
        at = 0
        for part in periodic._portions([t.encode() for t in texts]):
            sizes, runs, collapsed = periodic._scan(part, *lengths)
            for t, n, r, c in zip(part, sizes, runs, collapsed, strict=True):
                words = t.decode().translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ")
                words = [w for w in words if w]
                want = plain_runs(words, *lengths)
                assert (n, [(x["start"], x["length"], x["period"]) for x in r], c) == (len(words), want, plain_collapsed(words, want))
                at += 1
        assert at == len(texts)


def test_runs_of_a_long_text_are_linear(spark):
    from tickframe.llm.periodic import _scan

    n, runs, collapsed = _scan([b"same " * 1_000_000, b"a b " * 300_000], 6, 4)  # a word has up to a million earlier occurrences
    assert (n, [len(r) for r in runs], [len(c) for c in collapsed]) == ([1_000_000, 600_000], [1, 1], [4, 3])


def test_run_edges(spark):
    from tickframe.llm.periodic import periodic_runs

    rows = spark.createDataFrame([(1, "x " * 8, 5), (1, "x " * 8, 5), (None, None, 1), (2, "", 2)], "doc_id long, text string, runs int")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(rows).collect()), key=repr)
    assert got == [(0, 0, [], ""), (1, 8, [(0, 8, 1)], "x"), (1, 8, [(0, 8, 1)], "x"), (2, 0, [], "")]
    assert periodic_runs(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(rows, min_repeats=2)


def plain_op13(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    words = [w.decode() for w in words]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha(lines), sha(plain_collapsed(words, runs)))


def test_op13_query(spark, tmp_path):
    from tickframe.llm.queries import op13_runs

    rng = random.Random(5)
    texts = [" ".join(rng.choices(["ab", "c", "dé", "\U0001f600"], k=rng.randint(0, 120))) for _ in range(300)] + run_texts() + [None]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r) for r in op13_runs(spark, str(tmp_path)).collect()}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    for i, t in rows:
        assert got[i] == plain_op13(i, t)
    assert sum(r[1] > 0 for r in got.values()) > 50


# operator 12


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def topical(n=300, seed=2):
    """Texts of ten topics, each with words of its own among common ones."""
    rng, common = random.Random(seed), [f"com{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = [f"t{i % 10}x{j}" for j in range(25)]
        out.append((i, " ".join(rng.choice(own if rng.random() < 0.4 else common) for _ in range(rng.choice([3, 20, 60, 200, 700])))))
    return out


def check_packing(rows, got, capacity):
    """Every id once, whole, in order, in gapless sequences; returns ids lost to padding."""
    from tickframe.llm.bpe import Encoder

    encoder, own = Encoder(tokenizer()), {}
    for r in got:
        own.setdefault(r.doc_id, []).append(r)
    assert sorted(own) == sorted(i for i, _ in rows)
    for doc, text in rows:
        ids = np.append(encoder.ids(text or ""), 0).astype("<u4")
        at = 0
        for p in sorted(own[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, sequences


@pytest.mark.parametrize("shard", [40, 1024])
def test_retrieval_packing(spark, shard):
    from tickframe.llm.retrieval import pack

    rows = [*topical(), (900, ""), (901, None), (902, "same words here " * 40), (903, "same words here " * 40), (904, "long " * 5000)]
    got = pack(spark.createDataFrame(rows, DOCS).repartition(3), tokenizer(), shard=shard).collect()
    padding, sequences = check_packing(rows, got, 1024)
    assert padding == 0
    short = [s for s in sequences.values() if sum(p.length for p in s) < 1024]
    assert len(short) <= 10 * 4  # what a task's end leaves
    pairs = [(a.doc_id % 10, b.doc_id % 10) for s in sequences.values() for a in s for b in s if a.doc_id < b.doc_id < 900]
    assert sum(a == b for a, b in pairs) / len(pairs) > (0.25 if shard == 40 else 0.5)  # by chance a tenth


def test_retrieval_edges(spark):
    from tickframe.llm.retrieval import pack

    rows = spark.createDataFrame([(1, "a b", 1), (1, "a b", 1), (None, None, 2)], "doc_id long, text string, tokens int")
    got = pack(rows, tokenizer()).collect()
    assert sorted((r.doc_id or 0, r.start, r.length, r.doc_tokens) for r in got) == [(0, 0, 1, 1), (1, 0, 3, 3), (1, 0, 3, 3)] or sum(r.length for r in got) == 7
    assert pack(rows.limit(0), tokenizer()).count() == 0
    with pytest.raises(ValueError):
        pack(rows, tokenizer(), capacity=1000)


def test_shard_is_greedy_by_plain_bm25():
    """Each window against plain BM25: the seed is the longest, every next piece the best that fits."""
    import math

    import pandas as pd

    from tickframe.llm import retrieval as R

    texts = [t for _, t in topical(120, 9)]
    bags = words_of(texts)
    sets = [dict(zip(np.frombuffer(b, "<u4").tolist(), np.frombuffer(t, "u1").tolist(), strict=True)) for _, b, t in bags]
    held = {b: sum(b in s for s in sets) for s in sets for b in s}
    n, sizes_of = len(texts), [b[0] for b in bags]
    mean = np.mean(sizes_of)

    def plain(query, doc):
        out = 0.0
        for b in sets[query]:
            if b in sets[doc]:
                tf, idf = sets[doc][b], math.log(1 + (n - held[b] + 0.5) / (held[b] + 0.5))
                out += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes_of[doc] / mean))
        return out

    sizes = [min(1000, 3 * len(t.split())) for t in texts]
    items = pd.DataFrame({"size": sizes, "buckets": [b for _, b, _ in bags]})
    items["weights"] = [
        R.weights(np.frombuffer(t, "u1").astype(float), np.array([held[x] for x in np.frombuffer(b, "<u4").tolist()], float), np.full(len(t), float(w)), n, mean).astype("<f4").tobytes() for w, b, t in bags
    ]
    shard, left = R._Shard(items), list(sizes)
    scores = shard.scores(5)
    assert np.allclose(scores, [plain(5, d) for d in range(n)], rtol=1e-5)
    count = 0
    for window in shard.windows(1024, 0):
        seed = window[0][0]
        assert sizes[seed] == max(sizes[d] for d in range(n) if left[d])
        left[seed] -= window[0][2]
        gap = 1024 - window[0][2]
        for item, _, length in window[1:]:
            open_ = [d for d in range(n) if left[d] and d not in {w[0] for w in window[:1]}]
            fits = [d for d in open_ if left[d] <= gap] or open_
            assert plain(seed, item) >= max(plain(seed, d) for d in fits) - 1e-4 and item in fits
            assert length == min(gap, left[item])
            left[item] -= length
            gap -= length
        assert gap == 0
        count += 1
    assert count > 5 and sum(left) < 1024
    rest = list(shard.rest(1024))
    assert [sum(p[2] for p in w) for w in rest] == [1 << k for k in reversed(range(10)) if sum(left) >> k & 1]


def words_of(texts):
    from tickframe.llm import retrieval as R

    encoder, _, words = R._encoder(tokenizer())
    return words.bags([np.append(encoder.ids(t), 0).astype("<u4") for t in texts])


def test_words_from_ids():
    """Case, spaces and what stands beside a word make no difference; other words have other buckets."""
    (n, a, _), (_, b, _), (_, c, t), (end, e, _) = words_of(["house time", "Time (house)", " time time houses", ""])
    a, b, c, e = (set(np.frombuffer(x, "<u4").tolist()) for x in (a, b, c, e))
    assert (n, end) == (3, 1) and a <= b and len((a & c) - e) == 1 and 2 in t


def test_document_counts(spark):
    from tickframe.llm import retrieval as R

    texts = [t for _, t in topical(50)]
    made = R.features(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3), tokenizer(), "doc_id", "text", 1024)
    want = np.zeros(R.BUCKETS, np.int64)
    for _, b, _ in words_of(texts):
        want[np.frombuffer(b, "<u4")] += 1
    assert np.array_equal(R.document_counts(made), want)


# operator 11

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("kind,d", [("flat", 1), ("flat", 5), ("flat", 9), ("flat", 40), ("flat", 200), ("decay", 200), ("rank", 60), ("equal", 120), ("none", 30)])
def test_jacobi_davidson(kind, d):
    from tickframe.llm.whitening import jacobi_davidson

    rng = np.random.default_rng(d)
    x = rng.normal(size=(1000, d))
    if kind == "decay":
        x = x * 0.8 ** np.arange(d)
    elif kind == "rank":
        x = rng.normal(size=(1000, 3)) @ rng.normal(size=(3, d))
    elif kind == "equal":  # twelve equal ones at the top
        x = np.linalg.qr(x)[0] * np.where(np.arange(d) < 12, 3.0, 1.0)
    elif kind == "none":
        x = x * 0
    c = x.T @ x / len(x)
    got, want = jacobi_davidson(lambda u: x.T @ (x @ u) / len(x), d, 8), np.linalg.eigvalsh(c)[::-1][:8]
    scale = max(want[0], 1e-300)
    assert np.abs(got.values - want).max() <= 1e-13 * scale and got.residuals.max() <= 1e-12 * scale
    assert np.abs(got.vectors.T @ got.vectors - np.eye(len(want))).max() < 1e-13
    assert np.abs(c @ got.vectors - got.vectors * got.values).max() <= 1e-12 * scale


def test_minres():
    from tickframe.llm.whitening import minres

    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 30))
    a = a + a.T  # indefinite
    b = np.concatenate([rng.normal(size=(30, 3)), np.zeros((30, 1))], 1)
    assert np.allclose(a @ minres(lambda v: a @ v, b, 1e-12, 200), b, atol=1e-8)


def plain_whitening(rows):
    good = [(i, [float(x) for x in v]) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    centred = (n * x - s).astype(float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return [i for i, _ in good], n, deviation, centred @ u / np.sqrt(e), e / (centred**2).sum() * n


def embedded(n=400, d=20):
    rng = np.random.default_rng(4)
    v = (rng.normal(size=(n, d)) * 0.9 ** np.arange(d) + 3).astype(np.float32)
    return [(i * 3, v[i].tolist(), 0) for i in range(n)]


def test_whitening_against_plain(spark, monkeypatch):
    from tickframe.llm import whitening as W

    monkeypatch.setattr(W, "BLOCK", 8 * 20 * 50)
    rows = [*embedded(), (7, None, 0), (8, [], 0), (9, [None] + [1.0] * 19, 0), (10, [float("nan")] * 20, 0), (11, [float("inf")] * 20, 0), (13, [1.0] * 3, 1), (None, [3.0] * 20, 0), (0, [2.5] * 20, 1)]
    got = W.whiten(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    ids, n, deviation, whitened, explained = plain_whitening([r for r in rows if r[0] != 13])
    want = {}
    for i, d, z in zip(ids, deviation, whitened, strict=True):
        want.setdefault(i, []).append((d, z))
    assert len(got) == 8 * len(ids) and {r.vec_id for r in got} == set(ids)
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-10 and abs(r.explained - explained[r.component - 1]) < 1e-12
        near = [z[r.component - 1] for d, z in want[r.vec_id] if d == r.deviation]
        assert min(abs(abs(z) - abs(r.whitened)) for z in near) < 1e-9
        if len(near) == 1 and abs(near[0]) > 1e-3:
            signs.setdefault(r.component, set()).add(near[0] * r.whitened > 0)
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows


def test_whitening_edges(spark):
    from tickframe.llm.whitening import whiten

    def run(rows):
        return whiten(spark.createDataFrame(rows, VECTORS)).collect()

    assert run([]) == [] and run([(1, None, 0)]) == []
    one = run([(1, [1.0, 2.0], 0)])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = sorted(run([(1, [0.0, 5.0], 0), (2, [1.0, 5.0], 0), (2, [1.0, 5.0], 0)]), key=repr)
    assert [r.whitened is None for r in sorted(flat, key=lambda r: r.component)] == [False] * 3 + [True] * 3
    big = run([(1, [1e12, 0.0], 0), (2, [-1e12, 1.0], 0), (3, [0.0, 2.0], 0)])  # beyond a long's range
    assert {r.vec_id: r.deviation is None for r in big} == {1: True, 2: True, 3: False} and all(r.identity_error < 1e-9 for r in big)

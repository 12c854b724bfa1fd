"""Scoring, scanning, packing, tokenizing and counting against brute force, with the edges of the input."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickframe.llm import bloom_lm, packing, pieces, quality, secret_scan, token_rollup, url_rules
from tickframe.llm.bpe import Encoder, RankEncoder
from tickframe.llm.queries import op9_token_counts

DOCS = "doc_id long, text string, source string, lang string, row int, t string, score double, n int"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "The cat sat. The dog sat.", "x\u00a0y\u2003z", "caf\u00e9 na\u00efve \U0001f642 \u65e5\u672c\u8a9e", "tab\tand\nnew  line \n", "A" * 5000, "word " * 4000, "the cat sat on the mat\n" * 40,
    "it's we'll '' 12345 \u00bd", "the cat sat on the mat\n" * 40,
]


def docs(spark, texts=TEXTS, more=()):
    rows = [(i, t, f"s{i % 2}", "en" if i % 3 else None, 1, "x", 0.5, 2) for i, t in enumerate(texts)] + [(i, t, "s0", "en", 1, "x", 0.5, 2) for i, t in more]
    return spark.createDataFrame(rows, DOCS)


def words_of(t):
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().lower()) if w]


def test_lm_base_and_modes(spark):
    d = docs(spark, more=[(None, "the cat"), (4, TEXTS[4])])
    training = d.where("doc_id % 3 <> 1")
    model = bloom_lm.train(training)
    seqs = [[*words_of(r.text), None] for r in training.collect()]
    c = Counter(w for s in seqs for w in s)
    n, v = sum(c.values()), len(c)
    assert (model.n, model.v) == (n, v)
    got, far = (sorted(bloom_lm.score(d, model, most_bytes=b).collect(), key=repr) for b in (1 << 30, 0))
    want = sorted((len(s), sum(c[w] > 0 for w in s), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s), 6)) for s in ([*words_of(r.text), None] for r in d.collect()))
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert [(r.doc_id, r.n_tokens) for r in got] == [(r.doc_id, r.n_tokens) for r in far]
    assert np.allclose([r.score for r in got], [r.score for r in far]) and all(r.score <= 0 for r in got)
    assert bloom_lm.score(d.where("false"), model).count() == 0
    empty = bloom_lm.train(d.where("false"))
    assert all(r.n_known == 0 and r.base_score == 0 for r in bloom_lm.score(d, empty).collect())


def plain_probe(bits, h, levels=len(bloom_lm.LEVELS)):
    """The level of a hash in a part of the filter, one bit at a time."""
    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
        return x ^ (x >> 31)

    for level in range(1, levels + 1):
        a = mixed((h + level * 0x9E3779B97F4A7C15) % 2**64)
        step = mixed(a) | 1
        for _ in range(bloom_lm._probes(level)):
            place = (a >> 32) * (8 * len(bits)) >> 32
            if not bits[place >> 3] >> (place & 7) & 1:
                return level - 1
            a = (a + step) % 2**64
    return levels


def test_lm_scores_against_a_plain_filter(spark):
    rng = np.random.default_rng(12)
    texts = [*TEXTS, *[" ".join(rng.choice(["the", "cat", "sat", "on", "mat", "dog"], 80)) for _ in range(30)]]
    d = docs(spark, texts)
    model = bloom_lm.train(d.where("doc_id % 3 <> 1"))
    parts = {r["shard"]: bytes(r["bits"]) for r in model.parts.collect()}

    def count(h):
        part = parts.get(h >> 64 - model.shard_bits)
        return float(bloom_lm.MIDDLE[plain_probe(part, h)]) if part else 0.0

    end = int(bloom_lm.END)
    seqs = [[*(xxhash.xxh64_intdigest(w, bloom_lm.SEED) for w in words_of(t)), end] for t in texts]
    want: dict = {}
    exact = Counter(h for k, s in enumerate(seqs) if k % 3 != 1 for h in s)
    for k, seq in enumerate(seqs):
        total = 0.0
        for before, word in zip([end, *seq], seq, strict=False):
            pair = int(bloom_lm.bigrams(np.array([before, word], np.uint64))[1])
            c_before, c_word = exact[before], count(word)
            share = min(1.0, (c_word + 1) / (model.n + model.v + 1))
            total += math.log10((min(count(pair), c_before) + bloom_lm.PRIOR * share) / (c_before + model.v * 0.5**12 * min(c_before, 1) + bloom_lm.PRIOR))
        want[k] = total
    assert all(count(h) >= bloom_lm.MIDDLE[np.searchsorted(bloom_lm.LEVELS, c, "right")] - 1e-9 for h, c in exact.items())
    for mode in (1 << 30, 0):
        got = {r.doc_id: r.score for r in bloom_lm.score(d, model, most_bytes=mode).collect()}
        assert got == pytest.approx(want, rel=1e-9) and max(got.values()) <= 0


def test_word_hashes_of_like_words_differ():
    a = "ab"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    words, sizes = bloom_lm.tokens([a + " " + a.translate(str.maketrans("ab", "ba")), "\u00a0x", ""])
    assert len(a) == 2048 and len(set(words.tolist())) == 4 and sizes.tolist() == [3, 2, 1]
    assert bloom_lm._logs(np.array([141.4]), np.array([100.0]), np.array([100.0]), 100, 1, np.minimum) <= 1


def test_filter_levels_never_fall_short():
    hashes = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64)
    counts = np.random.default_rng(2).integers(1, 500, 3000)
    raw = np.frombuffer(bloom_lm._filter(hashes, counts), np.uint8)
    starts, sizes = np.zeros(3000, np.int64), np.full(3000, 8 * len(raw), np.uint64)
    found, true = bloom_lm._levels(hashes, raw, starts, sizes), np.searchsorted(bloom_lm.LEVELS, counts, "right")
    assert (found >= true).all() and (found > true).mean() < 0.08
    absent = np.random.default_rng(3).integers(0, 2**63, 3000, dtype=np.uint64)
    assert (bloom_lm._levels(absent, raw, starts, sizes) > 0).sum() < 8  # 0.7 are expected


def test_lm_counting_holds_little(monkeypatch):
    """A counting task holds its tokens, sorts them in place, and never keeps an order or ones beside them."""
    monkeypatch.setattr(bloom_lm, "FLUSH", 1_000_000)
    monkeypatch.setattr(bloom_lm, "STEP_BYTES", 100_000)
    rng = np.random.default_rng(3)
    texts = pd.DataFrame({"text": [" ".join(map(str, rng.integers(0, 50_000, 1000))) for _ in range(1000)]})
    counted = bloom_lm._count(iter([texts]), 4)
    tracemalloc.start()
    try:
        held = [g.drop(columns="hashes").assign(n=g.hashes.str.len() // 8) for g in counted]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    rows = pd.concat(held)
    total = lambda kind: sum(int(np.frombuffer(x, "<u4").sum()) for x in rows[rows.kind == kind].counts)
    assert (total(0), total(1)) == (1_001_000, 1_001_000)
    assert peak < 64 * bloom_lm.FLUSH



def test_lm_mass_of_a_context_is_one(spark):
    """P(word | context) summed over all words, for contexts of count 1, about 10 and about 100, on real text."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = bloom_lm.train(d)
    parts = model.parts.orderBy("shard").collect()
    words, often = (np.concatenate([np.frombuffer(bytes(r[k]), "<u8") for r in parts]) for k in ("words", "often"))
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in parts), "u1")
    lengths = np.array([len(r["bits"]) for r in parts])
    starts, sizes = np.zeros(1 << model.shard_bits, np.int64), np.full(1 << model.shard_bits, 64, np.uint64)
    own = [r["shard"] for r in parts]
    starts[own], sizes[own] = np.cumsum(lengths) - lengths, (8 * lengths).astype(np.uint64)

    def count(h):
        shard = (h >> np.uint64(64 - model.shard_bits)).astype(np.int64)
        return bloom_lm.MIDDLE[bloom_lm._levels(h, bits, starts[shard], sizes[shard])]

    c_word = count(words)
    for low, high in ((1, 1), (9, 11), (90, 110)):
        context = words[(often >= low) & (often <= high)][:40]
        mass = []
        for h in context:
            pair = bloom_lm._mixed(h * np.uint64(0x9E3779B97F4A7C15) + words)
            c = np.full(len(words), float(often[words == h][0]))
            mass.append(bloom_lm._logs(count(pair), c, c_word, model.n, model.v, np.minimum).sum())
        print(low, len(context), np.mean(mass), np.min(mass), np.max(mass))
        assert len(context) and 0.95 <= np.mean(mass) <= 1.05 and 0.7 <= min(mass) and max(mass) <= 1.3


def test_lm_in_shards_makes_no_row_of_a_token(spark, monkeypatch):
    """A model over most_bytes was joined with a row for each token, three times."""
    d = docs(spark, more=[(None, "the cat"), (4, TEXTS[4])])
    model, made = bloom_lm.train(d.where("doc_id % 3 <> 1")), []
    materialise = bloom_lm.materialise
    monkeypatch.setattr(bloom_lm, "materialise", lambda *a: made.append(materialise(*a)) or made[-1])
    monkeypatch.setattr(bloom_lm, "discard", lambda _: None, raising=False)
    tokens = sum(r.n_tokens for r in bloom_lm.score(d, model, most_bytes=0).collect())
    assert tokens > 4000 and made and all(t.count() <= d.count() for t in made)


@pytest.mark.parametrize("learn", ["doc_id % 3 <> 1", "doc_id >= 0 or doc_id is null", "false", "cast(null as boolean)"])
def test_lm_in_one_pass_is_train_and_score(spark, learn):
    d = docs(spark, more=[(None, "the cat"), (None, None), (4, TEXTS[4]), (4, TEXTS[4])]).repartition(3)
    d = spark.createDataFrame(d.collect(), d.schema)
    got, n = bloom_lm.train_and_score(d, F.expr(learn))
    model = bloom_lm.train(d.where(learn))
    assert n == model.n and got.schema == bloom_lm.score(d, model).schema
    for mode in (1 << 30, 0):
        assert sorted(got.collect(), key=repr) == sorted(bloom_lm.score(d, model, most_bytes=mode).collect(), key=repr)
    assert bloom_lm.train_and_score(d.where("false"), F.expr(learn))[0].count() == 0


def test_lm_query_sends_no_model_to_nodes(spark, monkeypatch):
    from tickframe.llm.queries import op2_lm

    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "addFile", lambda *a, **_: sent.append(a))
    assert op2_lm(spark, "/root/testdata/sf0.001").columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and not sent


def test_lm_batches_ask_shards_and_are_answered_in_order(monkeypatch):
    """Many small batches of both kinds, from counting to the levels that come back, against one filter and exact counts."""
    monkeypatch.setattr(bloom_lm, "BATCH", 50)
    monkeypatch.setattr(bloom_lm, "STEP_BYTES", 100)
    monkeypatch.setattr(bloom_lm, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})())}))
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.zipf(1.5, rng.integers(0, 40)) % 300)) for _ in range(60)]
    ids = pd.Series([None if i % 7 == 0 else 2**60 + i for i in range(60)], dtype="Int64")
    table = pd.DataFrame({"doc_id": ids, "text": texts, "learn": [i % 4 != 1 for i in range(60)]})
    seen = pd.concat(bloom_lm._seen(iter([table[:25], table[25:25], table[25:]])), ignore_index=True)
    assert len(seen) > 10 and seen.tokens.sum() == len(bloom_lm.tokens(texts)[0]) and seen.batch.is_unique and set(seen.batch // 2**40) == {3}
    back = pd.concat([pd.Series(np.frombuffer(r.ids, np.int64)).astype("Int64").where(np.frombuffer(r.there, bool)) for r in seen.itertuples()])
    assert sorted(back.fillna(0)) == sorted(ids.fillna(0)) and back.isna().sum() == ids.isna().sum()
    asked = pd.concat(bloom_lm._asked(iter([seen]), 4), ignore_index=True)
    got = pd.concat([bloom_lm._answered(g, None) for _, g in asked.groupby("shard")])
    learnt, _ = bloom_lm.tokens(list(table.text[table.learn]))
    exact, word_count = Counter(), Counter(learnt.tolist())
    sequences = {r.batch: (lambda words, sizes, at: words[at])(*bloom_lm._tokens_of(r.words, r.sizes, r.at)) for r in seen.itertuples()}
    for r in seen[seen.learn].itertuples():
        exact.update(bloom_lm.bigrams(sequences[r.batch]).tolist())
    assert got.n.sum() == len(learnt) and got.v.sum() == len(word_count)
    for batch, seq in sequences.items():
        own = got[got.batch == batch].sort_values("shard")
        words, pairs = np.unique(seq), np.unique(bloom_lm.bigrams(seq))
        assert np.concatenate([bloom_lm._numbers(x, "<u8") for x in own.often]).tolist() == [word_count[w] for w in words.tolist()]
        for found, hashes, count in ((own.words, words, word_count), (own.pairs, pairs, exact)):
            levels = np.frombuffer(b"".join(found), np.uint8)
            true = np.searchsorted(bloom_lm.LEVELS, [count[h] for h in hashes.tolist()], "right")
            assert len(levels) == len(hashes) and (levels >= true).all() and (levels > true).mean() < 0.25


def base_spans(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", x) if len(m[0]) >= 24])


RANDOM = "Zk3vQ9xT7bLw2RfYh8NcJ5mDs6GpVa4eKu1WtXo0Bq"
SECRETS = [
    "", None, "Password: hunter2!", "token=abc secret=token:abcdefgh", "api_key='0123456789abcdef01234567' \U0001f642 APIKEY=zzzzzz", "AKIA" + "Q7" * 8 + " AKIAQ7", "secret \u00e9 = \"deadbeef\"",
    f"key {RANDOM} end", "a" * 30 + " " + "internationalisation" * 2 + " https://example.com/some-long-path/with-many-words-in-it", "token=1 " * 500 + "token=abcdef1", "f" * 23 + " " + "f" * 24, "=" * 60 + "-" * 60,
]


def test_secrets(spark):
    d = docs(spark, SECRETS, [(None, SECRETS[2]), (3, SECRETS[3])])
    rows = secret_scan.scan(d).select("doc_id", "base", secret_scan.named(F.col("spans")).alias("spans")).collect()
    assert len(rows) == len(SECRETS) + 2
    for r in rows:
        text = SECRETS[2 if r.doc_id is None else r.doc_id] or ""
        base = base_spans(text)
        assert [tuple(s) for s in r.base] == base
        extra = [s for s in r.spans.split(",") if s.startswith("random")]
        assert extra == ([f"random:4:{4 + len(RANDOM)}"] if RANDOM in text else [])
    assert secret_scan.scan(d.where("false")).count() == 0
    plan = secret_scan.scan(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_random_tokens_are_found_in_each_encoding(spark):
    rng, lower, upper, digits = np.random.default_rng(3), secret_scan.LOWER, secret_scan.UPPER, secret_scan.DIGITS
    kinds = {"digits": digits, "lower": lower, "hex": digits + "ABCDEF", "base 32": upper + "234567", "lower and digits": lower + digits, "upper and digits": upper + digits,
             "letters and digits": lower + upper + digits, "base 64 for URLs": lower + upper + digits + "-_", "base 64": lower + upper + digits + "+/"}
    meta = [(kind, n) for kind in kinds for n in (20, 32, 64, 128) for _ in range(20)]
    texts = [f"see the note {''.join(rng.choice(list(kinds[kind]), n))} of the day" for kind, n in meta]
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select((F.col("doc_id") + 100_000).alias("doc_id"), "text")
    d = docs(spark, texts).select("doc_id", "text").unionByName(plain)
    got = {r.doc_id: r.s for r in secret_scan.scan(d).select("doc_id", secret_scan.named(F.col("spans")).alias("s")).collect()}
    assert not any("random" in s for i, s in got.items() if i >= 100_000)
    found = {}
    for i, (kind, n) in enumerate(meta):
        found.setdefault((kind, n), []).append(got[i] == f"{'hex' if kind == 'digits' else 'random'}:13:{13 + n}")
    recall = {k: np.mean(v) for k, v in found.items()}
    least = {"digits": 32, "lower": 64}
    powered = {k: x for k, x in recall.items() if k[1] >= least.get(k[0], 20)}
    assert np.mean(list(powered.values())) >= 0.9 and min(powered.values()) >= 0.7, recall


def test_many_matches_in_one_text(spark):
    n = 20_000
    text = "x secret=hunter22 y \U0001f642\n" * n
    row = docs(spark, [text]).select(secret_scan.base_spans(F.col("text")).alias("b"), secret_scan.redact(F.col("text"), secret_scan.base_spans(F.col("text"))).alias("t")).first()
    assert [tuple(s) for s in row.b] == base_spans(text) and row.t == "x [SECRET] y \U0001f642\n" * n


@pytest.mark.parametrize("spans", [[(0, 3)], [(1, 4), (2, 3), (3, 6), (8, 9)], [(0, 2), (2, 4)], [(0, 10)], [(4, 10)], []])
def test_redaction_of_overlaps(spark, spans):
    text, at, want = "ab\u00e9d\U0001f642fghij", 0, ""
    for start, end in sorted(spans):
        if start > at or not want and start == at:
            want += text[at:start] + "*"
        at = max(at, end)
    d = spark.createDataFrame([(text, [(a, 0, b) for a, b in sorted(spans)])], f"text string, spans {secret_scan.SPANS}")
    assert d.select(secret_scan.redact(F.col("text"), F.col("spans"), "*").alias("t")).first().t == want + text[at:]


def test_redaction(spark):
    d = docs(spark, ["a password=hunter22 b token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" \u00e9", "clean"])
    out = {r.doc_id: r.x for r in d.select("doc_id", secret_scan.redact(F.col("text"), secret_scan.base_spans(F.col("text"))).alias("x")).collect()}
    assert out == {0: 'a [SECRET] b [SECRET]" \u00e9', 1: "clean"}


def test_normal_tail(spark):
    for z in (-3.0, -0.5, 0.0, 1.0, 2.5, 6.0):
        assert spark.range(1).select(secret_scan.upper_tail(F.lit(z)).alias("p")).first().p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-7)


def test_quality(spark):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "slept"], 60)) + "." for _ in range(120)]
    bad = [" ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in rng.choice(["the", "cat", "sat", "on", "mat"], 60)) for _ in range(120)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair] + [None, "", " "]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(240)] + [(None, 1, 0), (3, None, 0), (5000, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(d, labels)
    out = {r.doc_id: r.quality_score for r in quality.score(d, model).select("doc_id", "quality_score").collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(out[i] >= 0.7) == (i % 2 == 0) for i in held]) > 0.95 and all(0 <= s <= 1 for s in out.values())
    assert quality.score(d.where("false"), model).count() == 0
    untrained = quality.train(d, labels.where("false"))
    assert quality.score(d, untrained).count() == len(texts)


def test_scores_against_a_plain_machine(spark):
    texts = ["The cat sat. The dog sat.", None, "", "w " * 300, "A b\nA b\n$$$ 12", "\u00e9\u00e9 x"]
    m, rng = quality.FactorisationMachine(), np.random.default_rng(3)
    m.bias, m.linear = 0.2, rng.normal(0, 0.5, quality.WIDTH)
    m.factors = rng.normal(0, 0.5, m.factors.shape)
    out = {r.doc_id: r.quality_score for r in quality.score(docs(spark, texts), m).select("doc_id", "quality_score").collect()}
    for k, t in enumerate(texts):
        index, value = quality.features(t or "")
        z = m.bias + sum(m.linear[i] * v for i, v in zip(index, value, strict=True))
        z += sum(float(m.factors[index[a]] @ m.factors[index[b]]) * value[a] * value[b] for a in range(len(index)) for b in range(a + 1, len(index)))
        assert out[k] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_training_rows_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality.FactorisationMachine, "fit", lambda self, rows, labels, **_: seen.append((len(rows), labels.tolist())) or self)
    d = docs(spark, ["good text"] * 9, [(4, f"copy {k}") for k in range(400)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)] * 3, "doc_id long, quality int, toxic int")
    quality.train(d, labels, rows=5)
    quality.train(d, labels)
    assert seen[0][0] == 5 and seen[1][0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(9))


def test_machine_uses_the_pair_identity():
    m = quality.FactorisationMachine()
    index, value = np.array([3, 50, 70]), np.array([0.5, 1.0, 2.0])
    m.linear[index] = [0.1, -0.2, 0.3]
    want = m.linear[index] @ value + sum(m.factors[index[a]] @ m.factors[index[b]] * value[a] * value[b] for a in range(3) for b in range(a + 1, 3))
    assert m.scores([(index, value)])[0] == pytest.approx(1 / (1 + math.exp(-want)))


def check_packed(rows, texts, capacity):
    own = Tokenizer.from_file(BPE)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids, at = np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(ids[at : at + r.length].tobytes())) and (r.length == capacity or k == 0)
            at += r.length
        assert at == len(ids) and (len(ids) > capacity or len(by_doc[i]) == 1)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    rng = np.random.default_rng(1)
    texts = [*TEXTS, *[" ".join(["word"] * int(n)) for n in rng.integers(1, 90, 120)]]
    rows = packing.pack(docs(spark, texts), BPE, capacity=capacity).collect()
    n = check_packed(rows, texts, capacity)
    assert n <= math.ceil(sum(r.length for r in rows) / capacity) * 1.05 + 1
    repeated = packing.pack(docs(spark, ["a b"], [(0, "a b"), (None, None)]), BPE).collect()
    assert sorted(r.offset for r in repeated) in ([0, 1, 4], [0, 3, 4], [0, 3, 6], [0, 1, 3, 4]) or len(repeated) == 3
    assert packing.pack(docs(spark, []), BPE).count() == 0


def test_ids_equal_the_library():
    own, coded = Tokenizer.from_file(BPE), Encoder(BPE)
    end, rng = "<|endoftext|>", np.random.default_rng(6)
    texts = [f"a {end} b", end, end * 2, f"the cat{end} sat", f"a{end[:-1]}", " " * 10**6, "\n" * 10**6, "\t" * 10**6 + "x", " " * 1500 + "'s", "\u3000" * 1200 + "b", "\x1c" * 1500 + "b", f"a{' ' * 1200}{end}{' ' * 1300}b"]
    texts += [f"a{' ' * n}b" for n in (999, 1000, 1001)] + [f"a{' ' * 999}\n{x}" for x in ("", "b", " b", "1")]
    parts = [" ", "\n", "\t", "a", "\u00e9", "1", "!", "'s", "\xa0", "\u2003", end, " " * 1000, "\n " * 600]
    texts += ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(60)]
    for t in texts:
        assert coded.ids(t).tolist() == own.encode(t, add_special_tokens=False).ids, (t[:50], len(t))
    own.encode_special_tokens = True
    for t in texts[:5]:
        assert Encoder(BPE, special_as_text=True).ids(t).tolist() == own.encode(t, add_special_tokens=False).ids


def placed(spark, sizes, capacity):
    units = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "id long, size long")
    rows = packing.place(units, capacity).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, int(sizes[r.id])))
    for s in by.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_places_are_close_to_the_bound(spark, monkeypatch):
    rng = np.random.default_rng(2)
    sizes = np.clip(rng.lognormal(5, 1.2, 3000), 1, 2048).astype(int)
    assert placed(spark, sizes, 2048) <= math.ceil(sizes.sum() / 2048) * 1.02 + 1
    monkeypatch.setattr(packing, "SALT_ROWS", 7)  # salts
    assert placed(spark, rng.integers(1, 9, 300), 8) <= 300
    assert placed(spark, [3] * 50, 8) == 25 and placed(spark, [8] * 5, 8) == 5 and placed(spark, [5] * 5, 8) == 5 and placed(spark, [], 8) == 0


def best_fit_sweep(rows):
    """Brute force: upwards through the gaps, each takes the longest unit that fits and isn't taken."""
    units, pairs = sorted((n, i) for k, n, i in rows if k == packing.ITEM), []
    for room, gap in sorted((n, i) for k, n, i in rows if k == packing.GAP):
        fit = [u for u in units if u[0] <= room]
        if fit:
            units.remove(fit[-1])
            pairs.append((fit[-1][0], room))
    return sorted(pairs)


def test_sweep_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    for salt_rows in (1000, 3):
        monkeypatch.setattr(packing, "SALT_ROWS", salt_rows)
        rows = [(int(rng.integers(0, 2)), int(rng.integers(1, 12)), i) for i in range(120)]
        open_ = spark.createDataFrame(rows, "kind int, size long, id long").withColumn("slot", F.lit(0).cast("long")).withColumn("room", F.col("size"))
        got = packing._sweep(open_, packing._totals(open_)).collect()
        mates = {r.id: r.mate for r in got}
        assert all(r.mate is None or mates[r.mate] == r.id for r in got) and len(got) == len(rows)
        assert sorted((r.size, r.other) for r in got if r.kind == packing.ITEM and r.mate is not None) == best_fit_sweep(rows)


def test_short_documents(spark):
    texts = ["a"] * 900 + ["a b c"] * 50 + [None] * 400
    rows = packing.pack(docs(spark, texts), BPE, capacity=128).collect()
    assert check_packed(rows, texts, 128) <= math.ceil(sum(r.length for r in rows) / 128) + 1


URLS = [
    None, "", "nonsense", "https://Example.COM/en/1", "http://www.example.com/en/1?x=1#y", "http://a.www.example.com/en/", "https://x.net/es/1", "https://x.net/de/1", "http://notexample.com/en/", "ftp://com", "http://com/",
    "http://a.com?x", "HTTP://evil.org/en/7", "x://y.net/fr/://z", "http://EXAMPLE.com/EN/1",
]


def url_oracle(u):
    if not u or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_urls(spark):
    many = URLS + [f"https://s{i}.net/{'es' if i % 2 else 'fr'}/{i}" for i in range(60)] + [f"http://t{i}.com/de/{i}" for i in range(60)] + ["https://new.org/fr/5", "http://new.org/de/5"]
    d = spark.createDataFrame([(i, u, "h", "r", 1.0) for i, u in enumerate(many)] + [(None, URLS[3], "h", "r", 1.0), (6, URLS[6], "h", "r", 1.0)], "page_id long, url string, host string, row string, confidence double")
    rows = url_rules.judge(d).collect()
    assert len(rows) == len(many) + 2
    for r in rows:
        host, path, rule, verdict = url_oracle(many[3 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
    by = {r.page_id: r for r in rows}
    assert (by[len(many) - 2].verdict, by[len(many) - 2].by) == ("block", "mined") and by[len(many) - 1].verdict == "allow"
    assert url_rules.judge(d.where("false")).count() == 0
    assert {r.by for r in url_rules.judge(d.where("page_id in (0, 1, 2)")).collect()} == {"default"}


def test_mined_rules_reach_confidence(spark):
    rows = [(["a", "b"], "block")] * 9 + [(["a"], "allow")] * 9 + [(["b"], "allow")] * 3
    rows = [(k, t, v) for k, (t, v) in enumerate(rows)]
    rules = {(tuple(r.antecedent), r.verdict): (r.confidence, r.rare) for r in url_rules.mine(spark.createDataFrame(rows, "row long, tokens array<string>, verdict string"), 0.05, 0.7).collect()}
    assert rules == {(("a", "b"), "block"): (1.0, "b"), (("b",), "block"): (0.75, "b")}


def brute_force_rules(sets, support, confidence):
    """All rules from all combinations of tokens: {(antecedent, verdict): (confidence, support)}."""
    total, freq = len(sets), Counter()
    same = {}
    for t in sorted({t for tokens, _ in sets for t in tokens}):
        same.setdefault(frozenset(k for k, (tokens, _) in enumerate(sets) if t in tokens), t)
    own = {t for rows, t in same.items() if len(rows) >= support * total}
    for tokens, verdict in sets:
        for n in range(1, len(own) + 1):
            for c in combinations(sorted(own & set(tokens)), n):
                freq[c] += 1
                freq[c, verdict] += 1
    rules = {k: (freq[k] / freq[k[0]], freq[k] / total) for k in freq if len(k) == 2 and isinstance(k[0], tuple) and freq[k] >= support * total and freq[k] >= confidence * freq[k[0]] - 1e-12}
    weaker = {(a, v) for (a, v), (c, _) in rules.items() for k in range(len(a)) if rules.get((a[:k] + a[k + 1 :], v), (-1,))[0] >= c}
    return {k: x for k, x in rules.items() if k not in weaker}


def test_mined_verdicts_against_brute_force(spark):
    rng = np.random.default_rng(9)
    hosts, words = ["a.net", "b.net", "www.a.net", "c.org", "x.com", "y-1.com", "example.com"], ["es", "fr", "en", "ads", "page", "x", "7"]
    urls = [f"http{'s' * int(rng.integers(2))}://{rng.choice(hosts)}/" + "/".join(rng.choice(words, rng.integers(0, 4))) + ("?q=1&r" if rng.random() < 0.2 else "") for _ in range(150)]
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    host, path = url_rules.host_and_path(F.col("url"))
    tokens = {r.page_id: r.t for r in d.select("page_id", url_rules.url_tokens(F.col("url"), host, path).alias("t")).collect()}
    assert all(f"segment:{s.replace('7', '#')}" in tokens[k] for k, u in enumerate(urls) for s in u.split("/", 3)[3].split("?")[0].split("/") if s)
    fixed = {k: url_oracle(u)[3] for k, u in enumerate(urls)}
    rules = brute_force_rules([(tokens[k], v) for k, v in fixed.items() if v], 0.05, 0.7)
    want = {}
    for k in tokens:
        fired = [(c, s, len(a), list(a), v) for (a, v), (c, s) in rules.items() if set(a) <= set(tokens[k])]
        want[k] = (fixed[k], "fixed") if fixed[k] else (max(fired)[4], "mined") if fired else ("allow", "default")
    got = {r.page_id: (r.verdict, r.by) for r in url_rules.judge(d, support=0.05, confidence=0.7).collect()}
    assert got == want and {by for _, by in got.values()} >= {"fixed", "mined"}


def test_pieces(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["" if t is None else t for t in TEXTS] + ["\u2581x", "the" * 400, "a" * 700, "  lead", "<s>", "\x00"]
    codec = pieces.codec(PIECES)
    got = codec.encode(texts)
    assert [x.tolist() for x in got] == own.encode(texts)
    assert [codec.decode(x.tolist()) for x in got] == [t.replace("\u2581", " ") for t in texts]
    d = docs(spark, TEXTS, [(None, "a b"), (3, "a")])
    rows = pieces.coded(d, PIECES).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_ids for r in rows if r.doc_id is not None} == {i: len(own.encode(t or "")) for i, t in enumerate(TEXTS)}
    assert pieces.coded(d.where("false"), PIECES).count() == 0
    column = d.select("text", pieces.encode(F.col("text"), PIECES).alias("ids")).select("text", pieces.decode(F.col("ids"), PIECES).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in column)


def test_suffix_array():
    text = np.array([3, 1, 3, 1, 3, 2, 1], np.uint32)
    assert pieces.suffix_array(text, 16).tolist() == sorted(range(7), key=lambda i: text[i:].tolist())


WORDS = {"w": lambda t: F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))}


def totals(r):
    return {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens) for x in r.totals().collect()}


def test_rollup(spark):
    r = token_rollup.TokenRollup(spark)
    first = token_rollup.counted(docs(spark, ["a b", None, "c d e\nf"]), WORDS)
    assert not r.compact() and r.totals().count() == 0
    assert r.commit("one", first) and not r.commit("one", first)
    assert totals(r) == {("s0", None, "w"): (1, 2), ("s1", "en", "w"): (1, 0), ("s0", "en", "w"): (1, 4)}
    change = spark.createDataFrame(
        [("0", "w", "revise", 1, "s9", None, 7), ("0", "w", "revise", 0, "s8", None, 9), ("2", "w", "delete", 0, None, None, None), ("77", "w", "delete", 0, None, None, None), ("1", "v", "insert", 0, "s1", "en", None), (None, "v", "insert", 0, "s7", "en", 3)],
        "doc string, tokenizer string, op string, seq int, source string, lang string, tokens long",
    )
    assert r.commit("two/\u00e9", change)
    want = {("s9", None, "w"): (1, 7), ("s1", "en", "w"): (1, 0), ("s1", "en", "v"): (1, 0), ("s7", "en", "v"): (1, 3)}
    assert totals(r) == want
    assert r.compact() and totals(r) == want and not r.commit("one", first) and not r.commit("two/\u00e9", change)
    assert r.commit("three", change.where("false")) and r.commit("four", change.where("doc = '2'"))
    assert r.compact() and totals(r) == want and not r.commit("four", change)
    assert token_rollup.TokenRollup(spark, r.path).totals().count() == 4
    assert r.commit("five", change.where("doc is null").withColumn("op", F.lit("delete")))
    assert ("s7", "en", "v") not in totals(r)


def test_documents_without_id_stay_apart(spark):
    r = token_rollup.TokenRollup(spark)
    d = docs(spark, [], [(None, "a b"), (None, "c"), (None, "a b"), (5, "a b")])
    assert r.commit("x", token_rollup.counted(d, WORDS))
    assert totals(r) == {("s0", "en", "w"): (3, 5)}


def test_of_two_writers_one_begins_again(spark, monkeypatch):
    a = token_rollup.TokenRollup(spark)
    b = token_rollup.TokenRollup(spark, a.path)
    rows = [("1", "w", "insert", "s", "en", 5)]
    schema = "doc string, tokenizer string, op string, source string, lang string, tokens long"
    write, met = token_rollup.TokenRollup._write, []

    def slow(self, last, log, version, place):
        write(self, last, log, version, place)
        if self is a and not met:  # the other writer comes between the state that was read and the claim
            met.append(version)
            assert b.commit("other", spark.createDataFrame([("1", "w", "revise", "s", "en", 7), ("2", "w", "insert", "s", "en", 1)], schema))

    monkeypatch.setattr(token_rollup.TokenRollup, "_write", slow)
    assert a.commit("mine", spark.createDataFrame(rows, schema)) and met == [1]
    assert totals(a) == {("s", "en", "w"): (2, 6)} and [x["batch"] for x in a.log()] == ["other", "mine"]
    met.clear()
    monkeypatch.setattr(token_rollup.TokenRollup, "_write", write)

    def same(self, last, log, version, place):
        write(self, last, log, version, place)
        if self is a and not met:  # ... with the same batch
            met.append(version)
            assert b.commit("twice", spark.createDataFrame(rows, schema))

    monkeypatch.setattr(token_rollup.TokenRollup, "_write", same)
    assert not a.commit("twice", spark.createDataFrame(rows, schema))
    assert totals(a) == {("s", "en", "w"): (2, 6)}


def test_token_counts_against_the_libraries(spark):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
    multi, own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(BPE)
    got = {(x.doc, x.tokenizer): x.tokens for x in token_rollup.counted(docs(spark), {"a": token_rollup.token_counter(BPE), "b": token_rollup.token_counter(path)}).collect()}
    assert got == {(str(i), k): n for i, t in enumerate(TEXTS) for k, n in (("a", len(own.encode(t or "", add_special_tokens=False).ids)), ("b", len(multi.encode_ordinary(t or ""))))}


def test_token_count_query(spark):
    """The registered query against a plain count."""
    own, multi = Encoder(BPE), RankEncoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "lang", "text").collect()
    keep = {}
    for r in rows:
        keep[r.text or ""] = min(r.doc_id, keep.get(r.text or "", r.doc_id))
    want = Counter()
    for r in rows:
        if keep[t := r.text or ""] == r.doc_id:
            for name, n in (("byte-bpe-50k", len(own.ids(t)) + t.count("\n")), ("byte-bpe-multi-50k", len(multi.ids(t)))):
                want[r.source, r.lang, name, "docs"] += 1
                want[r.source, r.lang, name, "tokens"] += n
    got = {}
    for r in op9_token_counts(spark, "/root/testdata/sf0.001").collect():
        got |= {(r.source, r.lang, r.tokenizer, "docs"): r.docs, (r.source, r.lang, r.tokenizer, "tokens"): r.tokens}
    assert got == dict(want)


def test_digest_is_of_the_normal_form(spark):
    from tickframe.llm.cuckoo import digest_of

    assert bytes(spark.range(1).select(digest_of(F.lit("a \t\n b")).alias("d")).first().d) == hashlib.sha256(b"a b").digest()


def test_pre_tokens_without_look_ahead():
    """Runs of white space leave their last character to what follows, by cuts; ids are those of the file's own library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tickframe.llm import bpe

    assert "(?!" not in bpe.PATTERN
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    encoder, library = bpe.Encoder(path), Tokenizer.from_file(path)
    for text in ("", " ", "a  b", "a \n\n b\n", "\n\n\nx  ", "a" + " " * 1500 + "b", "a\x1c\x1c b　　c", "it's   'll", "x  <|endoftext|>  y"):
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)

"""Quality classifier: a factorisation machine over hashed words, structure statistics and length."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASHED = 1 << 15
#: Structure statistics; each is a share or a logarithm, cut to 0..1.
STATS = (
    "log words", "log characters", "mean word length", "distinct words", "distinct lines", "lines per word", "upper case", "digits", "symbols", "punctuation",
    "words with symbols", "upper-case words", "words without letters", "most frequent word", "repeated pairs", "long words", "short lines", "white space", "non-ASCII", "empty",
)
WIDTH = HASHED + len(STATS)
_SYMBOL = re.compile(rb"[^A-Za-z0-9\s.,;:'\"()\x80-\xff-]")
_SYMBOLS = np.array([_SYMBOL.match(bytes([b])) is not None for b in range(256)])
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse row of a text: hashed words (case folded, weights by the root of the count, of unit
    length together) and the statistics of STATS behind them. An empty text has the last one only."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.array([WIDTH - 1]), np.ones(1)
    n, size = len(words), len(raw)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = list(counts)
    often = np.fromiter(counts.values(), float, len(counts))
    lengths = np.fromiter(map(len, distinct), float, len(distinct))
    upper = np.fromiter((w.isupper() and len(w) > 1 for w in distinct), float, len(distinct))
    letters = np.fromiter((_LETTER.search(w) is not None for w in distinct), float, len(distinct))
    symbols = np.fromiter((_SYMBOL.search(w) is not None for w in distinct), float, len(distinct))
    octets = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    pairs = len(set(zip(words, words[1:], strict=False)))
    stats = np.array(
        [
            np.log1p(n) / 12, np.log1p(size) / 16, often @ lengths / n / 15, len(counts) / n, len(set(lines)) / max(1, len(lines)), min(1.0, 10 * len(lines) / n),
            octets[65:91].sum() / size, octets[48:58].sum() / size, octets[_SYMBOLS].sum() / size, octets[[33, 44, 46, 58, 59, 63]].sum() / size,
            often @ symbols / n, often @ upper / n, 1 - often @ letters / n, often.max() / n, 1 - pairs / max(1, n - 1), often @ (lengths > 20) / n,
            sum(len(x) < 30 for x in lines) / max(1, len(lines)), octets[[9, 10, 13, 32]].sum() / size, octets[128:].sum() / size, 0.0,
        ]
    )
    index = np.fromiter((zlib.crc32(w.lower()) % HASHED for w in distinct), np.int64, len(distinct))
    weight = np.sqrt(often)
    return np.concatenate([index, HASHED + np.arange(len(STATS))]), np.concatenate([weight / np.linalg.norm(weight), np.clip(stats, 0, 1)])


class FactorisationMachine:
    """score = w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j, through a logistic. The pairs' sum is
    half the sum over factors of (sum v x)^2 - sum (v x)^2, so a row costs its non-zero entries."""

    def __init__(self, rank: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bias, self.linear, self.factors = 0.0, np.zeros(WIDTH), rng.normal(0, 0.02, (WIDTH, rank))

    def _forward(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scaled = self.factors[index] * value[:, None]
        total = np.add.reduceat(scaled, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(scaled**2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs, scaled, total

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        starts = np.cumsum([0, *[len(i) for i, _ in rows[:-1]]])
        return 1 / (1 + np.exp(-np.clip(self._forward(index, value, starts)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 15, batch: int = 64, rate: float = 0.05, decay: float = 1e-5) -> FactorisationMachine:
        """Mini-batch AdaGrad on the logistic loss."""
        rng = np.random.default_rng(11)
        share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
        self.bias = float(np.log(share / (1 - share)))
        sum_w, sum_v, sum_b = np.full(WIDTH, 1e-6), np.full(self.factors.shape, 1e-6), 1e-6
        for _ in range(epochs if len(rows) else 0):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                index, value = np.concatenate([rows[k][0] for k in pick]), np.concatenate([rows[k][1] for k in pick])
                sizes = np.array([len(rows[k][0]) for k in pick])
                starts = np.cumsum(sizes) - sizes
                z, scaled, total = self._forward(index, value, starts)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / len(pick)
                per = np.repeat(error, sizes)
                own, place = np.unique(index, return_inverse=True)
                grad_w = np.bincount(place, per * value, len(own)) + decay * self.linear[own]
                each = (per * value)[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
                grad_v = np.stack([np.bincount(place, each[:, f], len(own)) for f in range(each.shape[1])], axis=1) + decay * self.factors[own]
                sum_w[own] += grad_w**2
                sum_v[own] += grad_v**2
                grad_b = error.sum()
                sum_b += grad_b**2
                self.linear[own] -= rate * grad_w / np.sqrt(sum_w[own])
                self.factors[own] -= rate * grad_v / np.sqrt(sum_v[own])
                self.bias -= rate * grad_b / np.sqrt(sum_b)
        return self


def held_out(doc_id):
    """Whether the label of an id is kept back from training; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> FactorisationMachine:
    """Fit on at most `rows` labelled documents (the lowest by a hash of their id) that aren't held
    out. labels(doc_id, quality); null ids or labels are left out, a label other than 0 counts as 1,
    of several labels the highest, of several rows of an id the one whose text has the lowest hash.
    Features are made on the executors, and what comes to the driver is one row of them for each of at
    most `rows` ids. Texts of the sample are used whole."""
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max((F.col("quality") != 0).cast("double")).alias("y"))
    own = own.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(own), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [features(t) for t in b.t]
            yield pd.DataFrame({"doc_id": b.doc_id, "y": b.y, "i": [i.astype("<i4").tobytes() for i, _ in made], "v": [v.astype("<f4").tobytes() for _, v in made]})

    got = found.select("doc_id", "y", "t").mapInPandas(extract, "doc_id long, y double, i binary, v binary").toPandas().sort_values("doc_id", kind="stable")
    made = [(np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for i, v in zip(got.i, got.v, strict=True)]
    return FactorisationMachine().fit(made, got.y.to_numpy(float))


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """Every row of docs as (all its columns, out): 0 to 1, higher where quality is likelier. Only the
    text is looked at; a null text counts as empty and an empty one is scored too; repeated rows come
    back as often as read. The column named by out replaces one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            found = [shared.value.scores([features(t) for t in s.iloc[a : a + 256]]) for a in range(0, len(s), 256)]
            yield pd.Series(np.concatenate([np.zeros(0), *found]))

    return docs.withColumn(out, of(F.coalesce(F.col(text_col), F.lit(""))))

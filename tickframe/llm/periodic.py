"""Periodic runs of words: a sparse diagonal DP over each text."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Octets of text whose words are matched at once.
PORTION = 4_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    have, size = [], 0
    for t in texts:
        have.append(t)
        size += len(t)
        if size > PORTION:
            yield have
            have, size = [], 0
    if have:
        yield have


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64, copy=False)


def diagonals(words: np.ndarray, doc: np.ndarray, sizes: np.ndarray, min_length: int, min_repeats: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of texts that are laid end to end. words: numbers of the
    words; doc: each word's text; sizes: words of each text. Starts are places in `words`.

    A word's earlier occurrence at distance q adds one to the match length of the active diagonal q; where
    the next word has no such occurrence the diagonal ends, and is a run if it is long enough. A frequent
    word has many earlier occurrences, of which few can matter: for the lags of (k/2, k], k = 1, 2, 4, ...,
    an occurrence counts if its next k words agree too, and of these the nearest alone. (Were a nearer one,
    at d < q, within a run of smallest period q, the k >= q words would have period q and shift d, and so
    a smaller period.) So a word adds to one diagonal at most for each k, and words whose next k words are
    nowhere else in their text are left out from then on: n log n in all, whatever the frequencies. Within
    a run of min_repeats >= 3 periods the k words fit at least once."""
    at, name, found, k = np.arange(len(words)), doc * (int(words.max(initial=0)) + 1) + words, [], 1
    lag_at = np.zeros(len(words) + 1, np.int64)
    while len(at):
        order = np.sort(_numbered(name) * len(at) + np.arange(len(at)))  # by name, then by place
        name, order = order // len(at), order % len(at)
        again = np.flatnonzero(name[1:] == name[:-1])
        later, earlier = order[again + 1], order[again]
        lag = at[later] - at[earlier]
        near = (2 * lag > k) & (lag <= k)
        lag_at[at[later[near]]] = lag[near]
        found.append(_ended(lag_at, np.sort(at[later[near]]), k, min_length, min_repeats))
        lag_at[at[later[near]]] = 0
        # names of the next 2k words, where both halves are somewhere else too and a lag above k can be a run's
        names = np.full(len(words) + 1, -1, np.int64)
        names[at[later]], names[at[earlier]] = name[again], name[again]
        at = np.sort(np.unique(np.concatenate([at[later], at[earlier]])))
        at = at[(sizes[doc[at]] >= min_repeats * (k + 1)) & (at + k < len(words))]
        at = at[(names[at + k] >= 0) & (doc[np.minimum(at + k, len(words) - 1)] == doc[at])]
        name, k = names[at] * (len(words) + 1) + names[at + k], 2 * k
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _ended(lag_at: np.ndarray, at: np.ndarray, k: int, min_length: int, min_repeats: int) -> np.ndarray:
    """The runs among the diagonals of one k: stretches of places with one lag. A text's first word has no
    lag, so none goes over the end of a text."""
    if not len(at):
        return np.zeros((0, 3), np.int64)
    lag = lag_at[at]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])]))
    matched = np.diff(np.append(new, len(at)))
    period = lag[new]
    length = matched + k - 1 + period
    long_ = length >= np.maximum(min_length, min_repeats * period)
    return np.stack([at[new] - period, length, period], 1)[long_]


def _scan(texts: list[bytes], min_length: int, min_repeats: int) -> tuple[list[int], list[list[dict]], list[str]]:
    """For each text its number of words, its runs in order of start and period, and the kept words."""
    split = [t.split() for t in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    number = defaultdict(itertools.count().__next__)
    words = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    runs = diagonals(words, doc, sizes, min_length, min_repeats)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(depth[:-1]) == 0
    first, of = np.cumsum(sizes) - sizes, doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    own: list[list[dict]] = [[] for _ in texts]
    for d, (start, length, period) in zip(of.tolist(), runs.tolist(), strict=True):
        own[d].append({"start": start - int(first[d]), "length": length, "period": period})
    out = [b" ".join(itertools.compress(w, kept[f : f + n].tolist()) if r else w).decode() for w, f, n, r in zip(split, first.tolist(), sizes.tolist(), own, strict=True)]
    return sizes.tolist(), own, out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_repeats: int = 4) -> DataFrame:
    """Every row of docs as (doc_id, n_words, runs, collapsed). Words are what ASCII white space parts.

    runs: in order of start and period, every stretch of words of at least min_length words and of
    min_repeats (3 or more) of its smallest period, that no word beside it extends. collapsed: the words
    that no run holds after its first period, joined by one space.

    Texts are scanned whole, each by one task, in memory linear in the text; nothing is shuffled. A null or
    empty text has no words, no runs and an empty collapsed text; repeated rows come back as often as
    read; null ids stay null; an empty table gives an empty result; other columns aren't looked at."""
    if min_repeats < 3:
        raise ValueError("runs of fewer than three periods aren't found")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = 0
            for texts in _portions([t.encode("utf-8", "surrogatepass") for t in b.text]):
                n, runs, collapsed = _scan(texts, min_length, min_repeats)
                yield pd.DataFrame({"doc_id": b.doc_id.iloc[at : at + len(texts)].astype("Int64").to_numpy(), "n_words": n, "runs": runs, "collapsed": collapsed}).astype({"doc_id": "Int64"})
                at += len(texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")

"""Byte-level BPE ids straight into numpy arrays."""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import tiktoken

#: The pre-token pattern that belongs to the vocabulary (fixed value), but for its `\s+(?!\S)`, which leaves the
#: last character of a run of white space to what follows: texts are cut there instead, as a pattern that looks
#: ahead takes the slower of the engine's two ways and keeps a place to go back to for each character of a run.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
#: Unicode white space, as \s of the pattern above means it; Python's own \s has four more characters.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where a run of two or more ends before something else, its last character apart.
_RUN = re.compile(f"[{_WHITE}](?=[{_WHITE}][^{_WHITE}])")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable bytes for themselves, the others
    from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Bpe:
    """The merges of a vocabulary, on texts without added tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self._bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> np.ndarray:
        """A stretch without added tokens, in parts that begin with the last character of a run of white space."""
        cuts = [0, *[m.end() for m in _RUN.finditer(text)], len(text)]
        parts = [np.array(self._bpe.encode_ordinary(text[a:z]), "<u4") for a, z in zip(cuts, cuts[1:], strict=False)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class RankEncoder(_Bpe):
    """ids by a file of ranks (a token in base 64 and its id on each line), which has no added tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            super().__init__({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)})

    def ids(self, text: str) -> np.ndarray:
        return self._plain(text)


class Encoder(_Bpe):
    """ids of texts by a vocabulary file in JSON, equal to those of that file's own library with
    add_special_tokens=False, whose merges take several times as long.

    The strings of the file's added tokens become these tokens where a text holds them, as that
    library's default has it; with special_as_text they are ordinary text."""

    def __init__(self, path: str, special_as_text: bool = False):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        added = {x["content"]: x["id"] for x in model.get("added_tokens", ())}
        letters = _byte_letters()
        #: The highest id, and the octets of each token but the added ones.
        self.most = max([*model["model"]["vocab"].values(), *added.values()])
        self.octets = {i: bytes(letters[c] for c in token) for token, i in model["model"]["vocab"].items() if token not in added}
        super().__init__({token: i for i, token in self.octets.items()})
        self._added = {} if special_as_text else added
        self._split = re.compile("|".join(map(re.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None

    def ids(self, text: str) -> np.ndarray:
        if self._split is None or not (cuts := list(self._split.finditer(text))):
            return self._plain(text)
        parts, at = [], 0
        for m in cuts:
            parts += [self._plain(text[at : m.start()]), np.array([self._added[m[0]]], "<u4")]
            at = m.end()
        return np.concatenate([*parts, self._plain(text[at:])])

"""Token ids of a byte-level vocabulary, as little-endian bytes.

Whole texts go through a compiled encoder that knows the vocabulary's pattern and ranks. Texts that it wouldn't read as
the vocabulary's own tokenizer does, or not in time that grows with their length, go through that tokenizer.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Merging a piece of so many bytes takes time that grows with its square.
LONG_RUN = 400
_LONG = re.compile(rf"\S{{{LONG_RUN},}}|\s{{{LONG_RUN},}}").search
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if chr(b) not in out]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


def long_runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text of a run of texts, whether it may hold LONG_RUN bytes without white space, or of nothing else."""
    if not len(data):
        return np.zeros(len(offsets) - 1, bool)
    space = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] != space[:-1]
    cut[offsets] = True
    border = np.flatnonzero(cut)
    begin = border[:-1]
    far = np.flatnonzero(np.diff(border) >= LONG_RUN)
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, begin[far], side="right") - 1] = True
    return out


class ByteIds:
    """Call with a text: its ids, four bytes each."""

    _made: dict[str, ByteIds] = {}

    @classmethod
    def of(cls, model: str) -> ByteIds:
        """One per worker process and vocabulary file."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        with open(model, encoding="utf-8") as f:
            spec = json.load(f)
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, specials))).search if specials else None
        byte = byte_alphabet()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in specials}
        self.encode = tiktoken.Encoding("byte-ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.model = model

    @cached_property
    def whole(self) -> Tokenizer:
        """The vocabulary's own tokenizer, made when a text asks for it."""
        out = Tokenizer.from_file(self.model)
        out.no_truncation()
        out.no_padding()
        return out

    def __call__(self, text: str, long: bool | None = None) -> bytes:
        """``long`` says whether the text may hold a long run; where nobody says, it is looked for."""
        if not text:
            return b""
        if (_LONG(text) if long is None else long) or (self.special and "<" in text and self.special(text)):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        return array("I", ids).tobytes()

"""BPE encoding by a pair occurrence index, and decoding, for vocabularies with a word-end suffix."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_ids import byte_alphabet
from .shared import tidied
from .words import slices

MODEL = public_tokenizers.path("word_bpe_49k.json")
#: White space as the vocabulary's normaliser and pattern have it.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+"
_TOKENS = regex.compile(_PATTERN).findall
_TOKENS_OF_LINES = regex.compile(_PATTERN + r"|\n").findall
_WHITE_RUN = regex.compile(f"[{_WHITE}]+")


class Bpe:
    """A vocabulary file: words to ids by its merges, ids to text as that file's decoder has it."""

    _made: dict[str, Bpe] = {}

    @classmethod
    def of(cls, model: str) -> Bpe:
        """One per worker process and vocabulary file."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        with open(model, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.decimal = {i: str(i) for i in self.token}
        end = spec["model"]["end_of_word_suffix"] or ""
        self.of_byte = {b: c for c, b in byte_alphabet().items()}
        # Symbols of bytes inside words, of bytes that end words, and of the gap between two words.
        self.symbol = np.full(513, -1, np.int64)
        for b, c in self.of_byte.items():
            self.symbol[b], self.symbol[256 + b] = vocab.get(c, -1), vocab.get(c + end, -1)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.wide = 1 << max(vocab.values()).bit_length()
        self.rank: dict[int, tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            self.rank[vocab[a] * self.wide + vocab[b]] = (r, vocab[a + b])
        # Ranks of pairs of bytes, to begin with.
        self.first_rank = np.full((513, 513), -1, np.int32)
        place = {int(v): i for i, v in enumerate(self.symbol) if v >= 0}
        for key, (r, _) in self.rank.items():
            x, y = place.get(key // self.wide), place.get(key % self.wide)
            if x is not None and y is not None:
                self.first_rank[x, y] = r
        self.pair = [vocab[a] * self.wide + vocab[b] for a, b in merges]
        self.product = [vocab[a + b] for a, b in merges]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words merged together.

        The symbols of all words stand in one list, words apart. An index maps the rank of each mergeable pair to
        the positions where that pair stands. The lowest rank that is active is applied at its positions from left
        to right, and the pairs to both sides of each merge enter the index under their own ranks. Where such a
        new pair has a lower rank than the one being applied, its word's remaining positions wait for it.
        """
        if not words:
            return []
        data = [w.encode() for w in words]
        long = np.array([len(d) for d in data])
        flat = np.frombuffer(b"\0".join(data) + b"\0", np.uint8).astype(np.int64)
        gap = np.cumsum(long + 1) - 1
        begin = gap - long
        flat[(gap - 1)[long > 0]] += 256
        flat[gap] = 512
        if (absent := self.symbol[flat] < 0)[flat < 512].any():
            absent[gap] = False  # the vocabulary has no symbol for such a byte; it is left out
            shift = np.cumsum(absent)
            begin, gap = begin - np.concatenate(([0], shift))[begin], gap - shift[gap]
            flat = flat[~absent]
        n = len(flat)
        first = self.first_rank[flat[:-1], flat[1:]]
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        ranks, cut = np.unique(first[at], return_index=True)
        index = {int(r): x.tolist() for r, x in zip(ranks, np.split(at, cut[1:]), strict=True)} if len(at) else {}
        sym = self.symbol[flat].tolist()
        sym.append(-1)
        word_of = np.repeat(np.arange(len(words)), gap - begin + 1).tolist()
        right = list(range(1, n + 2))
        left = list(range(-1, n))
        wide, rank, pairs, product = self.wide, self.rank.get, self.pair, self.product
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            places = index.pop(r)
            places.sort()
            pair, new = pairs[r], product[r]
            wait: set[int] = set()
            later: list[int] = []
            for i in places:
                if wait and word_of[i] in wait:
                    later.append(i)
                    continue
                j = right[i]
                x = sym[i]
                if x < 0 or x * wide + sym[j] != pair:
                    continue
                k = right[j]
                sym[i], sym[j] = new, -2
                right[i] = k
                left[k] = i
                h = left[i]
                if (x := sym[h]) >= 0 and (found := rank(x * wide + new)):
                    q = found[0]
                    if q in index:
                        index[q].append(h)
                    else:
                        index[q] = [h]
                        heapq.heappush(active, q)
                    if q < r:
                        wait.add(word_of[i])
                if (x := sym[k]) >= 0 and (found := rank(new * wide + x)):
                    q = found[0]
                    if q in index:
                        index[q].append(i)
                    else:
                        index[q] = [i]
                        heapq.heappush(active, q)
                    if q < r:
                        wait.add(word_of[i])
            if later:
                if r in index:
                    index[r] += later
                else:
                    index[r] = later
                    heapq.heappush(active, r)
        # What is left of the list, in order: merged symbols stand at the first of their places.
        kept = np.array(sym[:n])
        here = np.flatnonzero(kept >= 0)
        bounds = np.searchsorted(here, np.append(begin, n)).tolist()
        ids = kept[here].tolist()
        return [ids[bounds[w] : bounds[w + 1]] for w in range(len(words))]

    def words(self, text: str) -> list[str | int]:
        """The words of a text after its normaliser and pattern; a special token's text is its id."""
        if self.special and "<" in text and (parts := self.special.split(text))[1:]:
            return [x for i, p in enumerate(parts) for x in ([self.specials[p]] if i % 2 else self.words(p) if p else [])]
        return _TOKENS(self.lowered(text))

    @staticmethod
    def lowered(text: str) -> str:
        """The vocabulary's normal form. Each character is lower-cased for itself, so a final sigma is as any other."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.words(t) for t in texts]
        distinct = list({w for ws in cut for w in ws if isinstance(w, str)})
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True))
        return [[i for w in ws for i in ([w] if isinstance(w, int) else ids[w])] for ws in cut]

    def decode(self, ids: list[int]) -> str:
        """This vocabulary has no decoder of its own: its tokens are joined by spaces."""
        return " ".join([self.token[i] for i in ids if i in self.token])


class Parts:
    """What texts are made of, kept: decimal ids and decoded text of each part between white space, and of each word.

    Most parts are one word, perhaps with marks. Words are what is encoded, so "word," and "Word." encode "word" once,
    and a part of one word holds the very strings of that word.
    """

    #: Bytes that parts, and words, of one generation take, about; one older generation of each is kept beside it.
    MOST_BYTES = 56 << 20
    #: What an entry takes besides its characters.
    ENTRY = 250
    #: Longer ones (in scripts without spaces) are encoded anew each time.
    LONGEST = 128
    #: Words that are merged in one index. Few enough to stay in the processor's cache.
    TOGETHER = 2500

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.ids: dict[str, str] = {}
        self.text: dict[str, str] = {}
        self.older: tuple[dict[str, str], dict[str, str]] = ({}, {})
        self.long: set[str] = set()
        #: Of words the same; a line end stands for itself.
        self.word_ids: dict[str, str] = {"\n": "\n"}
        self.word_text: dict[str, str] = {"\n": "\n"}
        self.older_words: tuple[dict[str, str], dict[str, str]] = ({}, {})
        self.hollow = False  # whether there are words of which nothing is in the vocabulary
        self.bytes = {"parts": 0, "words": 0}

    def _forget_long(self) -> None:
        for into in (self.ids, self.text, self.word_ids, self.word_text):
            for p in self.long:
                into.pop(p, None)
        self.long.clear()

    def _count(self, kind: str, keys: Iterable[str], ids: dict[str, str], text: dict[str, str]) -> None:
        """Take new entries into account, and note the long ones, which go with the next call."""
        n = 0
        for p in keys:
            if len(p) > self.LONGEST:
                self.long.add(p)
            else:
                n += len(p) + len(ids[p]) + len(text[p]) + self.ENTRY
        self.bytes[kind] += n

    def know(self, parts: set[str]) -> None:
        """See to it that each of these parts has its ids and text."""
        self._forget_long()
        if self.bytes["parts"] > self.MOST_BYTES:
            self.older = self.ids, self.text
            self.ids, self.text = {}, {}
            self.bytes["parts"] = 0
        new = parts.difference(self.ids)
        old_ids, old_text = self.older
        again = new.intersection(old_ids)
        for p in again:
            self.ids[p], self.text[p] = old_ids[p], old_text[p]
        self._count("parts", again, self.ids, self.text)
        new = new.difference(old_ids)
        special = self.bpe.special
        odd = [p for p in new if "<" in p and special and special.search(p)]
        for p in odd:
            found = self.bpe.encode([p])[0]
            self.ids[p], self.text[p] = " ".join(map(str, found)), self.bpe.decode(found)
        self._count("parts", odd, self.ids, self.text)
        plain = list(new.difference(odd))
        if not plain:
            return
        # One pass over all parts; a line end stands between two, and comes out as a word of its own.
        flat = _TOKENS_OF_LINES(self.bpe.lowered("\n".join(plain)))
        self._know_words(set(flat))
        for into, words in ((self.ids, self.word_ids), (self.text, self.word_text)):
            lines = " ".join(map(words.__getitem__, flat)).split(" \n ")
            if self.hollow:
                lines = [" ".join(filter(None, x.split(" "))) for x in lines]
            into.update(zip(plain, lines, strict=True))
        self._count("parts", plain, self.ids, self.text)

    def _know_words(self, words: set[str]) -> None:
        """See to it that each of these words has its ids and text: those not met lately are encoded, some thousands together."""
        if self.bytes["words"] > self.MOST_BYTES:
            self.older_words = self.word_ids, self.word_text
            self.word_ids, self.word_text = {"\n": "\n"}, {"\n": "\n"}
            self.bytes["words"] = 0
        new = words.difference(self.word_ids)
        old_ids, old_text = self.older_words
        again = new.intersection(old_ids)
        for w in again:
            self.word_ids[w], self.word_text[w] = old_ids[w], old_text[w]
        self._count("words", again, self.word_ids, self.word_text)
        new = sorted(new.difference(old_ids))
        for at in range(0, len(new), self.TOGETHER):
            some = new[at : at + self.TOGETHER]
            found = self.bpe.encode_words(some)
            self.hollow |= not all(found)
            decimal, token = self.bpe.decimal.__getitem__, self.bpe.token.__getitem__
            self.word_ids.update(zip(some, [" ".join(map(decimal, ids)) for ids in found], strict=True))
            self.word_text.update(zip(some, [" ".join(map(token, ids)) for ids in found], strict=True))
        self._count("words", new, self.word_ids, self.word_text)


_parts: dict[str, Parts] = {}
#: So much text is cut into words together.
TOGETHER_BYTES = 1 << 20
#: White space to Python that the vocabulary takes for marks.
_SEPARATORS = re.compile("[\x1c-\x1f]").search


def _digests(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _parts:
            _parts[model] = Parts(Bpe.of(model))
        known = _parts[model]
        sha = hashlib.sha256
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), TOGETHER_BYTES):
                flat = data.tobytes()
                texts = [flat[offsets[i] : offsets[i + 1]].decode() for i in range(hi - lo)]
                # White space of any kind ends a word, and none combines with what follows.
                docs = [[p for p in _WHITE_RUN.split(t) if p] if _SEPARATORS(t) else t.split() for t in texts]
                known.know(set().union(*docs))
                ids_of, text_of = known.ids.__getitem__, known.text.__getitem__
                n, ids_sha, text_sha = [], [], []
                for parts in docs:
                    ids = " ".join(filter(None, map(ids_of, parts)))
                    n.append(ids.count(" ") + 1 if ids else 0)
                    ids_sha.append(sha(ids.encode()).hexdigest())
                    text_sha.append(sha(" ".join(filter(None, map(text_of, parts))).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _map_column(model: str, make: Callable[[Bpe, list], list], kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(make(bpe, part.column(1).to_pylist()), kind)], ["doc_id", "out"])

    return run


def bpe_encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text. A null text counts as empty and has none."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run = _map_column(model, lambda bpe, texts: bpe.encode([t or "" for t in texts]), pa.list_(pa.int32()))
    return rows.mapInArrow(tidied(run), "doc_id long, out array<int>").withColumnRenamed("out", "ids")


def bpe_decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of token ids, special tokens shown; null ids are no ids, unknown ids are left out."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    run = _map_column(model, lambda bpe, rows: [bpe.decode(r or []) for r in rows], pa.string())
    return rows.mapInArrow(tidied(run), "doc_id long, out string").withColumnRenamed("out", "text")


def bpe_digests(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; texts are encoded and decoded whole.

    Ids are those of the vocabulary file's own library without special tokens added. Texts are cut at white space.
    The distinct words of a megabyte of text are encoded together, some thousands in one index, and those met
    lately are kept, up to a fixed number of bytes, for the rows to come; those of more than LONGEST characters aren't. Nothing is shuffled.

    Defined cases: a null text counts as empty: no tokens, and both digests are of nothing; special tokens written
    out in a text are taken as such, as the library does; a null id stays null; rows that repeat an id each
    give a row; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_digests(model)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

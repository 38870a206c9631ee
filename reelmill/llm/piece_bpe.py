"""SentencePiece encoding of merge-type models by backtracking over longest matches, and decoding."""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import tidied
from .words import slices

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Between the words of one call; no piece may hold it.
GAP = "\0"
#: Kinds of pieces and fields of the model file's messages: fixed values of the format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, SUFFIX_SPACE = 3, 35, 24
CHARSMAP, DUMMY_PREFIX, TRIMMED, ESCAPED = 2, 3, 4, 5
MERGE_TYPE = 2
UNKNOWN_SURFACE = " ⁇ "

codecs.register_error("reelmill-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message: numbers of varints, bytes of everything else."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        if not key & 7:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


class PieceBpe:
    """A model file of the merge type: text to ids as its library encodes, ids to text as it decodes.

    The library merges neighbours again and again, the best-scored piece first and of equal ones the leftmost. What comes
    out of that is found here without merging: a text has one split into pieces in which every two neighbours stay
    apart when they are merged anew from characters, and that split is searched from left to right.
    """

    _made: dict[str, PieceBpe] = {}

    @classmethod
    def of(cls, model: str) -> PieceBpe:
        """One per worker process and model file."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        with open(model, "rb") as f:
            parts = list(_fields(f.read()))
        rows = [dict(_fields(v)) for k, v in parts if k == PIECES]
        trainer, rule = (dict(_fields(v)) for want in (TRAINER, NORMALIZER) for k, v in parts if k == want)
        if trainer.get(MODEL_TYPE) != MERGE_TYPE or not trainer.get(BYTE_FALLBACK) or trainer.get(SUFFIX_SPACE):
            raise ValueError(f"{model}: not a merge-type model with byte fallback")
        if rule.get(CHARSMAP) or not rule.get(DUMMY_PREFIX, 1) or rule.get(TRIMMED, 1) or not rule.get(ESCAPED, 1):
            raise ValueError(f"{model}: only the identity normaliser with a space in front is known here")
        self.piece = [r[1].decode() for r in rows]
        kind = [r.get(3, NORMAL) for r in rows]
        if set(kind) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{model}: user-defined or unused pieces")
        self.kind = kind
        self.byte = {i: int(p[3:5], 16) for i, (p, k) in enumerate(zip(self.piece, kind, strict=True)) if k == BYTE}
        self.of_byte = {b: i for i, b in self.byte.items()}
        self.decimal = [str(i) for i in range(len(rows))]
        #: What ids show, bytes aside.
        self.shown = [None if k == BYTE else UNKNOWN_SURFACE if k == UNKNOWN else "" if k == CONTROL else p.replace(SPACE, " ") for p, k in zip(self.piece, kind, strict=True)]
        score = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        self.id = {p: i for i, (p, k) in enumerate(zip(self.piece, kind, strict=True)) if k == NORMAL}
        several = sorted((i for p, i in self.id.items() if len(p) > 1), key=lambda i: -score[i])
        if any(GAP in p for p in self.id):
            raise ValueError(f"{model}: a piece holds the character 0")
        # Runs of spaces share the lowest score of all, so they are merged when nothing else is left to merge.
        late = [i for i in several if score[i] == score[several[-1]]] if len(several) > 1 and score[several[-1]] == score[several[-2]] else []
        self.runs = {len(self.piece[i]): i for i in late} | ({1: self.id[SPACE]} if SPACE in self.id else {})
        early = several[: len(several) - len(late)]
        if any(set(self.piece[i]) != {SPACE} for i in late) or any(SPACE * 2 in self.piece[i] for i in early) or len({score[i] for i in early}) != len(early):
            raise ValueError(f"{model}: pieces of equal scores")
        self._learn(early)
        # Where no piece goes on, a text may be cut: before a space that follows something else, and at line ends.
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.id):
            raise ValueError(f"{model}: pieces with spaces or line ends inside")
        self._space_runs: dict[int, list[int]] = {}
        self._fit: dict[int, bool] = {}

    def _learn(self, early: list[int]) -> None:
        """How each piece comes about, from the best score down: the one split into earlier pieces that stay apart until it is made."""
        n = len(self.piece)
        self.rank, self.head, self.tail = [-1] * n, [-1] * n, [-1] * n
        self.wide = n
        self.joined: dict[int, int] = {}
        self._fit = {}
        made = {p: i for p, i in self.id.items() if len(p) == 1}
        for r, i in enumerate(early):
            p = self.piece[i]
            for k in range(1, len(p)):
                a, b = made.get(p[:k]), made.get(p[k:])
                if a is not None and b is not None and self._stay_apart(a, b):
                    self.rank[i], self.head[i], self.tail[i] = r, a, b
                    self.joined[a * n + b] = i
                    made[p] = i
                    break
        # A piece that no merging makes is none; its characters may still be in others.
        self.longest_first = ahocorasick.Automaton()
        self.shorter, self.length = [-1] * n, [0] * n
        for p, i in made.items():
            self.longest_first.add_word(p[::-1], i)
            self.length[i] = len(p)
            for k in range(len(p) - 1, 0, -1):
                if (q := made.get(p[:k])) is not None:
                    self.shorter[i] = q
                    break
        self.longest_first.make_automaton()

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the characters of both pieces anew ends with these two.

        Their last merges are undone in turn, the later one first, and the symbols on both sides of the border looked
        at: where these make a piece that would have been merged before what was just undone, the border falls.
        """
        rank, joined, wide = self.rank, self.joined, self.wide
        before = 1 << 60  # twice a rank, and one more where a tie goes to the border: it is left of the right side's merges
        while True:
            t = joined.get(a * wide + b)
            if t is not None and 2 * rank[t] < before:
                return False
            x, y = rank[a], rank[b]
            if x > y:
                before, a = 2 * x, self.tail[a]
            elif y >= 0:
                before, b = 2 * y + 1, self.head[b]
            else:
                return True

    #: Pairs of pieces whose answer is remembered.
    MOST_PAIRS = 1 << 20

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of normalised words, each for itself.

        One automaton over the reversed pieces, run over the reversed words, gives for every place the longest piece
        that begins there. From a word's begin the longest piece is taken that stays apart from the piece before and
        doesn't end where nothing goes on; where none is left, the place is marked as failed in a field of bits and the
        piece before gives way to a shorter one. A place fails for good, since all that stands before it has one split.
        """
        text = GAP.join(words)
        n = len(text)
        longest = array("i", [-1]) * n
        last = -1
        for at, i in self.longest_first.iter(text[::-1]):
            if at != last:  # of the matches that end at a place, the longest comes first
                longest[n - 1 - at] = i
                last = at
        failed = bytearray((n >> 3) + 1)
        length, shorter, fit, wide = self.length, self.shorter, self._fit, self.wide
        if len(fit) > self.MOST_PAIRS:
            fit.clear()
        out = []
        begin = 0
        for word in words:
            at, end = begin, begin + len(word)
            ids: list[int] = []
            before = -1  # nothing, or a character without a piece: whatever follows stays apart from it
            token = longest[at] if at < end else -1
            while at < end:
                if token < 0:
                    ids += [self.of_byte[b] for b in text[at].encode()]
                    at, before = at + 1, -1
                    token = longest[at] if at < end else -1
                    continue
                while token >= 0:
                    to = at + length[token]
                    if not failed[to >> 3] >> (to & 7) & 1:
                        if before < 0:
                            break
                        key = before * wide + token
                        ok = fit.get(key)
                        if ok is None:
                            ok = fit[key] = self._stay_apart(before, token)
                        if ok:
                            break
                    token = shorter[token]
                if token >= 0:
                    ids.append(token)
                    at, before = to, token
                    token = longest[at] if at < end else -1
                else:
                    failed[at >> 3] |= 1 << (at & 7)
                    token = ids.pop()
                    at -= length[token]
                    # At a word's begin or after bytes there is nothing that has to stay apart.
                    before = ids[-1] if at > begin and longest[at - 1] >= 0 and ids else -1
            out.append(self._with_runs(ids) if SPACE in word else ids)
            begin = end + 1
        return out

    def _with_runs(self, ids: list[int]) -> list[int]:
        """Spaces that stayed alone, merged into runs."""
        one = self.runs.get(1, -1)
        if len(self.runs) < 2 or ids.count(one) < 2:
            return ids
        out: list[int] = []
        n = 0
        for i in [*ids, -1]:
            if i == one:
                n += 1
                continue
            if n:
                if n not in self._space_runs and n <= 4096:
                    self._space_runs[n] = self._run(n)
                out += self._space_runs.get(n) or self._run(n)
                n = 0
            out.append(i)
        return out[:-1]

    def _run(self, n: int) -> list[int]:
        """Ids of n spaces: all runs have one score, so the leftmost two that make a run are merged each time."""
        runs, stack = self.runs, []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in runs:
                top = stack.pop()
                stack[-1] += top
        return [runs[k] for k in stack]

    def normal(self, text: str) -> str:
        """Spaces as the model has them, with one in front; an empty text stays empty."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [CHUNKS(self.normal(t)) for t in texts]
        distinct = list({c for cs in cut for c in cs})
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True))
        return [[i for c in cs for i in ids[c]] for cs in cut]

    def surface(self, ids: list[int]) -> str:
        """Text of ids, the space in front still there; bytes that are no UTF-8 become U+FFFD each, ids of no piece are left out."""
        out: list[str] = []
        held = bytearray()
        shown, most = self.shown, len(self.shown)
        for i in ids:
            if not 0 <= i < most:
                continue
            piece = shown[i]
            if piece is None:
                held.append(self.byte[i])
                continue
            if held:
                out.append(held.decode("utf-8", "reelmill-each-byte"))
                held.clear()
            out.append(piece)
        if held:
            out.append(held.decode("utf-8", "reelmill-each-byte"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids as the library gives it: one space in front is dropped, where the first piece that shows has it."""
        text = self.surface(ids)
        first = next((i for i in ids if 0 <= i < len(self.piece) and self.kind[i] != CONTROL), -1)
        return text[1:] if first >= 0 and self.kind[first] == NORMAL and text.startswith(" ") else text


#: A run of spaces with the word that follows it, or a line end: no piece goes across their borders.
CHUNKS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall


class Chunks:
    """Ids of the chunks met lately, as decimals joined by commas; what is kept is bounded in bytes."""

    #: Bytes that keys and values of one generation take, about; one older generation is kept beside it.
    MOST_BYTES = 96 << 20
    #: What an entry takes besides its characters.
    ENTRY = 200
    #: Longer chunks (texts without spaces) are encoded and forgotten.
    LONGEST = 128
    #: Characters of new chunks that are encoded in one call.
    TOGETHER = 1 << 17

    def __init__(self, model: PieceBpe):
        self.model = model
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.bytes = 0
        #: Decoded text of the chunks whose ids don't decode to the chunk itself with its spaces as they were.
        self.changed: dict[str, str] = {}

    def look_up(self, chunks: set[str]) -> dict[str, str]:
        """A table that has all of these chunks: the one that is kept, or one for this call where some are too long to keep."""
        if self.bytes > self.MOST_BYTES:
            self.older, self.known, self.bytes = self.known, {}, 0
            self.changed = {c: x for c, x in self.changed.items() if c in self.older}
        known, older = self.known, self.older
        new = chunks.difference(known)
        if older:
            again = new.intersection(older)
            new -= again
            known.update(zip(again, map(older.__getitem__, again)))
            self.bytes += sum(map(len, again)) + self.ENTRY * len(again)
        long = [c for c in new if len(c) > self.LONGEST]
        new.difference_update(long)
        found: dict[str, str] = {}
        for some in (*self._groups(list(new)), *([c] for c in long)):
            ids = self.model.encode_words(some)
            decimal = self.model.decimal.__getitem__
            found.update(zip(some, [",".join(map(decimal, x)) for x in ids]))
            self.changed.update({c: x for c, x in zip(some, map(self.model.surface, ids)) if c.replace(SPACE, " ") != x})
        if not long:
            known.update(found)
            self.bytes += sum(map(len, found)) + self.ENTRY * len(found)
            return known
        return {c: found[c] if c in found else known[c] for c in chunks}

    def _groups(self, chunks: list[str]) -> Iterator[list[str]]:
        step = max(1, self.TOGETHER * len(chunks) // (sum(map(len, chunks)) + 1))
        return (chunks[i : i + step] for i in range(0, len(chunks), step))

    def text(self, chunks: list[str]) -> str:
        """What the chunks' ids decode to, without the space in front."""
        if self.changed and not self.changed.keys().isdisjoint(chunks):
            chunks = [self.changed.get(c, c) for c in chunks]
        return "".join(chunks).replace(SPACE, " ")[1:]


_chunks: dict[str, Chunks] = {}
#: So much text is cut into chunks together.
TOGETHER_BYTES = 1 << 20


def _digests(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _chunks.setdefault(model, Chunks(PieceBpe.of(model)))
        sha = hashlib.sha256
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), TOGETHER_BYTES):
                flat = data.tobytes()
                docs = [CHUNKS(known.model.normal(flat[offsets[i] : offsets[i + 1]].decode())) for i in range(hi - lo)]
                of = known.look_up(set().union(*docs)).__getitem__
                n, ids_sha, text_sha = [], [], []
                for chunks in docs:
                    ids = ",".join(map(of, chunks))
                    n.append(ids.count(",") + 1 if ids else 0)
                    ids_sha.append(sha(ids.encode()).hexdigest())
                    text_sha.append(sha(known.text(chunks).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _map_column(model: str, make: Callable[[PieceBpe, list], list], kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PieceBpe.of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(make(known, part.column(1).to_pylist()), kind)], ["doc_id", "out"])

    return run


def piece_encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the piece ids of every whole text, without begin or end ids. A null text counts as empty and has none."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run = _map_column(model, lambda known, texts: known.encode([t or "" for t in texts]), pa.list_(pa.int32()))
    return rows.mapInArrow(tidied(run), "doc_id long, out array<int>").withColumnRenamed("out", "ids")


def piece_decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of piece ids; null ids are no ids, ids of no piece and null ones are left out."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    run = _map_column(model, lambda known, rows: [known.decode([i for i in r or [] if i is not None]) for r in rows], pa.string())
    return rows.mapInArrow(tidied(run), "doc_id long, out string").withColumnRenamed("out", "text")


def piece_digests(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; texts are encoded and decoded whole.

    Texts are cut where no piece of the model goes across: before spaces and at line ends. The distinct chunks of a
    megabyte of text are encoded together, and those met lately are kept, up to a fixed number of characters, for the rows to
    come; long chunks aren't kept. Nothing is shuffled, and a lost task is done again from its rows alone.

    Defined cases: a null text counts as empty: no pieces, and both digests are of nothing; characters without a piece
    become their UTF-8 bytes; the names of control pieces written out in a text are ordinary text; a null id stays
    null; rows that repeat an id each give a row; an empty table gives no rows; other columns are ignored. A model
    file of another type, or with rules that aren't known here, is refused.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_digests(model)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

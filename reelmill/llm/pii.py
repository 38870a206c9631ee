"""Personal data: patterns for what has a fixed form, and a linear-chain conditional random field for what hasn't."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pii_table import LABELLED
from .shared import place_of, tidied
from .words import Words, slices

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("name", "address", "secret")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+").match
# Possessive, and never begun inside a run of digits: the same matches, found in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]").search
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    """Whether a run of digits, however long, is a number of at most 255."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Each sign with the run of name characters before it and the domain after it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            # A failed run before this sign can't reach over it.
            done = max(done, at + 1) if start == at else at + 1
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind by its pattern, leftmost and non-overlapping, without the matches that fail their test."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if _DIGIT(text):
        if "." in text:
            out["ip"] = [m.span() for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


# ---- the random field -------------------------------------------------------------------------------------------

LABELS = ["O", *(f"{p}-{k}" for k in ADDED_KINDS for p in "BI")]
#: Words that say what follows, or what something is. Fixed values.
CUES = (
    "mr mrs ms miss dr prof sir madam herr frau monsieur madame señor señora name named contact contacted signed author sincerely regards dear "
    "street st avenue ave road rd lane ln drive boulevard blvd square straße strasse platz rue calle plaza avenida address lives apt suite floor "
    "password passwd pwd passphrase token secret key apikey api_key api-key access_key credential login user username pin bearer = : is"
).split()

_MARK = re.compile(r"\[\[(\w+)\|(.+?)\]\]")


def labelled_rows(table: str = LABELLED) -> list[tuple[list[str], list[str]]]:
    """Words and labels of each line of a table in which spans stand as [[kind|text]]."""
    rows = []
    for line in table.strip().split("\n"):
        plain, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            plain += line[at : m.start()]
            spans.append((len(plain), len(plain) + len(m[2]), m[1]))
            plain += m[2]
            at = m.end()
        plain += line[at:]
        words, labels = [], []
        for w in re.finditer(r"\S+", plain):
            inside = next(((s, k) for s, e, k in spans if s < w.end() and w.start() < e), None)
            words.append(w.group())
            labels.append("O" if inside is None else f"{'B' if inside[0] >= w.start() else 'I'}-{inside[1]}")
        rows.append((words, labels))
    return rows


SHAPES = 1 << 14


def shapes(w: Words) -> np.ndarray:
    """A code for the shape of each word: what it begins and ends with, what it holds, and how long it is."""
    raw, starts, ends = w.raw, w.starts, w.ends
    if not len(starts):
        return np.zeros(0, np.int64)
    kind = _KIND[raw]
    quote = kind[starts] == 5
    first = kind[np.minimum(starts + quote, ends - 1)]
    last = kind[ends - 1]
    size = ends - starts
    bucket = np.searchsorted([2, 4, 8, 12, 16, 24], size, side="right")
    held = np.zeros(len(starts), np.int64)
    for bit, member in enumerate((0, 1, 2, 6)):  # upper, lower, digit, equals
        sums = np.concatenate(([0], np.cumsum(kind == member, dtype=np.int64)))
        n = sums[ends] - sums[starts]
        if member == 0:  # one capital at the start is no mixture
            n = n - (first == 0)
        held |= (n > 0).astype(np.int64) << bit
    ending = np.select([last == 4, last == 5, last >= 6], [1, 2, 3], 0)
    return ((first * 8 + bucket) * 16 + held) * 4 + ending + 1  # 0: beyond the ends


#: upper 0, lower 1, digit 2, beyond ASCII 3, stops 4, quotes and brackets 5, equals 6, other marks 7
_KIND = np.full(256, 7, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[[ord(c) for c in ".,;:!?"]] = 4
_KIND[[ord(c) for c in "\"'()[]<>"]] = 5
_KIND[ord("=")] = 6


#: Shapes without their lengths.
COARSE = 1 << 9


def coarse(shape: np.ndarray) -> np.ndarray:
    """A shape's class without the length of its word: what words have in common that are never of one length."""
    x = shape - 1
    return np.where(shape > 0, ((x >> 9) << 6 | x & 63) + 1, 0)


def _words_of(text: str) -> Words:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)], np.int64))


@cache
def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    forms = sorted({c + end for c in CUES for end in ("", ".", ":", ",")})
    w = _words_of(" ".join(forms))
    base = {c: i + 1 for i, c in enumerate(CUES)}
    of = np.array([base.get(f, base.get(f.rstrip(".:,"), 0)) for f in forms])
    h = w.hashes()
    by = np.argsort(h)
    return h[by], of[by]


def cues(w: Words) -> np.ndarray:
    """For each word the number of the cue it is, or 0. A word with "=" inside is the cue before that sign."""
    table, of = _cue_table()
    starts, ends = w.starts, w.ends
    if not len(starts):
        return np.zeros(0, np.int64)
    sign = np.flatnonzero(w.raw == 61)
    ends = ends.copy()
    if len(sign):
        at = np.searchsorted(sign, starts)
        near = np.where(at < len(sign), sign[np.minimum(at, len(sign) - 1)], len(w.raw))
        cut = (near < ends) & (near > starts)
        ends[cut] = near[cut]
    h = w.hashes(starts, ends)
    place = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[place] == h, of[place], 0)


class Field:
    """Emission tables by shape and cue of a word and its neighbours, and transitions between labels."""

    def __init__(self) -> None:
        k, c = len(LABELS), len(CUES) + 1
        # This word's shape, the one's before and after; their coarse shapes; cues here, one and two before, and after.
        self.tables = [*(np.zeros((SHAPES, k)) for _ in range(3)), *(np.zeros((COARSE + 1, k)) for _ in range(3)), *(np.zeros((c, k)) for _ in range(4))]
        self.tables[0][:, 0] = 0.5
        self.moves = np.zeros((k, k))
        self.start = np.zeros(k)

    @staticmethod
    def columns(shape: np.ndarray, cue: np.ndarray, seq: np.ndarray) -> list[np.ndarray]:
        """For each table the row that each word takes; ``seq`` tells the sequences apart."""

        def shifted(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros_like(x)
            if by > 0:
                out[by:] = np.where(seq[by:] == seq[:-by], x[:-by], 0)
            else:
                out[:by] = np.where(seq[:by] == seq[-by:], x[-by:], 0)
            return out

        if not len(shape):
            return [shape] * 6 + [cue] * 4
        rough = coarse(shape)
        return [shape, shifted(shape, 1), shifted(shape, -1), rough, shifted(rough, 1), shifted(rough, -1), cue, shifted(cue, 1), shifted(cue, 2) if len(cue) > 2 else np.zeros_like(cue), shifted(cue, -1)]

    def emissions(self, columns: list[np.ndarray]) -> np.ndarray:
        return sum(t[c] for t, c in zip(self.tables, columns, strict=True))

    def viterbi(self, e: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The best labels of all sequences of a batch, a step for all at a time; longest first, so that the open ones are a prefix."""
        out = np.zeros(len(e), np.int8)
        if not len(size):
            return out
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        best = self.start + e[begin]
        back = []
        counts = np.searchsorted(-size, -np.arange(size[0]), side="left")  # sequences longer than each step
        for t in range(1, int(size[0])):
            n = int(counts[t])
            cand = best[:n, :, None] + self.moves
            came = cand.argmax(1)
            best[:n] = np.take_along_axis(cand, came[:, None, :], 1)[:, 0] + e[begin[:n] + t]
            back.append(came.astype(np.int8))
        label = best.argmax(1)
        for t in range(int(size[0]) - 1, -1, -1):
            n = int(counts[t])
            out[begin[:n] + t] = label[:n]
            if t:
                label[:n] = back[t - 1][np.arange(n), label[:n]]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


@cache
def trained_field(steps: int = 120, rate: float = 0.1, decay: float = 2e-3) -> Field:
    """Fit by Adam on the exact likelihood of the labelled table; the same field every time."""
    rows = labelled_rows()
    w = _words_of(" ".join(x for words, _ in rows for x in words))
    size = np.array([len(words) for words, _ in rows])
    begin = np.cumsum(size) - size
    seq = np.repeat(np.arange(len(rows)), size)
    gold = np.array([LABELS.index(x) for _, labels in rows for x in labels])
    field = Field()
    columns = Field.columns(shapes(w), cues(w), seq)
    k, n, longest = len(LABELS), len(rows), int(size.max())
    first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
    inner = np.flatnonzero(seq[1:] == seq[:-1])
    params = [*field.tables, field.moves, field.start]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    at = np.minimum(begin[:, None] + np.arange(longest), len(seq) - 1)
    live = np.arange(longest) < size[:, None]
    for step in range(1, steps + 1):
        e = field.emissions(columns)[at]
        alpha = np.zeros((n, longest, k))
        alpha[:, 0] = field.start + e[:, 0]
        for t in range(1, longest):
            new = _log_sum(alpha[:, t - 1, :, None] + field.moves, 1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
        beta = np.zeros((n, longest, k))
        for t in range(longest - 2, -1, -1):
            new = _log_sum(field.moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], new, 0)
        z = _log_sum(alpha[:, -1], 1)
        single = np.exp(alpha + beta - z[:, None, None])[live]
        pair = np.zeros((k, k))
        for t in range(1, longest):
            x = alpha[:, t - 1, :, None] + field.moves + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            pair += np.exp(x[live[:, t]]).sum(0)
        single[np.arange(len(gold)), gold] -= 1
        np.subtract.at(pair, (gold[inner], gold[inner + 1]), 1)
        grads = []
        for table, column in zip(field.tables, columns, strict=True):
            g = decay * n * table
            np.add.at(g, column, single)
            grads.append(g)
        grads += [pair + decay * n * field.moves, single[first].sum(0) + decay * n * field.start]
        for i, (p, g) in enumerate(zip(params, grads, strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p -= rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * m[i] / (np.sqrt(v[i]) + 1e-8)
    return field


_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in "\"'()[]<>.,;:!?{}"]] = True


def field_spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) in code points of each text of a run; a line is a sequence."""
    w = Words(data, offsets)
    docs = len(offsets) - 1
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(docs)]
    if not len(w.starts):
        return out
    doc = np.repeat(np.arange(docs), w.counts())
    seq = np.searchsorted(np.flatnonzero(data == 10), w.starts) + doc
    begin = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
    size = np.diff(np.append(begin, len(seq)))
    labels = field.viterbi(field.emissions(Field.columns(shapes(w), cues(w), seq)), begin, size)
    hit = np.flatnonzero(labels)
    if not len(hit):
        return out
    point = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    i = 0
    while i < len(hit):
        a = int(hit[i])
        kind = ADDED_KINDS[(labels[a] - 1) // 2]
        b = a
        while i + 1 < len(hit) and hit[i + 1] == b + 1 and seq[b + 1] == seq[a] and labels[b + 1] == 2 + 2 * ADDED_KINDS.index(kind):
            i += 1
            b += 1
        i += 1
        start, end = int(w.starts[a]), int(w.ends[b])
        if kind == "secret" and len(sign := np.flatnonzero(data[start:end] == 61)) and sign[0] + 1 < end - start:
            start += int(sign[0]) + 1
        while end - start > 1 and _TRIM[data[end - 1]]:
            end -= 1
        while end - start > 1 and _TRIM[data[start]]:
            start += 1
        d = int(doc[a])
        before = int(point[offsets[d] - 1]) if offsets[d] else 0
        out[d].append((kind, int(point[start]) - 1 - before, int(point[end - 1]) - before))
    return out


def all_spans(field: Field, texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[dict, list]]]]:
    """(first row, end row, (base spans, added spans) of each text). An added span may overlap base ones, but one that lies inside one of them gives way."""
    for lo, hi, data, offsets in slices(texts):
        flat = data.tobytes()
        rows = []
        for i, added in enumerate(field_spans(field, data, offsets)):
            base = base_spans(flat[offsets[i] : offsets[i + 1]].decode())
            taken = sorted(s for spans in base.values() for s in spans)
            rows.append((base, [x for x in added if not any(s <= x[1] and x[2] <= e for s, e in taken)]))
        yield lo, hi, rows


def _find(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, rows in all_spans(field, batch.column(1)):
                counts = [[len(base[k]) for base, _ in rows] for k in BASE_KINDS]
                base_text = [",".join(f"{k}:{s}:{e}" for k in BASE_KINDS for s, e in base[k]) for base, _ in rows]
                more = [[",".join(f"{k}:{s}:{e}" for k, s, e in added if k == kind) for kind in ADDED_KINDS] for _, added in rows]
                spans = [",".join(x for x in [b, *m] if x) for b, m in zip(base_text, more, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in counts), pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base_text], pa.string()), pa.array(spans, pa.string()), pa.array([sum(map(len, base.values())) + len(added) for base, added in rows], pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans"],
                )

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans.

    Counts and digest are of the patterns' spans. ``spans`` lists these and then the field's names, addresses
    and secrets, as kind:start:end in code points, each kind in order of start; n_spans counts them all. Whole texts are read.

    Defined cases: a null text counts as empty and has no spans (its digest is of nothing); a very long text, a long line
    or a long run of digits is read whole, in time that grows with its length; a null id stays null;
    rows that repeat an id each give a row; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_find(trained_field())), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def mask(text: str, base: dict[str, list[tuple[int, int]]], added: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, or longer, counts."""
    spans = sorted([(s, -e, k) for k in BASE_KINDS for s, e in base[k]] + [(s, -e, k) for k, s, e in added])
    out, done = [], 0
    for s, e, k in spans:
        if s >= done:
            out += [text[done:s], f"[{k.upper()}]"]
            done = -e
        else:  # what reaches beyond the span before is masked with it
            done = max(done, -e)
    out.append(text[done:])
    return "".join(out)


def _mask(field: Field, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(column)
            new: list[str | None] = []
            for lo, _, rows in all_spans(field, old):
                for i, (base, added) in enumerate(rows):
                    text = old[lo + i].as_py()
                    new.append(mask(text, base, added) if text and (added or any(base.values())) else text)
            columns = batch.columns
            columns[column] = pa.array(new, old.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the spans found in their texts masked, all columns as they were; a length column follows the text.

    Defined cases: a null text stays null, and an empty one empty; a text without spans stays as it is; rows are judged
    each for itself, whatever their ids, and none goes; an empty table gives no rows; other columns may have any names.
    """
    out = docs.mapInArrow(tidied(_mask(trained_field(), place_of(docs, text_col))), docs.schema)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else out

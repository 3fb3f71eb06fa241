"""Secret scan by a linear-chain conditional random field (operator 4).

Fixed patterns give the base spans. Beside them a chain tags every token of a
text as B (a secret begins), I (it goes on) or O (outside), from the token's
shape and word, its neighbours' shapes and words, the gap before it, and how the
whole file looks. Weights are learned here, with the base spans of a bounded
sample of documents as labels. So that the chain finds what the patterns don't,
each labelled place is learned as it stands, with the name and the signs before
the value taken out, and with values of other alphabets and lengths there. Tagging is exact Viterbi: a token whose O score leads by more than any
change of transitions can give back is O on the best path, so the best path falls
apart at such tokens, and only the stretches between them are decoded.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import _BYTE, LOWER, run_hashes, slices, text_bytes

#: The base kinds in order, their patterns, and the least length of group 2 or of the match.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Documents that are learned from: with base spans, and of all; those of least hash of the id.
SECRET_DOCS, TRAIN_DOCS = 500, 2000
#: Base spans of one document that are learned from, those of least hash of their text.
SPANS_A_DOC = 4
#: What tells that a text may hold a base span.
MAYBE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
#: Alphabets of the values that are put in place of labelled ones.
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789")
#: Tokens on either side of a training centre.
REACH = 10
WORD_BITS = 14
EPOCHS = 40
O, B, I = 0, 1, 2

# What a byte is to the tokeniser: 0 between tokens, else part of one.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-", *range(128, 256)]] = True
_CLASSES = (np.isin(np.arange(256), [*range(48, 58)]), np.isin(np.arange(256), [*range(65, 91)]), np.isin(np.arange(256), [*range(97, 123)]), np.isin(np.arange(256), list(b"+/_.-")), np.isin(np.arange(256), [*b"0123456789abcdef"]))
_GAPS = (np.isin(np.arange(256), list(b"=:")), np.isin(np.arange(256), list(b"\"'`")), np.isin(np.arange(256), list(b"\n")))
_SHAPES, _LENGTHS = 1 << 9, np.array([2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64])
_TURNS = np.array([1, 2, 3, 5, 8, 12, 20])
_FILES = 64
#: Kinds of features a token has.
KINDS_OF_FEATURES = 10


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in code points, by start and then kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


class Tokens:
    """Tokens of a slice of texts with the feature buckets of each: (tokens, features)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, look: np.ndarray | None = None) -> None:
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = _INSIDE[data]
        border = np.zeros(n + 1, bool)
        border[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
        self.first = np.searchsorted(self.starts, offsets)
        count = len(self.starts)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        begin, end = offsets[:-1][self.text], offsets[1:][self.text]

        def sums(members: np.ndarray) -> np.ndarray:
            out = np.zeros(n + 1, np.int32)
            np.cumsum(members[data], out=out[1:])
            return out

        length = self.ends - self.starts
        shape = np.searchsorted(_LENGTHS, length).astype(np.int64)
        for i, members in enumerate(_CLASSES):
            total = sums(members)
            held = total[self.ends] - total[self.starts]
            shape |= ((held == length) if i == 4 else (held > 0)).astype(np.int64) << (4 + i)
        gap = np.zeros(count, np.int64)
        before = np.where(np.arange(count) == self.first[:-1][self.text], begin, np.concatenate(([0], self.ends[:-1]))) if count else gap
        for i, members in enumerate(_GAPS):
            total = sums(members)
            gap |= (total[self.starts] - total[before] > 0).astype(np.int64) << i
        after = np.append(gap[1:], 0)
        alone_before, alone_after = before == begin, np.ones(count, bool)
        if count:
            alone_before = np.arange(count) == self.first[:-1][self.text]
            alone_after = np.arange(count) == self.first[1:][self.text] - 1
        word = (run_hashes(_BYTE[LOWER[data]], self.starts, self.ends) & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
        size = np.diff(offsets)
        digits = np.diff(sums(_CLASSES[0])[offsets]) / np.maximum(size, 1)
        if look is None:
            look = np.minimum((digits * 40).astype(np.int64), 7) * 8 + np.minimum(np.log2(size + 1).astype(np.int64) // 2, 7)
        self.look = look
        kind = _CLASSES[0][data] + 2 * _CLASSES[1][data]
        turns = np.concatenate(([0, 0], np.cumsum(kind[1:] != kind[:-1])))[: n + 1]
        turned = np.searchsorted(_TURNS, turns[self.ends] - turns[self.starts + 1], "right") if count else gap
        long = np.searchsorted(_LENGTHS, length) if count else gap
        none = (1 << WORD_BITS) - 1
        previous, following = np.concatenate(([none], word[:-1]))[:count], np.append(word[1:], none)[:count]
        shape_before, shape_after = np.concatenate(([0], shape[:-1]))[:count], np.append(shape[1:], 0)[:count]
        previous, following = np.where(alone_before, none, previous), np.where(alone_after, none, following)
        shape_before, shape_after = np.where(alone_before, 0, shape_before), np.where(alone_after, 0, shape_after)
        words = 1 << WORD_BITS
        blocks = [(word, words), (previous, words), (following, words), (shape, _SHAPES), (shape_before, _SHAPES), (shape_after, _SHAPES), (shape * 8 + gap, _SHAPES * 8), (np.where(alone_after, 0, after[:count]), 8), (turned * 16 + long, 8 * 16), (look[self.text] if count else gap, _FILES)]
        start, columns = 0, []
        for column, width in blocks:
            columns.append(column + start)
            start += width
        self.features = np.stack(columns, 1) if count else np.zeros((0, len(blocks)), np.int64)


WIDTH = 3 * (1 << WORD_BITS) + 3 * _SHAPES + 8 * _SHAPES + 8 + 8 * 16 + _FILES


@dataclass(frozen=True)
class Chain:
    """weights: of each feature bucket and tag; steps: of each pair of neighbouring tags; ends: of the first tag."""

    weights: np.ndarray
    steps: np.ndarray
    ends: np.ndarray


def train(features: np.ndarray, tags: np.ndarray, mask: np.ndarray, rate: float = 0.3, decay: float = 1e-3) -> Chain:
    """Gradient ascent on the likelihood of sequences (sequence, token, feature); mask tells real tokens, from the left."""
    w, steps, ends = np.zeros((WIDTH, 3)), np.zeros((3, 3)), np.zeros(3)
    if not len(tags):
        w[:, O] = 1.0
        return Chain(w.astype(np.float32), steps, ends)
    count, width = tags.shape
    square = [np.full(x.shape, 1e-3) for x in (w, steps, ends)]
    eye = np.eye(3)
    gold, pairs = eye[tags] * mask[..., None], (mask[:, 1:] & mask[:, :-1])[..., None, None]
    gold_steps = (gold[:, :-1, :, None] * gold[:, 1:, None, :] * pairs).sum((0, 1))
    for _ in range(EPOCHS):
        emit = w[features].sum(2)
        alpha, beta = np.zeros((count, width, 3)), np.zeros((count, width, 3))
        alpha[:, 0] = emit[:, 0] + ends
        for t in range(1, width):
            new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = np.logaddexp.reduce(steps + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)[:, None, None]
        share = np.exp(alpha + beta - total) * mask[..., None]
        both = np.exp(alpha[:, :-1, :, None] + steps + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - total[..., None]) * pairs
        slope = [np.empty_like(w), gold_steps - both.sum((0, 1)) - decay * steps, (gold[:, 0] - share[:, 0]).sum(0) - decay * ends]
        change = (gold - share).reshape(-1, 3)
        for k in range(3):
            slope[0][:, k] = np.bincount(features.reshape(-1), np.repeat(change[:, k], features.shape[2]), WIDTH)
        slope[0] -= decay * w
        for x, g, s in zip((w, steps, ends), slope, square):
            s += g * g
            x += rate * g / np.sqrt(s)
    return Chain(w.astype(np.float32), steps, ends)


def viterbi(emit: np.ndarray, chain: Chain) -> np.ndarray:
    """The best tags of one sequence."""
    score, back = emit[0] + chain.ends, np.zeros((len(emit), 3), np.int64)
    for t in range(1, len(emit)):
        ways = score[:, None] + chain.steps
        back[t] = ways.argmax(0)
        score = ways.max(0) + emit[t]
    tags = [int(score.argmax())]
    for t in range(len(emit) - 1, 0, -1):
        tags.append(int(back[t, tags[-1]]))
    return np.array(tags[::-1])


def tag(tokens: Tokens, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Index and tag of every token that is not O on its text's best path."""
    emit = np.zeros((len(tokens.starts), 3), np.float32)
    for column in range(tokens.features.shape[1]):
        emit += chain.weights[tokens.features[:, column]]
    s = chain.steps
    rows = [s, chain.ends[None, :]]  # before a token: any tag, or the text's start
    give = max(float(r[a, b] + after[b] - r[a, O] - after[O]) for r in rows for a in range(len(r)) for b in (B, I) for after in (s[:, 0], s[:, 1], s[:, 2], np.zeros(3)))
    doubtful = np.flatnonzero(emit[:, O] - emit[:, 1:].max(1) <= give + 1e-3) if len(emit) else np.zeros(0, np.int64)
    at, tags = [], []
    if len(doubtful):
        cut = np.flatnonzero((np.diff(doubtful) > 1) | (np.diff(tokens.text[doubtful]) != 0)) + 1
        for stretch in np.split(doubtful, cut):
            first, last, text = stretch[0], stretch[-1], tokens.text[stretch[0]]
            scores = emit[first : last + 1].astype(np.float64)
            scores[0] += 0.0 if first == tokens.first[text] else s[O] - chain.ends
            if last + 1 < tokens.first[text + 1]:
                scores[-1] += s[:, O]
            best = viterbi(scores, chain)
            hit = np.flatnonzero(best)
            at += (hit + first).tolist()
            tags += best[hit].tolist()
    return np.array(at, np.int64), np.array(tags, np.int64)


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters before each byte, and the first byte of each character."""
    first = (data & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(first))), np.append(np.flatnonzero(first), len(data))


def _values(text: str) -> list[tuple[int, int, int]]:
    """(start of the whole span, start and end of the secret itself) of the base spans, once each."""
    found = {(a, b): a for a, b, k in base_spans(text) if k}
    found |= {m.span(2): m.start() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST}
    return [(whole, a, b) for (a, b), whole in found.items()]


def _chosen(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those that are learned from."""
    return sorted(spans, key=lambda s: (zlib.crc32(text[s[1] : s[2]].encode()), s))[:SPANS_A_DOC]


def _gold(tokens: Tokens, lo: int, hi: int, spans: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Tags of the tokens lo to hi and the tokens where secrets begin, from spans in bytes."""
    gold, begins = np.zeros(hi - lo, np.int64), []
    for a, b in spans[np.argsort(spans[:, 0], kind="stable")]:
        inside = np.arange(np.searchsorted(tokens.ends[lo:hi], a, "right"), np.searchsorted(tokens.starts[lo:hi], b))
        gold[inside] = I
        gold[inside[:1]] = B
        begins += inside[:1].tolist()
    return gold, begins


def _variants(text: str, low: int, high: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(text, start and end of the secret) without its name and signs, and with other values, of each span within low and high."""
    for whole, a, b in spans:
        left, right = text[low:whole], text[b:high]
        if whole < a:
            yield left + text[a:b] + right, len(left), len(left) + b - a
        rng = np.random.default_rng(zlib.crc32(text[a:b].encode()))
        for letters in ALPHABETS:
            value = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(16, 49)))
            yield left + value + right, len(left), len(left) + len(value)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training sequences: around base spans and what is made of them, at a token with a digit, and at a place set by the text's length."""
    for part, data, offsets in slices(batches, "text"):
        tokens = Tokens(data, offsets)
        before, byte_of = _characters(data)
        digits = np.concatenate(([0], np.cumsum(_CLASSES[0][data])))
        numbered = digits[tokens.ends] > digits[tokens.starts]
        rows, tags, made = [], [], []
        for i, text in enumerate(part.column(0).to_pylist()):
            lo, hi = int(tokens.first[i]), int(tokens.first[i + 1])
            if lo == hi:
                continue
            spans = _values(text or "")
            in_bytes = byte_of[np.array(spans, np.int64).reshape(-1, 3) + before[offsets[i]]]
            gold, begins = _gold(tokens, lo, hi, in_bytes[:, 1:])
            chosen = _chosen(text or "", spans)
            of_chosen = {int(byte_of[x[1] + before[offsets[i]]]) for x in chosen}
            begins = [c for c in begins if any(tokens.starts[lo + c] <= x < tokens.ends[lo + c] for x in of_chosen)]
            centres = [len(text) % (hi - lo), *begins]
            centres += np.flatnonzero(numbered[lo:hi] & (gold == 0))[:1].tolist()
            for c in set(centres):
                a, b = max(0, c - REACH), min(hi - lo, c + REACH + 1)
                rows.append(tokens.features[lo + a : lo + b].astype(np.int32).reshape(-1))
                tags.append(gold[a:b].astype(np.int32))
            for whole, a, b in chosen:
                c = int(np.searchsorted(tokens.starts[lo:hi], byte_of[whole + before[offsets[i]]]))
                c = min(c, hi - lo - 1)
                low, high = (int(before[x] - before[offsets[i]]) for x in (tokens.starts[lo + max(0, c - REACH)], tokens.ends[lo + min(hi - lo - 1, c + REACH)]))
                made += [(*v, tokens.look[i]) for v in _variants(text, min(low, whole), max(high, b), [(whole, a, b)])]
        if made:
            texts, starts, ends, look = zip(*made)
            other, cuts = text_bytes(pa.array(texts, pa.string()))
            changed = Tokens(other, cuts, np.array(look))
            before, byte_of = _characters(other)
            for i, t in enumerate(texts):
                lo, hi = int(changed.first[i]), int(changed.first[i + 1])
                own = byte_of[before[cuts[i]] + np.array([[starts[i], ends[i]]])]
                spans = byte_of[before[cuts[i]] + np.array([x[1:] for x in _values(t)], np.int64).reshape(-1, 2)]
                gold, _ = _gold(changed, lo, hi, np.concatenate((spans[(spans[:, 1] <= own[0, 0]) | (spans[:, 0] >= own[0, 1])], own)))
                start = max(0, int(np.searchsorted(changed.ends[lo:hi], own[0, 0], "right")) - REACH)
                rows.append(changed.features[lo + start : min(hi, lo + start + 2 * REACH + 1)].astype(np.int32).reshape(-1))
                tags.append(gold[start : start + 2 * REACH + 1].astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int32()))], ["features", "tags"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, secret_docs: int = SECRET_DOCS, text: str = "text", key: str = "doc_id") -> Chain:
    """A chain learned from the base spans of at most `secret_docs` documents that may hold some, and from `train_docs` of all.

    Both are the documents of least hash of the id and text, so rare secrets are
    learned from as well as frequent ones. A document gives SPANS_A_DOC labelled
    places at most, so what is gathered is bounded.
    """
    hash_ = F.shiftrightunsigned(F.xxhash64(docs[key], docs[text]), 1)
    rows = docs.select(docs[text].alias("text"), hash_.alias("hash"), F.log2(hash_ + F.lit(1)).cast("int").alias("level"))
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    counts = sorted(rows.groupBy("level").agg(F.count_if(maybe), F.count("*")).collect())

    def least(column: int, wanted: int) -> DataFrame:
        """Rows of the lowest levels of the hash that hold enough: each level holds about as many as all below it."""
        total, level = 0, 64
        for at, *n in counts:
            total += n[column]
            if total >= wanted:
                level = at
                break
        return rows.where(F.col("level") <= level)

    chosen = least(0, secret_docs).where(maybe).orderBy("hash").limit(secret_docs).union(least(1, train_docs).orderBy("hash").limit(train_docs))
    found = chosen.select("text").mapInArrow(_windows, "features array<int>, tags array<int>").toArrow().combine_chunks()
    count, width = found.num_rows, 2 * REACH + 1
    features, tags, mask = np.zeros((count, width, KINDS_OF_FEATURES), np.int64), np.zeros((count, width), np.int64), np.zeros((count, width), bool)
    order = sorted((t.values.to_numpy().tobytes(), f.values.to_numpy().tobytes()) for f, t in zip(found.column(0), found.column(1)))
    for i, (t, f) in enumerate(order):
        t = np.frombuffer(t, np.int32)
        tags[i, : len(t)], mask[i, : len(t)], features[i, : len(t)] = t, True, np.frombuffer(f, np.int32).reshape(-1, KINDS_OF_FEATURES)
    return train(features, tags, mask)


def _apart(spans: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """spans and those of more that touch none of them, by start and then kind."""
    if not more:
        return spans
    starts, reach = [s[0] for s in spans], [0]
    for _, end, _ in spans:
        reach.append(max(reach[-1], end))
    return sorted(spans + [s for s in more if reach[bisect_left(starts, s[1])] <= s[0]], key=lambda s: (s[0], s[2]))


def scan(docs: DataFrame, chain: Chain, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and spans (array of start, end in code points, end exclusive, and kind) of every row.

    Base spans come as the patterns give them; a stretch B I* of the chain is a
    span of kind crf unless it touches a base span. Null counts as empty, without
    spans. Repeated rows give repeated results. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for part, data, offsets in slices(batches, "text"):
            tokens = Tokens(data, offsets)
            before, _ = _characters(data)
            at, tags = tag(tokens, learned)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (tags[1:] == B) | (np.diff(tokens.text[at]) != 0)
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(at))[: len(begin)] - 1
            which = tokens.text[at[begin]]
            starts, ends = before[tokens.starts[at[begin]]] - before[offsets[which]], before[tokens.ends[at[last]]] - before[offsets[which]]
            cuts = np.searchsorted(which, np.arange(part.num_rows + 1))
            rows = []
            for i, t in enumerate(part.column(1).to_pylist()):
                more = [(int(starts[j]), int(ends[j]), 3) for j in range(cuts[i], cuts[i + 1])]
                rows.append([{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in _apart(base_spans(t or ""), more)])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])))], ["key", "spans"])

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>").withColumnRenamed("key", key)

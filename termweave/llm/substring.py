"""Substring dedup by relative Lempel-Ziv parsing (operator 10).

The reference that a document is parsed against is the new text of all documents
of smaller id: every phrase (`phrase` consecutive words) at the place where it
first stands, by document and then by word. A factor is as long a stretch of the
document as goes on without a break in that reference; the parse takes such
factors from left to right. As each phrase has one place in the reference, the
longest factor from a word on is found by following places, across any number of
index blocks. Every phrase, those that straddle the boundary of two factors too,
is looked up, so none of the reference is missed. Factors of at least one phrase
are the duplicate spans; all words under them go.

The index is dealt in blocks by content. A phrase's anchor is the least hash among
its `anchor`-word grams, so equal phrases have equal anchors and meet in one block,
while neighbouring phrases mostly share one. A block gets, for every run of phrases
with one anchor, the anchor, the document, the place and a digest of each phrase.

An anchor that is very common, by a count over a sample of documents, is dealt
phrase by phrase: equal phrases still meet, and a task sends only the first holder
of each that it has seen. The others wait for what that holder finds, by a join
once all blocks are done. So no block grows with the occurrences of an anchor, and
a passage that a third of all documents hold reaches its block once a task. The
sample decides only how rows are dealt, never what is found.

One shuffle carries the runs (about a fifth of the words), one the texts to be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textops import Words, mix, run_hashes, signed, slices

#: Bytes of a phrase's digest beside its anchor.
DIGEST = 5
#: An anchor keeps its upper 48 bits; with a phrase's digest, 88 bits tell phrases apart.
_U16 = np.uint64(16)
#: Runs that a task gathers before it joins its own holders of common phrases.
LOCAL_RUNS = 400_000
#: An anchor of more runs than this, and than this share of all, is dealt phrase by phrase; there are at most 1 / HOT_SHARE of them.
HOT_RUNS = 20_000
HOT_SHARE = 1e-6
#: Of so many documents one is counted.
HOT_SAMPLE = 16
#: payload: the digests of a run's phrases, or of a phrase that waits its holder and the place there.
_MOVED = "block long, doc long, at long, payload binary"
_WAITS = 16
_FOUND = "doc long, at long, n long, source long, source_at long, waits boolean"


def _runs(words: Words, phrase: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of each run of phrases with one anchor: text, first word in the text, number of phrases, anchor; digests of all phrases."""
    hashes, at, text = words.grams(phrase)
    if not len(at):
        return text, at, at, hashes, np.zeros((0, DIGEST), np.uint8)
    grams = len(words.hashes) - anchor + 1
    index = np.arange(grams)
    gram = run_hashes(words.hashes, index, index + anchor)
    place, least = at.copy(), gram[at]
    for step in range(1, phrase - anchor + 1):
        other = gram[at + step]
        less = other < least
        least = np.where(less, other, least)
        place[less] = at[less] + step
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    digests = np.ascontiguousarray(hashes.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8)[:, :DIGEST]
    return text[begin], at[begin] - words.first[text[begin]], np.diff(np.append(begin, len(at))), least[begin] >> _U16, digests


def _binary(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Rows of lengths[i] bytes each."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _pick(flat: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> np.ndarray:
    return flat[np.repeat(keep, counts)]


def _send(doc: np.ndarray, at: np.ndarray, n: np.ndarray, block: np.ndarray, flat: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for the blocks: runs as they are, those of hot anchors as single phrases, of which only first holders are looked up."""
    names = ["block", "doc", "at", "payload"]
    split = np.isin(block, hot)
    plain = ~split
    if plain.any():
        yield pa.RecordBatch.from_arrays([pa.array(signed(block[plain])), pa.array(doc[plain]), pa.array(at[plain]), _binary(_pick(flat, n, plain), n[plain] * DIGEST)], names)
    if not split.any():
        return
    counts = n[split]
    row = np.repeat(np.flatnonzero(split), counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    own = _pick(flat, n, split)
    value = np.zeros((len(own), 8), np.uint8)
    value[:, :DIGEST] = own
    doc, at, block = doc[row], at[row] + step, mix(block[row] ^ mix(value.view(np.uint64).reshape(-1))) >> _U16
    order = np.lexsort((at, doc, value.view(np.uint64).reshape(-1), block))
    first = np.ones(len(order), bool)
    first[1:] = (block[order][1:] != block[order][:-1]) | (own[order][1:] != own[order][:-1]).any(1)
    holder = np.empty(len(order), np.int64)
    holder[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    waits = doc[holder] < doc
    asks = ~waits
    yield pa.RecordBatch.from_arrays([pa.array(signed(block[asks])), pa.array(doc[asks]), pa.array(at[asks]), _binary(own[asks], np.full(int(asks.sum()), DIGEST))], names)
    if waits.any():
        held = np.stack((doc[holder][waits], at[holder][waits]), 1).view(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(signed(mix(at[waits].astype(np.uint64)))), pa.array(doc[waits]), pa.array(at[waits]), _binary(held, np.full(len(held), _WAITS))], names)


def _hot_anchors(rows: DataFrame, phrase: int, anchor: int) -> np.ndarray:
    """Anchors of very many runs, counted over a sample of the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches, "text"):
            block, runs = np.unique(_runs(Words(data, offsets), phrase, anchor)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(block)), pa.array(runs.astype(np.int64))], ["block", "runs"])

    sample = rows.where(F.pmod(F.xxhash64("doc"), F.lit(HOT_SAMPLE)) == 0)
    runs = written(sample.mapInArrow(count, "block long, runs long").groupBy("block").agg(F.sum("runs").alias("runs")))
    least = max(HOT_RUNS / HOT_SAMPLE, HOT_SHARE * (runs.agg(F.sum("runs")).first()[0] or 0))
    found = runs.where(F.col("runs") > least).select("block").toArrow()
    return np.sort(found.column(0).to_numpy().astype(np.int64)).view(np.uint64)


def _factors(block: np.ndarray, doc: np.ndarray, at: np.ndarray, n: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of whole blocks that stand in an earlier document: document, place, number, and where the first first stands. Rows are ordered by block, document and place."""
    shared = np.zeros(len(block), bool)
    if len(block) > 1:
        equal = block[1:] == block[:-1]
        shared[1:] |= equal
        shared[:-1] |= equal
    flat, block, doc, at, n = _pick(flat, n, shared), block[shared], doc[shared], at[shared], n[shared]
    if not len(block):
        return (np.zeros(0, np.int64),) * 5
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    group = np.cumsum(np.concatenate(([0], (block[1:] != block[:-1]).astype(np.int64))))
    key = np.zeros((len(flat), 8), np.uint8)
    key[:, :DIGEST] = flat
    key = key.view(np.uint64).reshape(-1) | (group[row].astype(np.uint64) << np.uint64(8 * DIGEST))
    order = np.argsort(key, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = key[order][1:] != key[order][:-1]
    found = np.empty(len(order), np.int64)
    found[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    hit = np.flatnonzero(doc[row[found]] < doc[row])
    if not len(hit):
        return (np.zeros(0, np.int64),) * 5
    place, source, source_place = at[row[hit]] + step[hit], doc[row[found[hit]]], at[row[found[hit]]] + step[found[hit]]
    new = np.ones(len(hit), bool)
    new[1:] = (row[hit][1:] != row[hit][:-1]) | (step[hit][1:] != step[hit][:-1] + 1) | (source[1:] != source[:-1]) | (source_place[1:] != source_place[:-1] + 1)
    begin = np.flatnonzero(new)
    return doc[row[hit]][begin], place[begin], np.diff(np.append(begin, len(hit))), source[begin], source_place[begin]


def parse(docs: DataFrame, phrase: int = 13, anchor: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Places of all documents' phrases in the reference: doc, at (tag and first word), n (phrases in a row), source, source_at.

    `at` holds a 20-bit tag of the text above bit 40, so that rows of one id but
    different texts stay apart; see untagged().
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for part, data, offsets in slices(batches, "text"):
            words = Words(data, offsets)
            which, at, n, block, digests = _runs(words, phrase, anchor)
            ids, tags = part.column(0).to_numpy(), part.column(1).to_numpy()
            held.append((ids[which], at + (tags[which] << 40), n, block, digests))
            rows += len(n)
            if rows >= LOCAL_RUNS:
                yield from _send(*map(np.concatenate, zip(*held)), hot.value)
                held, rows = [], 0
        if rows:
            yield from _send(*map(np.concatenate, zip(*held)), hot.value)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "at", "n", "source", "source_at", "waits"]
        held: list[tuple[np.ndarray, ...]] = []

        def parsed() -> Iterator[pa.RecordBatch]:
            if held:
                out = _factors(*map(np.concatenate, zip(*held)))
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in out), pa.array(np.zeros(len(out[0]), bool))], names)

        for batch in batches:
            payload = batch.column(3)
            offsets = np.frombuffer(payload.buffers()[1], np.int32)[payload.offset : payload.offset + len(payload) + 1]
            waits = np.diff(offsets) == _WAITS
            flat = np.frombuffer(payload.buffers()[2], np.uint8)
            block, doc, at = (batch.column(i).to_numpy() for i in range(3))
            if waits.any():
                found = np.ascontiguousarray(flat[offsets[:-1][waits][:, None] + np.arange(_WAITS)]).view(np.int64)
                one = np.ones(len(found), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[waits], at[waits], one, found[:, 0], found[:, 1], one.astype(bool))], names)
            if waits.all():
                continue
            flat = flat[offsets[0] : offsets[-1]][np.repeat(~waits, np.diff(offsets))]
            digests = flat.reshape(-1, DIGEST)
            n = np.diff(offsets)[~waits].astype(np.int64) // DIGEST
            block, doc, at = block[~waits], doc[~waits], at[~waits]
            columns = (block, doc, at, n)
            cut = int(np.searchsorted(block, block[-1], "left"))  # the last block may go on in the next batch
            ends = int(n[:cut].sum())
            if cut or (held and held[-1][0][-1] != block[0]):
                if cut:
                    held.append((*(x[:cut] for x in columns), digests[:ends]))
                yield from parsed()
                held = []
            held.append((*(x[cut:].copy() for x in columns), digests[ends:].copy()))
        yield from parsed()

    rows = docs.where(docs[key].isNotNull()).select(docs[key].cast("long").alias("doc"), _tag(docs[text]).alias("tag"), docs[text].alias("text"))
    anchors = _hot_anchors(rows, phrase, anchor)
    hot = docs.sparkSession.sparkContext.broadcast(anchors)
    moved = rows.mapInArrow(send, _MOVED).repartition("block").sortWithinPartitions("block", "doc", "at")
    found = moved.mapInArrow(receive, _FOUND)
    columns = ["doc", "at", "n", "source", "source_at"]
    if not len(anchors):
        return found.select(*columns)
    # What waits takes over what its holder found, or the holder itself where that is the first of all.
    found = written(found)
    known = found.where("not waits and n = 1").select(F.col("doc").alias("h"), F.col("at").alias("h_at"), F.col("source").alias("s"), F.col("source_at").alias("s_at")).distinct()
    waiting = found.where("waits").join(known, (F.col("source") == F.col("h")) & (F.col("source_at") == F.col("h_at")), "left")
    waiting = waiting.select("doc", "at", "n", F.coalesce("s", "source").alias("source"), F.when(F.col("s").isNull(), F.col("source_at")).otherwise(F.col("s_at")).alias("source_at"))
    return found.where("not waits").select(*columns).union(waiting)


def factors(places: list[dict], phrase: int) -> list[dict]:
    """The greedy parse: places (start, n, source, source_at) of a document's phrases joined as long as the reference goes on."""
    out: list[dict] = []
    for x in sorted(places, key=lambda x: x["start"]):
        last = out[-1] if out else None
        if last and x["start"] == last["start"] + last["n"] and x["source"] == last["source"] and x["source_at"] == last["source_at"] + last["n"]:
            last["n"] += x["n"]
        else:
            out.append(dict(x))
    low = (1 << 40) - 1
    return [{"start": x["start"], "n": x["n"] + phrase - 1, "source": x["source"], "source_start": x["source_at"] & low} for x in out]


def _tag(text):
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(0xFFFFF)


def dedup(docs: DataFrame, phrase: int = 13, anchor: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_words, n_removed, kept (the words left, joined by one space) and factors of every row.

    factors: array of start (word), n (words), source (id), source_start (word), by
    start. Null text counts as empty: no words. Texts shorter than a phrase stay
    whole. A null id is no reference and loses nothing. Repeated rows of one id never
    count against each other and get the same result. Other columns are not read.
    """
    found = parse(docs, phrase, anchor, text, key)
    place = F.struct(F.col("at").bitwiseAND((1 << 40) - 1).alias("start"), "n", "source", "source_at")
    spans = found.groupBy(F.col("doc").alias("_doc"), F.shiftright("at", 40).alias("_tag")).agg(F.collect_set(place).alias("places"))
    rows = docs.select(docs[key].cast("long").alias("doc"), _tag(docs[text]).alias("tag"), docs[text].alias("text"))
    joined = rows.join(spans, (rows.doc == spans._doc) & (rows.tag == spans._tag), "left").select("doc", "text", "places")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "n", "source", "source_start")]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                total, gone, kept, parsed = [], [], [], []
                for t, places in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = (t or "").encode().split()
                    total.append(len(words))
                    spans = factors(places, phrase) if places else []
                    parsed.append(spans)
                    left, end = [], 0
                    for x in spans:
                        left += words[end : max(end, x["start"])]
                        end = max(end, x["start"] + x["n"])
                    words = left + words[end:]
                    gone.append(total[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(parsed, kind)], ["doc", "n_words", "n_removed", "kept", "factors"])

    schema = "doc long, n_words long, n_removed long, kept string, factors array<struct<start:bigint,n:bigint,source:bigint,source_start:bigint>>"
    return joined.mapInArrow(cut, schema).withColumnRenamed("doc", key)

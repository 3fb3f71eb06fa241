"""Quality classifier by supervised subword embeddings (operator 9).

A document is the average of learned vectors of its words, plus that of pairs of
neighbouring words, plus that of byte n-grams of each size, inside a word or across
the border of two, each hashed to a bucket of its own kind. Pairs are hashed in
order. A word or pair counts once in each window of a text's words, though the
average is over all of them, so a text that repeats itself has less to add up and
is judged more by the constant. A softmax of two
outputs scores it. Vectors and outputs are learned on the driver by numpy
stochastic gradient descent from a bounded sample of labelled rows. As output and
average are both linear, scoring needs one number a bucket, summed over a text, so
whole texts are scored at the speed of a table lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .textops import SEPARATOR, SLICE_BYTES, Words, mix, slices

#: Labelled rows that a model is fitted on, half of each label: those of least hash of the id.
TRAIN_ROWS = 4000
#: log2 of the buckets of words and of n-grams of each size, and of pairs.
BUCKET_BITS, PAIR_BITS = 17, 12
#: A word or pair counts once in this many words.
WINDOW = 32
DIMENSIONS = 8
#: Steps of descent, and rows of each label in one.
STEPS, BATCH = 1500, 8
RATE = 0.2
NGRAMS = (3, 4)
#: Bytes of text whose features are made at once: a byte takes about a hundred on the way.
SLICE = SLICE_BYTES // 4


@dataclass(frozen=True)
class Model:
    """bucket_score: difference of the two outputs for each bucket; bias: its constant."""

    bucket_score: np.ndarray
    bias: float


def _fresh(window: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """True where a bucket comes up for the first time in its window."""
    fresh = np.zeros(len(bucket), bool)
    fresh[np.unique((window << BUCKET_BITS) + bucket, return_index=True)[1]] = True
    return fresh


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket of each feature, byte position of each feature, whether it counts), kind by kind."""
    words = Words(data, offsets)
    mask = np.uint64((1 << BUCKET_BITS) - 1)
    counts = words.counts()
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
    windows = -(-counts // WINDOW)
    window = place // WINDOW + np.repeat(np.cumsum(windows) - windows, counts)
    bucket = (words.hashes & mask).astype(np.int64)
    yield bucket, words.starts, _fresh(window, bucket)
    at = np.flatnonzero(place > 0)
    bucket = (mix(words.hashes[at - 1] + mix(words.hashes[at])) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
    yield bucket + ((1 + len(NGRAMS)) << BUCKET_BITS), words.starts[at], _fresh(window[at], bucket)
    values = data.astype(np.uint64)
    values[SEPARATOR[data]] = 32
    gap = np.concatenate(([0], np.cumsum(SEPARATOR[data])))
    border = np.zeros(len(data) + 1, np.int64)
    border[offsets[1:-1]] = 1
    border = np.cumsum(border)
    for kind, n in enumerate(NGRAMS, 1):
        at = np.arange(max(0, len(data) - n + 1))
        # inside one text, and one separator at most between the ends
        at = at[(border[at] == border[at + n - 1]) & (gap[at + n - 1] - gap[at + 1] <= 1)]
        code = values[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        for i in range(1, n):
            code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + values[at + i]
        code = (code ^ (code >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        yield ((code >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + kind * (1 << BUCKET_BITS)), at, np.ones(len(at), bool)


#: Buckets of words, of each n-gram size, and of pairs.
BUCKETS = ((1 + len(NGRAMS)) << BUCKET_BITS) + (1 << PAIR_BITS)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, and each text's buckets with their share of its features."""
    for part, data, offsets in slices(batches, "text", SLICE):
        kinds = list(_features(data, offsets))
        text = [np.searchsorted(offsets, at, "right") - 1 for _, at, _ in kinds]
        ids, share = [], []
        for i in range(part.num_rows):
            mine = [of == i for of in text]
            found = [np.unique(bucket[m & fresh], return_counts=True) for m, (bucket, _, fresh) in zip(mine, kinds)]
            ids.append(np.concatenate([b for b, _ in found]).astype(np.int32))
            share.append(np.concatenate([c / max(1, m.sum()) for m, (_, c) in zip(mine, found)]).astype(np.float32))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], ["label", "buckets", "shares"])


def train(buckets: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent on the softmax loss of averaged vectors; each step takes rows of both labels alike."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIMENSIONS), dtype=np.float32) - 0.5) * np.float32(0.02)
    out, bias = (rng.random((DIMENSIONS, 2), dtype=np.float32) - 0.5), np.zeros(2, np.float32)
    rows = [i for i in range(len(labels)) if len(buckets[i])]
    of_label = [x for x in ([i for i in rows if labels[i] == k] for k in (0, 1)) if x]
    turns = [np.concatenate([rng.permutation(x) for _ in range(-(-STEPS * BATCH // len(x)))]) for x in of_label]
    squares, out_squares = np.full(BUCKETS, 1e-8, np.float32), np.full((DIMENSIONS, 2), 1e-8, np.float32)
    for step in range(STEPS if rows else 0):
        rate = RATE * (1 - step / STEPS)
        batch = np.concatenate([x[step * BATCH : (step + 1) * BATCH] for x in turns])
        sizes = [len(buckets[i]) for i in batch]
        flat, part = np.concatenate([buckets[i] for i in batch]), np.concatenate([shares[i] for i in batch])[:, None]
        mean = np.add.reduceat(vectors[flat] * part, np.cumsum([0, *sizes[:-1]]))
        logits = mean @ out + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(batch)), labels[batch]] -= 1
        p /= len(batch)
        back = np.repeat(p @ out.T, sizes, axis=0) * part
        grad = mean.T @ p
        out_squares += grad * grad
        out -= rate * grad / np.sqrt(out_squares)
        bias -= rate * 0.1 * p.sum(0)
        touched, place = np.unique(flat, return_inverse=True)
        squares[touched] += np.bincount(place, (back * back).mean(1)).astype(np.float32)
        back *= rate / np.sqrt(squares[flat])[:, None]
        vectors[touched] -= np.stack([np.bincount(place, back[:, k]) for k in range(DIMENSIONS)], 1).astype(np.float32)
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def held_out(key: str):
    """The rows that are never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", train_rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> Model:
    """A model of labels(key, target) on docs(key, text), from at most `train_rows` rows that are not held out.

    Of each label the half of train_rows with the least hash of the id is learned
    from, and of rows that repeat an id the least text. Null ids, labels other than 0 and 1, and ids without a document are left
    out. Without labelled rows every score is one half.
    """
    usable = labels.where(labels[key].isNotNull() & ~held_out(key)).select(labels[key].alias("id"), labels[target].alias("label"))
    least = lambda label: usable.where(F.col("label") == label).distinct().orderBy(F.xxhash64("id"), "id").limit(train_rows // 2)
    sample = least(0).union(least(1))
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text")).join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).orderBy(F.xxhash64("id"), "id", "label")
    bags = rows.select("label", "text").mapInArrow(_bags, "label int, buckets array<int>, shares array<float>").toArrow().combine_chunks()
    lists = [[x.values.to_numpy() for x in bags.column(c)] for c in (1, 2)]
    return train(lists[0], lists[1], bags.column(0).to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= 0.5).

    Null and empty texts get the score of the constant alone. Columns of these
    two names are replaced; all others, whatever their names, pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            renamed = pa.RecordBatch.from_arrays(batch.columns, [str(i) for i in range(batch.num_columns)])
            for part, data, offsets in slices(iter([renamed]), str(at), SLICE):
                total = np.zeros(part.num_rows)
                for bucket, place, fresh in _features(data, offsets):
                    summed = np.concatenate(([0.0], np.cumsum(m.bucket_score[bucket] * fresh, dtype=np.float64)))
                    ends = np.searchsorted(place, offsets)
                    total += np.diff(summed[ends]) / np.maximum(np.diff(ends), 1)
                p = 1 / (1 + np.exp(-np.clip(total + m.bias, -500, 500)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*kept, "score", "predicted"])

    schema = StructType([*(docs.schema[c] for c in kept), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.select(*kept).mapInArrow(run, schema)

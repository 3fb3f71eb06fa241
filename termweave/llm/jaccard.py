"""N-gram Jaccard join by size-banded tiles with bitmap signatures (operator 1).

A document is the set of its distinct n-word shingles, as 64-bit hashes. Equal
sets are one node. Two sets of similarity s or more share one of the first
`n - ceil(s n) + 1` members under any one order, so each set is posted under that
prefix, shingles that many documents hold coming last. A tile is one posted
shingle and one size band: the sets of the band, and those of the band below,
as only these can be similar enough.

Each set has a bitmap of its members' hashes. Bits that differ between two
bitmaps bound the overlap from above, so pairs of a tile that fail the bound are
done with. Those that pass only matter for what they connect: a tile gives a
spanning forest of them, never all pairs, and the forests of all tiles part the
sets into clusters that no link can leave. Each set then goes once to its cluster,
where pairs not yet connected are intersected exactly as sorted arrays, behind a
finer bitmap. Clusters beyond a bounded size are dealt in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import written
from .textops import Words, mix, run_hashes, signed, slices

#: A shingle held by this share of all documents is common; there are at most (mean set size / share) of them.
COMMON_SHARE = 0.005
#: Rows of a tile that are compared at once; larger tiles are dealt in pairs of blocks.
TILE_ROWS = 2000
#: Shingles of a cluster that are compared in one task; larger clusters are dealt in pairs of blocks.
CLUSTER_SHINGLES = 2_000_000
#: Ids that may be broadcast to find their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _sets(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(data, offsets, lower=True)
    hashes, _, text = words.grams(shingle)
    counts = words.counts()
    ends = np.searchsorted(text, np.arange(len(counts)), "right")
    begins = np.searchsorted(text, np.arange(len(counts)), "left")
    short = run_hashes(words.hashes, words.first[:-1], words.first[1:]) if len(counts) else hashes
    out = []
    for i, c in enumerate(counts):
        if c >= shingle:
            s = np.sort(hashes[begins[i] : ends[i]])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            out.append(short[i : i + 1] if c else short[:0])
    return out


def _bitmap(members: np.ndarray, times: int = 1) -> bytes:
    """A power of two of bits, at least `times` the members; member h sets bit h mod size."""
    size = max(64, 1 << (times * len(members)).bit_length())
    bits = np.zeros(size, bool)
    bits[(members & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _differ(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Differing bits of two bitmaps (size, bits), the larger folded to the smaller: never more than the members that differ."""
    (m, x), (k, y) = (a, b) if a[0] <= b[0] else (b, a)
    while k > m:
        k >>= 1
        y = (y >> k) | (y & ((1 << k) - 1))
    return (x ^ y).bit_count()


def _bound_passes(n: int, bits_n: tuple[int, int], m: int, bits_m: tuple[int, int], percent: int) -> float:
    """The upper bound of the similarity if it reaches the threshold, else 0."""
    inter = (n + m - _differ(bits_n, bits_m)) // 2
    inter = min(inter, n, m)
    return inter / (n + m - inter) if 100 * inter >= percent * (n + m - inter) else 0.0


def _unpack(bits: bytes) -> tuple[int, int]:
    return len(bits) * 8, int.from_bytes(bits, "little")


def _common(docs: DataFrame, shingle: int) -> np.ndarray:
    """Shingles that about COMMON_SHARE of all documents hold; only the order of prefixes hangs on them, never the links."""
    total = docs.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [s for part, data, offsets in slices(iter([batch]), "text") for s in _sets(part, data, offsets, shingle)]
            if held:
                value, times = np.unique(np.concatenate(held), return_counts=True)
                often = times >= max(3, COMMON_SHARE / 2 * batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(signed(value[often])), pa.array(times[often].astype(np.int64))], ["shingle", "times"])

    often = docs.select("text").mapInArrow(count, "shingle long, times long").groupBy("shingle").agg(F.sum("times").alias("times"))
    rows = often.where(F.col("times") >= max(3, COMMON_SHARE * total)).select("shingle").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _signatures(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n, k1 and k2 (the set's identity), bits, prefix of every row."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, shingle))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = common.value
        for part, data, offsets in slices(batches, "text"):
            sets = _sets(part, data, offsets, shingle)
            prefixes, bits, keys = [], [], []
            for s in sets:
                if len(often) and len(s):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    late = often[at] == s
                    ordered = np.concatenate((s[~late], s[late]))
                else:
                    ordered = s
                least = (percent * len(s) + 99) // 100
                prefixes.append(ordered[: len(s) - least + 1].view(np.int64) if len(s) else ordered.view(np.int64))
                bits.append(_bitmap(s))
                keys.append((mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
            key = np.array(keys, np.uint64).reshape(-1, 2)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(signed(key[:, 0].copy())), pa.array(signed(key[:, 1].copy())), pa.array(bits, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))],
                ["doc_id", "n", "k1", "k2", "bits", "prefix"],
            )

    return docs.mapInArrow(sign, "doc_id long, n long, k1 long, k2 long, bits binary, prefix array<long>")


def _linked(clusters: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Exact links (a, b) that join each cluster(rep, cluster, n) as far as all its links do."""
    few = clusters.count() <= BROADCAST_IDS
    whole = clusters.groupBy("cluster").agg(F.ceil(F.sum("n") / CLUSTER_SHINGLES).alias("blocks"))
    dealt = clusters.join(whole, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    members = dealt.select(F.col("rep").alias("doc_id"), "cluster", "blocks", "block")
    texts = docs.join(F.broadcast(members) if few else members, "doc_id").select("doc_id", "cluster", "blocks", "block", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array([s.tobytes() for s in _sets(part, data, offsets, shingle)], pa.binary())], ["rep", "cluster", "blocks", "block", "members"])

    sets = texts.mapInArrow(gather, "rep long, cluster long, blocks long, block long, members binary")
    spread = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "block", "members")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                own = tuple(batch.column(c)[row].as_py() for c in range(3))
                if own != key:
                    out += _cluster_links(held, percent, bool(key) and key[1] != key[2])
                    key, held = own, []
                held.append((batch.column(3)[row].as_py(), batch.column(4)[row].as_py(), np.frombuffer(batch.column(5)[row].as_py(), np.uint64)))
            yield _pairs_out(out)
        yield _pairs_out(_cluster_links(held, percent, bool(key) and key[1] != key[2]))

    return spread.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(link, "a long, b long").where("a <> b")


def _pairs_out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


class _Union:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.top = list(range(n))

    def root(self, x: int) -> int:
        top = self.top
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x


def _cluster_links(rows: list[tuple[int, int, np.ndarray]], percent: int, cross: bool) -> list[tuple[int, int]]:
    """Exact links between rows (rep, block, set) of a cluster, leaving out pairs that earlier links connect."""
    rows = sorted(rows, key=lambda r: (len(r[2]), r[0]))
    bits = [_unpack(_bitmap(s, 8)) for _, _, s in rows]
    union, out, first = _Union(len(rows)), [], 0
    for j, (rep, block, s) in enumerate(rows):
        while 100 * len(rows[first][2]) < percent * len(s):
            first += 1
        own = union.root(j)
        for i in range(first, j):
            if (at := union.root(i)) == own or cross and rows[i][1] == block:
                continue
            t = rows[i][2]
            if not _bound_passes(len(t), bits[i], len(s), bits[j], percent):
                continue
            place = np.minimum(np.searchsorted(s, t), len(s) - 1)
            inter = int((s[place] == t).sum())
            if 100 * inter >= percent * (len(s) + len(t) - inter):
                out.append((rows[i][0], rep))
                union.top[own] = at
                own = at
    return out


def _bounded(pairs: DataFrame, signed_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps allow the similarity."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            keep = [_bound_passes(i, _unpack(x), j, _unpack(y), percent) > 0 for i, x, j, y in zip(n, batch.column(3).to_pylist(), m, batch.column(5).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    side = lambda end, n, bits: signed_sets.select(F.col("rep").alias(end), F.col("n").alias(n), F.col("bits").alias(bits))
    both = pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b").select("a", "b", "n", "x", "m", "y")
    return both.mapInArrow(test, "a long, b long")


def _tile_pairs(rows: list[tuple], percent: int, cross: bool) -> Iterator[tuple[int, int]]:
    """A spanning forest of the tile's pairs of different classes whose bitmaps allow the similarity.

    rows: (rep, n, home, label, bits, block), in order of n.
    """
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    bits = [_unpack(r[4]) for r in rows]
    union, by_label, first = _Union(len(rows)), {}, 0
    for j, row in enumerate(rows):
        by_label.setdefault(row[3], j)
        union.top[j] = union.root(by_label[row[3]])
    for j, (rep, n, home, _, _, block) in enumerate(rows):
        while 100 * rows[first][1] < percent * n:
            first += 1
        own = union.root(j)
        for i in range(first, j):
            if (at := union.root(i)) == own or not (home or rows[i][2]) or cross and rows[i][5] == block:
                continue
            if _bound_passes(rows[i][1], bits[i], n, bits[j], percent):
                yield min(rep, rows[i][0]), max(rep, rows[i][0])
                union.top[own] = at
                own = at


def _open_posts(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts of shingles that more than one class holds, with their classes."""
    rows = posts.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("token", "rep", "n", "own", F.coalesce("label", "rep").alias("label"))
    several = written(rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token"))
    return rows.join(several, "token", "left_semi")


def _tile_candidates(rows: DataFrame, signed_sets: DataFrame, percent: int) -> DataFrame:
    """Forests of all tiles that hold more than one class."""
    rows = rows.withColumn("band", F.explode(F.array("own", F.col("own") + 1))).withColumn("home", F.col("band") == F.col("own"))
    tiles = rows.groupBy("token", "band").agg(F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("home").alias("some")).where("low < high and some")
    open_rows = rows.join(tiles.select("token", "band", "held"), ["token", "band"]).join(signed_sets.select("rep", "bits"), "rep")
    blocks = F.ceil(F.col("held") / TILE_ROWS)
    own = F.pmod(F.xxhash64("rep"), blocks)
    dealt = open_rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.select("token", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "n", "home", "label", "bits", "block")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], set()

        def flush() -> None:
            if len(held) > 1:
                out.update(_tile_pairs(held, percent, key[2] != key[3]))

        def batch_out() -> pa.RecordBatch:
            a, b = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != key:
                    flush()
                    key, held = row[:4], []
                held.append(row[4:])
            if len(out) > 50_000:
                yield batch_out()
                out.clear()
        flush()
        if out:
            yield batch_out()

    ordered = dealt.repartition("token", "band", "i", "j").sortWithinPartitions("token", "band", "i", "j")
    return ordered.mapInArrow(pairs, "a long, b long").distinct()


def similar_components(docs: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles and component_id (least id that links reach) of every row.

    Null and empty texts, and texts without words, have no shingles and no links:
    their component is their own id. Fewer words than a shingle make one shingle.
    Copies share a set and its component. A null id takes part in nothing and its
    component is null. Rows that repeat an id count as linked with one another.
    Other columns are not read; an empty table gives an empty result.
    """
    source = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    usable = source.where("doc_id is not null")
    signs = written(_signatures(source, shingle, percent))
    sets = signs.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"))
    node = written(sets)
    reps = signs.join(node.select(F.col("rep").alias("doc_id"), "k1", "k2", "n"), ["doc_id", "k1", "k2", "n"], "left_semi").dropDuplicates(["doc_id", "k1", "k2", "n"]).select(F.col("doc_id").alias("rep"), "n", "bits", "prefix")
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    posted = reps.select(F.explode("prefix").alias("token"), "rep", "n", band.alias("own"))
    # Counted with map-side sums and joined back, so that a shingle of very many sets is dealt to several tasks.
    hub = F.min(F.struct("rep", "n"))
    shared = posted.groupBy("token").agg(F.count("*").alias("held"), F.min("n").alias("least"), F.max("n").alias("most"), hub.alias("hub")).where(f"held > 2 or held = 2 and 100 * least >= {percent} * most")
    shared = written(shared.select("token", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")))
    posts = written(posted.join(shared, "token"))
    small = written(reps.select("rep", "n", "bits"))
    alike = f"rep <> hub and 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    first = posts.where(alike).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    near = written(_bounded(first, small, percent))
    rows = written(_open_posts(posts.select("token", "rep", "n", "own"), components(near)))
    near = near.union(_tile_candidates(rows, small, percent))
    clusters = written(components(near).join(small, F.col("node") == F.col("rep")).select("rep", F.col("label").alias("cluster"), "n"))
    labels = components(_linked(clusters, usable, shingle, percent))
    classes = node.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", "n", F.coalesce("label", "rep").alias("label"))
    out = signs.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2", "n"], "left")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"))

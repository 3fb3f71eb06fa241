"""Line dedup by pairwise alignment (operator 8).

A line is known by a hash of its text, stripped of white space (U+0009 to U+000D and
U+0020), so line ends and indents don't tell copies apart. A run is as few lines as hold
BLOCK_CHARS characters, counted from each line on and back, so every line of a
block that is long enough to go lies in a run inside that block, and documents
overlap only if they share a run. Lines in no run of another document can't go;
they are only marks of a gap when documents are aligned.

A run is rare if at most RARE_ROWS rows hold it. Rare runs pair all their
holders. Common runs may have any number of holders, so they pair none: what a
document has of common runs is its frame, documents of one frame are alike there,
and only the earliest of each frame is aligned, with the earliest holder of each
of its runs, then, for lines that are still there, with every earlier frame that
holds their run. So a line that a third of all documents hold makes a pair a frame
and not a pair a document, and no link is lost.

A pair of line lists is aligned by patience diff: lines that occur once on both
sides anchor it, in the longest order common to both, and the gaps between are
aligned alike. The aligned blocks go from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .tables import written
from .textops import _BYTE, SEPARATOR, run_hashes, signed, slices

#: Stripped from a line.
WHITE = " \t\n\x0b\x0c\r"
#: A block of fewer characters stays: such lines repeat by chance.
BLOCK_CHARS = 20
#: A run that more rows hold is common.
RARE_ROWS = 8
#: What stands for a gap in a list of lines, of the later document and of the earlier one, so that gaps are never alike.
GAP, OTHER_GAP = -1, -2

_ROW = "doc long, tag long, lines array<bigint>, places array<int>, sizes array<int>"


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two line lists, in order; 0 stands for a blank line and never anchors."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        place = {h: x for x, h in enumerate(b[k:m], k) if once_b[h] == 1}
        common = [(x, place[h]) for x, h in enumerate(a[i:j], i) if h and once_a[h] == 1 and h in place]
        if not common:
            continue
        tails: list[int] = []
        at: list[int] = []
        before = [-1] * len(common)
        for n, (_, y) in enumerate(common):
            pile = bisect_left(tails, y)
            before[n] = at[pile - 1] if pile else -1
            if pile == len(tails):
                tails.append(y)
                at.append(n)
            else:
                tails[pile], at[pile] = y, n
        chain, n = [], at[-1]
        while n >= 0:
            chain.append(common[n])
            n = before[n]
        chain.reverse()
        out += chain
        ends = [(i - 1, k - 1), *chain, (j, m)]
        todo += [(x + 1, p, y + 1, q) for (x, y), (p, q) in zip(ends, ends[1:]) if x + 1 < p and y + 1 < q]
    return sorted(out)


def common_lines(later: list[int], earlier: list[int], sizes: list[int]) -> list[int]:
    """Positions in the later list of the aligned blocks that are long enough, blank lines left out."""
    gone: list[int] = []
    block: list[tuple[int, int]] = []

    def close() -> None:
        if sum(sizes[x] for x, _ in block) >= BLOCK_CHARS:
            gone.extend(x for x, _ in block if sizes[x])

    for pair in patience(later, earlier):
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            close()
            block = []
        block.append(pair)
    close()
    return gone


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of each text's first line (one more than texts); hash (0 for a blank one) and characters of each stripped line."""
    breaks = np.flatnonzero(data == 10)
    per_text = np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(offsets) - 1) + 1
    first = np.concatenate(([0], np.cumsum(per_text)))
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    opens, closes = np.zeros(first[-1], bool), np.zeros(first[-1], bool)
    opens[first[:-1]], closes[first[1:] - 1] = True, True
    starts[opens], starts[~opens] = offsets[:-1], breaks + 1
    ends[closes], ends[~closes] = offsets[1:], breaks
    solid = np.flatnonzero(~SEPARATOR[data])
    if len(solid):
        starts = np.minimum(np.append(solid, len(data))[np.searchsorted(solid, starts)], ends)
        last = np.searchsorted(solid, ends) - 1
        ends = np.maximum(np.where(last >= 0, solid[last] + 1, 0), starts)
    else:
        ends = starts
    letters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    sizes = letters[ends] - letters[starts]
    hashes = run_hashes(_BYTE[data], starts, ends)
    hashes[sizes == 0] = 0
    return first, signed(hashes), sizes


def runs(first: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first line, end line and hash of every run; lines are counted over all texts."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    filled = np.flatnonzero(sizes > 0)
    forth = np.searchsorted(total, total[filled] + BLOCK_CHARS)
    back = np.searchsorted(total, total[filled + 1] - BLOCK_CHARS, "right") - 1
    fits = forth <= first[text[filled] + 1]
    a, b = filled[fits], forth[fits]
    reach = np.zeros(len(sizes) + 1, np.int64)
    reach[a] = b
    fits = (back >= first[text[filled]]) & (reach[np.maximum(back, 0)] != filled + 1)
    a, b = np.concatenate((a, back[fits])), np.concatenate((b, filled[fits] + 1))
    return text[a], a, b, signed(run_hashes(hashes.view(np.uint64), a, b))


def _lined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, tag, and the hashes and sizes of a text's lines."""
    for part, data, offsets in slices(batches, "text"):
        first, hashes, sizes = split_lines(data, offsets)
        cuts = pa.array(first, pa.int32())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(cuts, pa.array(hashes)), pa.ListArray.from_arrays(cuts, pa.array(sizes.astype(np.int32)))], ["doc", "tag", "hashes", "sizes"])


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lists and their values."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate(([0], np.cumsum(sizes))), column.flatten().to_numpy(zero_copy_only=False)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """run, doc and tag, once a row and run."""
    for batch in batches:
        first, hashes = _flat(batch.column(2))
        text, _, _, run = runs(first, hashes, _flat(batch.column(3))[1].astype(np.int64))
        order = np.lexsort((run, text))
        text, run = text[order], run[order]
        new = np.ones(len(run), bool)
        new[1:] = (text[1:] != text[:-1]) | (run[1:] != run[:-1])
        where = pa.array(text[new])
        yield pa.RecordBatch.from_arrays([pa.array(run[new]), batch.column(0).take(where), batch.column(1).take(where)], ["run", "doc", "tag"])


def _frame(hashes: np.ndarray, sizes: np.ndarray, spans: list[tuple[int, int]]) -> tuple[list[int], list[int], list[int]]:
    """Lines, their places and sizes: those under the spans, with one gap where others stand between."""
    cover = np.zeros(len(hashes) + 1, np.int64)
    for a, b in spans:
        cover[a] += 1
        cover[b] -= 1
    kept = np.flatnonzero(np.cumsum(cover[:-1]))
    lines, places, widths, before = [], [], [], -1
    for x in kept.tolist():
        if x != before + 1:
            lines.append(GAP)
            places.append(-1)
            widths.append(0)
        lines.append(int(hashes[x]))
        places.append(x)
        widths.append(int(sizes[x]))
        before = x
    if before + 1 < len(hashes):
        lines.append(GAP)
        places.append(-1)
        widths.append(0)
    return lines, places, widths


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of each row: of all its shared runs, and of the common ones, with the places of these in it."""
    for batch in batches:
        out: list[list] = [[] for _ in range(9)]
        first, hashes = _flat(batch.column(2))
        sizes = _flat(batch.column(3))[1].astype(np.int64)
        text, a, b, run = runs(first, hashes, sizes)
        order = np.argsort(text, kind="stable")
        text, a, b, run = text[order], a[order], b[order], run[order]
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
        for i, shared in enumerate(batch.column(4).to_pylist()):
            known = {x["run"]: x for x in shared}
            at = slice(ends[i], ends[i + 1])
            spans = [(r, int(p - first[i]), int(q - first[i])) for r, p, q in zip(run[at].tolist(), a[at], b[at]) if r in known]
            h, s = hashes[first[i] : first[i + 1]], sizes[first[i] : first[i + 1]]
            whole = _frame(h, s, [x[1:] for x in spans])
            common = [x for x in spans if known[x[0]]["common"]]
            frame = _frame(h, s, [x[1:] for x in common]) if common else ([], [], [])
            at_place = {p: n for n, p in enumerate(frame[1])}
            held = [{"run": r, "leader": known[r]["leader"], "start": at_place[p], "end": at_place[q - 1] + 1} for r, p, q in common]
            name = int(run_hashes(np.array(frame[0], np.int64).view(np.uint64), np.array([0]), np.array([len(frame[0])]))[0].astype(np.int64)) if common else None
            for column, value in zip(out, (*whole, *frame, held, name)):
                column.append(value)
        numbers = lambda i, kind: pa.array(out[i], pa.list_(kind))
        held = pa.array(out[6], pa.list_(pa.struct([("run", pa.int64()), ("leader", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(numbers(i, pa.int64() if i % 3 == 0 else pa.int32()) for i in range(6)), held, pa.array(out[7], pa.int64())],
            ["doc", "tag", "lines", "places", "sizes", "common", "common_places", "common_sizes", "held", "frame"],
        )


_FRAMES = f"{_ROW}, common array<bigint>, common_places array<int>, common_sizes array<int>, held array<struct<run:bigint,leader:bigint,start:int,end:int>>, frame long"


def _align(pairs: DataFrame) -> DataFrame:
    """doc, tag and the places that go, of pairs(doc, tag, lines, places, sizes, others)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for lines, places, sizes, others in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                gone.append([places[x] for x in common_lines(lines, [OTHER_GAP if x == GAP else x for x in others], sizes)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], ["doc", "tag", "gone"])

    return pairs.select("doc", "tag", "lines", "places", "sizes", "others").mapInArrow(align, "doc long, tag long, gone array<int>").where(F.size("gone") > 0)


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, tag and run of the common runs, led by an earlier document, of which a line is still there."""
    for batch in batches:
        docs, tags, runs_ = [], [], []
        for doc, tag, places, sizes, held, gone in zip(*(c.to_pylist() for c in batch.columns)):
            without = set(gone or ())
            open_runs = {h["run"] for h in held if h["leader"] < doc and any(sizes[n] and places[n] not in without for n in range(h["start"], h["end"]))}
            docs += [doc] * len(open_runs)
            tags += [tag] * len(open_runs)
            runs_ += open_runs
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(tags, pa.int64()), pa.array(runs_, pa.int64())], ["doc", "tag", "run"])


def _removed(rows: DataFrame) -> DataFrame:
    """doc, tag and places that go of rows(doc, tag, text)."""
    lined = written(rows.where("doc is not null").select("doc", "tag", "text").mapInArrow(_lined, "doc long, tag long, hashes array<bigint>, sizes array<int>"))
    held = lined.select("doc", "tag", "hashes", "sizes").mapInArrow(_run_rows, "run long, doc long, tag long")
    counted = held.groupBy("run").agg(F.min("doc").alias("leader"), F.max("doc").alias("last"), F.count("*").alias("n")).where("leader < last").select("run", "leader", (F.col("n") > RARE_ROWS).alias("common"))
    # Both sides of the join are dealt anew, so that a very common run can be split.
    shared = written(held.join(written(counted), "run"))
    of_row = shared.groupBy("doc", "tag").agg(F.collect_set(F.struct("run", "common", "leader")).alias("shared"))
    frames = written(lined.join(of_row, ["doc", "tag"]).dropDuplicates(["doc", "tag"]).select("doc", "tag", "hashes", "sizes", "shared").mapInArrow(_frames, _FRAMES))

    # Rare runs: all pairs of their few holders, whole frames.
    few = shared.where("not common").groupBy("run").agg(F.array_sort(F.collect_set(F.struct("doc", "tag"))).alias("x"))
    pair = few.select(F.explode("x").alias("later"), "x").select("later", F.explode("x").alias("earlier")).where("earlier.doc < later.doc")
    rare = pair.select("later.*", F.col("earlier.doc").alias("partner"), F.col("earlier.tag").alias("partner_tag")).distinct()
    others = frames.select(F.col("doc").alias("partner"), F.col("tag").alias("partner_tag"), F.col("lines").alias("others"))
    whole = frames.select("doc", "tag", "lines", "places", "sizes")
    found = [_align(rare.join(whole, ["doc", "tag"]).join(others, ["partner", "partner_tag"]))]

    # Common runs: the earliest of each frame for all of its frame.
    framed = frames.where("frame is not null").select("doc", "tag", F.col("common").alias("lines"), F.col("common_places").alias("places"), F.col("common_sizes").alias("sizes"), "held", "frame")
    heads = written(framed.groupBy("frame").agg(F.min("doc").alias("head")))
    headed = framed.join(heads, "frame")
    filled = F.filter(F.arrays_zip("places", "sizes"), lambda x: x["sizes"] > 0)
    found.append(headed.where("doc > head").select("doc", "tag", F.transform(filled, lambda x: x["places"]).alias("gone")))
    first = written(headed.where("doc = head").drop("head", "frame"))
    partners = first.select(F.col("doc").alias("partner"), F.col("tag").alias("partner_tag"), F.col("lines").alias("others"))
    led = first.select("doc", "tag", "lines", "places", "sizes", F.explode(F.array_distinct("held.leader")).alias("partner")).where("partner < doc")
    led = written(_align(led.join(partners, "partner")))
    found.append(led)
    settled = led.groupBy("doc", "tag").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    open_runs = written(first.join(settled, ["doc", "tag"], "left").select("doc", "tag", "places", "sizes", "held", "gone").mapInArrow(_left_over, "doc long, tag long, run long"))
    if not open_runs.isEmpty():
        holders = first.select(F.col("doc").alias("partner"), F.col("tag").alias("partner_tag"), F.explode(F.array_distinct("held.run")).alias("run"))
        again = open_runs.join(holders, "run").where("partner < doc").select("doc", "tag", "partner", "partner_tag").distinct()
        found.append(_align(again.join(first, ["doc", "tag"]).join(partners, ["partner", "partner_tag"])))
    return reduce(DataFrame.union, found).groupBy("doc", "tag").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def without_lines(lines: list[str], gone: set[int]) -> set[int]:
    """gone, and the blank lines whose nearest other lines, on each side that has one, all go."""
    if not gone:
        return gone
    out, blank, before = set(gone), [], True
    for i, line in enumerate(lines):
        if not line.strip(WHITE):
            blank.append(i)
            continue
        if blank and before and i in gone:
            out.update(blank)
        blank, before = [], i in gone
    if before:
        out.update(blank)
    return out


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """key, n_lines, n_removed and kept (the text without removed lines) of every row, and the columns named in carry.

    Null counts as empty, one blank line. Blank lines go only with the lines around
    them, see without_lines. Null ids lose nothing and take nothing. Rows that
    repeat an id never count against each other. Columns not named are not read,
    so their names can't clash. An empty table gives an empty result.
    """
    rows = docs.select(docs[key].cast("long").alias("doc"), F.coalesce(docs[text], F.lit("")).alias("text"), F.struct(*(docs[c] for c in carry or []), F.lit(0).alias("_")).alias("carried")).withColumn("tag", F.xxhash64("text"))
    joined = rows.join(_removed(rows), ["doc", "tag"], "left").select("doc", "text", "gone", "carried")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for t, gone in zip(batch.column(1), batch.column(2).to_pylist()):
                lines = t.as_py().split("\n")
                total.append(len(lines))
                without = without_lines(lines, set(gone or ()))
                removed.append(len(without))
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in without))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), batch.column(3)], ["doc", "n_lines", "n_removed", "kept", "carried"])

    fields = StructType([StructField("doc", LongType()), StructField("n_lines", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType()), StructField("carried", rows.schema["carried"].dataType)])
    return joined.mapInArrow(cut, fields).select(F.col("doc").alias(key), "n_lines", "n_removed", "kept", *(F.col(f"carried.`{c}`") for c in carry or []))

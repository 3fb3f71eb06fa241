"""Benchmark decontamination by pigeonhole edit matching (operator 5).

A test item may appear with up to `percent` of its characters edited. Cut into
one piece more than that budget, at least one piece must then appear unchanged.
The pieces of all items form one automaton; each exact piece hit in a document
opens a window where the item could lie, and Myers' bit-parallel algorithm gives
the least edit distance of the item to any part of the window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

#: Characters of items that are broadcast at once, about; more items are matched block after block.
BLOCK_CHARS = 8_000_000


def normal(text: str | None) -> str:
    """Lower case, runs of white space to one space, none at the ends."""
    return " ".join((text or "").lower().split())


def budget(length: int, percent: int) -> int:
    """Edits allowed in an item of so many characters; the rule is the same for all lengths."""
    return length * percent // 100


def pieces(length: int, edits: int) -> list[tuple[int, int]]:
    """edits + 1 pieces of near equal length."""
    n = edits + 1
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least distance of pattern to a part of text, end of the first such part)."""
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = full, 0, len(pattern)
    best, end = score, 0
    for at, c in enumerate(text, 1):
        same = where.get(c, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        rise, fall = down | (full & ~(horizontal | up)), up & horizontal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(vertical | rise)), rise & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]], percent: int) -> None:
        self.items = [(i, t, budget(len(t), percent)) for i, t in ((i, normal(t)) for i, t in items) if t]
        held: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, edits) in enumerate(self.items):
            for a, b in pieces(len(text), edits):
                held.setdefault(text[a:b], []).append((at, b))
        self.automaton = ahocorasick.Automaton()
        for piece, places in held.items():
            self.automaton.add_word(piece, places)
        if held:
            self.automaton.make_automaton()
        self.some = bool(held)

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item within its budget, in the normalised text."""
        if not self.some:
            return []
        text = normal(text)
        windows: dict[int, list[list[int]]] = {}
        for last, places in self.automaton.iter(text):
            for at, b in places:
                _, item, edits = self.items[at]
                begin = max(0, last + 1 - b - edits)
                end = min(len(text), last + 1 - b + len(item) + edits)
                mine = windows.setdefault(at, [])
                if mine and begin <= mine[-1][1] and end >= mine[-1][0]:
                    mine[-1] = [min(begin, mine[-1][0]), max(end, mine[-1][1])]
                else:
                    mine.append([begin, end])
        found = []
        for at, spans in windows.items():
            key, item, edits = self.items[at]
            tried = [(*myers(item, text[a:b]), a) for a, b in spans]
            distance, end, begin = min(tried)
            if distance <= edits:
                end += begin
                back = myers(item[::-1], text[max(0, end - len(item) - edits) : end][::-1])[1]
                found.append((key, distance, end - back, end))
        return sorted(found)


def leaks(docs: DataFrame, items: DataFrame, percent: int = 8, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """key, item_id, distance, start, end for each document row and item that it holds within the budget.

    Distances count characters of the normalised texts, as start and end do; the
    best place counts. Null and empty texts hold nothing, null and empty items are
    held by nothing; null ids stay as they are, repeated rows give repeated
    results. Other columns are not read. Of items, one block of about BLOCK_CHARS
    characters is broadcast at once; where there are more, each block's results are
    written before the next is read.
    """
    spark = docs.sparkSession
    listed = items.select(items[item_key].cast("long").alias("item_id"), items[item_text].alias("text")).where("text is not null")
    size = listed.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_CHARS))
    rows = docs.select(docs[key].cast("long").alias("doc"), docs[text].alias("text"))

    def matched(block: int) -> DataFrame:
        part = listed.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).toArrow()
        shared = spark.sparkContext.broadcast(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, percent)
            for batch in batches:
                found = [(doc, *hit) for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)) for hit in matcher.find(t.as_py())]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["doc", "item_id", "distance", "start", "end"])

        found = rows.mapInArrow(run, "doc long, item_id long, distance long, start long, end long")
        if blocks == 1:
            return found
        found = written(found)
        shared.destroy()
        return found

    return reduce(DataFrame.union, map(matched, range(blocks))).withColumnRenamed("doc", key)

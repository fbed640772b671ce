"""Best-fit packing after the dominance reduction of Martello and Toth.

Lengths are whole numbers from 1 to the capacity, so the whole problem is a
histogram with at most ``capacity`` entries: the plan is made on counts, never
on documents, and its size does not depend on theirs.

*Reduction*: taking the longest remaining length j, find the set that
dominates every other way to fill j's sequence and fix it: j alone if nothing
fits with it; j with the largest k that fits, if k fills the room, if only one
more piece fits or if k is as long as any two that fit together; and j with k
and a third piece at least as long as the smaller half of any pair that fits.
All copies are fixed at once; a length that no rule decides stays for best fit.
*Remainder*: best fit decreasing, on runs of equal lengths.

Each piece is numbered among the pieces of its length (counts per written
partition, then a running sum over partitions) and looks up its place in the
plan by that number.

Defined cases: a null text is the empty text (one piece, the end id); repeated
rows are packed each; null ids are kept.  Only the id and text columns are
read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import tokens
from shoplens.llm.common import stored, text_or_empty
from shoplens.session import ship_package


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how many sequences, their lengths) covering every piece once."""
    left = {w: c for w, c in counts.items() if c > 0}
    sizes = sorted(left)
    fixed: list[tuple[int, list[int]]] = []

    def take(times: int, lengths: list[int]) -> None:
        fixed.append((times, lengths))
        for w in lengths:
            left[w] -= times
        for w in set(lengths):
            if not left[w]:
                del left[w]
                sizes.pop(bisect_left(sizes, w))

    def copies(lengths: list[int]) -> int:
        return min(left[w] // lengths.count(w) for w in set(lengths))

    # Candidates come from every piece that is left, also from longer ones
    # that no rule could decide: a set is fixed only if it dominates them too.
    for j in sorted(counts, reverse=True):
        while left.get(j):
            got = _dominating(j, capacity - j, sizes, left)
            if got is None:
                break
            take(copies(got), got)
    return fixed + best_fit(left, capacity)


def _dominating(j: int, room: int, sizes: list[int], left: dict[int, int]) -> list[int] | None:
    """The set that dominates every other set holding a piece j, if one is known.

    A set dominates another if the other's pieces can be dealt to its own
    without any overflowing: then exchanging them never costs a sequence.
    """
    def spare(w: int, used: tuple[int, ...]) -> bool:
        return left[w] > used.count(w)

    def largest(limit: int, used: tuple[int, ...]) -> int | None:
        k = bisect_left(sizes, limit + 1) - 1
        while k >= 0 and not spare(sizes[k], used):
            k -= 1
        return sizes[k] if k >= 0 else None

    def smallest(used: tuple[int, ...]) -> int | None:
        return next((w for w in sizes if spare(w, used)), None)

    best = largest(room, (j,))
    if best is None:
        return [j]
    if best == room:
        return [j, best]
    one = smallest((j,))
    two = smallest((j, one))
    if two is None or one + two > room:
        return [j, best]  # one more piece at most
    three = smallest((j, one, two))
    if three is not None and one + two + three <= room:
        return None  # three or more fit: left to best fit
    # Two more at most: over all pairs that fit, the largest smaller half and
    # the largest sum.
    half = top = 0
    for d in sizes[:bisect_left(sizes, room // 2 + 1)]:
        if spare(d, (j,)) and (c := largest(room - d, (j, d))) is not None and c >= d:
            half, top = max(half, d), max(top, c + d)
    if best >= top:
        return [j, best]
    b = largest(room - best, (j, best))
    return [j, best, b] if b is not None and b >= half else None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit decreasing on runs: each step fills many like sequences at once."""
    rooms: list[int] = []  # distinct rooms of open sequences, ascending
    open_: dict[int, list[tuple[int, list[int]]]] = {}

    def put(times: int, lengths: list[int], room: int) -> None:
        if room not in open_:
            insort(rooms, room)
            open_[room] = []
        open_[room].append((times, lengths))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            k = bisect_left(rooms, w)
            if k == len(rooms):
                times, lengths, room = n, [], capacity
            else:
                room = rooms[k]
                times, lengths = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(k)
            each = min(room // w, n)
            filled = min(times, n // each)
            if lengths and times > filled:
                put(times - filled, lengths, room)
            put(filled, lengths + [w] * each, room - each * w)
            n -= filled * each
    return [run for runs in open_.values() for run in runs]


def plan_rows(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, last number, first sequence, offset) of the plan:
    piece number x of the length goes to sequence ``first sequence + x - first number``."""
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for times, lengths in plan(counts, capacity):
        offset = 0
        for w in lengths:
            rows.append((w, used[w], used[w] + times - 1, sequence, offset))
            used[w] += times
            offset += w
        sequence += times
    return rows


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes the rest."""
    first = length % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, number long"


def piece_rows(path: str, end_id: int, spaced: bool, pattern: str, capacity: int,
               remembered: int = tokens.LIMIT) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) -> pieces; ``number`` counts equal lengths in the task."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.library_encoder(path, spaced, tokens.split_words(pattern), remembered)
        tail = tokens.packed([end_id])
        seen: dict[int, int] = {}
        row = 0
        for batch in stream:
            ids = batch.column(0).to_pylist()
            at = 0
            for texts in tokens.text_runs(batch.column(1)):
                out: list[list] = [[] for _ in range(7)]
                for raw in cache.ids(texts):
                    raw += tail
                    for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        number = seen.get(length, 0)
                        seen[length] = number + 1
                        for column, v in zip(out, (row, ids[at], k, start, length,
                                                   zlib.crc32(raw[start * 4:(start + length) * 4]), number)):
                            column.append(v)
                    row += 1
                    at += 1
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                                 names=[f.split()[0] for f in PIECES.split(", ")])

    return run


def placed(plan_table: list[tuple[int, int, int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds sequence_id and offset to batches of pieces with a global number."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        rows = np.array(sorted(plan_table), dtype=np.int64).reshape(-1, 5)
        key = rows[:, 0] << 48 | rows[:, 1]
        for batch in stream:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(key, length << 48 | number, side="right") - 1
            keep = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(rows[at, 3] + number - rows[at, 1]), pa.array(rows[at, 4])],
                names=[*keep, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool, pattern: str, capacity: int = 1024,
         id_col: str = "doc_id", text_col: str = "text", remembered: int = tokens.LIMIT) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    The driver sees one row per distinct length, ``capacity`` at most.  A worker
    remembers the ids of ``remembered`` pieces of text: that is memory against time.
    """
    ship_package(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    pieces = stored(d.mapInArrow(piece_rows(tokenizer, end_id, spaced, pattern, capacity, remembered), PIECES)
                    .withColumn("part", F.spark_partition_id()), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("earlier"))
    numbered = (pieces.join(before, ["part", "length"])
                .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("earlier")).alias("number")))
    return numbered.mapInArrow(placed(plan_rows(histogram, capacity)),
                               "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

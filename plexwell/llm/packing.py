"""Best-fit packing by exact-complement hashing.

Packing depends on nothing but how many pieces have each length, so a plan is made over that histogram (at most
``capacity`` numbers, whatever the corpus) and pieces then find their places by their rank among those of equal length.
A sequence starts from the longest length left; its gap is closed exactly by one, two or three available lengths where
their sums allow (longest first), else by the longest that fits, until the gap is closed or nothing fits.

Null texts are empty (one end id). Rows with equal or null doc_id are separate documents. An empty table gives no rows.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, cut_batches, giving_back, short_batches
from .tokens import encoder

#: Less of all that a worker holds than ``op1`` needs for its time: places for kept units, bytes of text and rows at a time.
SLOTS, CUT_BYTES, CUT_ROWS = 1 << 19, 4 << 20, 1000
_PIECES = "part int, doc_id long, piece int, start long, length int, ids_crc32 long, nth long"


def _exact(have: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three lengths with positive counts in ``have`` that sum to ``gap``; longest first, else None."""
    if have[gap] > 0:
        return [gap]
    present = np.flatnonzero(have[:gap])
    if not present.size:
        return None
    other = gap - present
    ok = present[(present >= other) & (have[other] > (present == other))]
    if ok.size:
        return [int(ok[-1]), gap - int(ok[-1])]
    for a in present[present >= gap / 3][::-1].tolist():  # the longest of three
        rest = gap - a
        second = present[(present <= a) & (2 * present >= rest) & (present < rest)]
        third = rest - second
        need_b = 1 + (second == a)
        need_c = 1 + (third == second) + (third == a)
        ok = second[(have[second] >= need_b) & (have[third] >= need_c)]
        if ok.size:
            return [a, int(ok[-1]), rest - int(ok[-1])]
    return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Patterns (length: how many) and how many sequences use each. ``counts[n]``: pieces of length n."""
    left = counts.astype(np.int64).copy()
    out = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        have, parts, gap = left.copy(), [longest], capacity - longest
        have[longest] -= 1
        while gap:
            found = _exact(have, gap)
            if found is None:
                fits = np.flatnonzero(have[: gap + 1])
                if not fits.size:
                    break
                found = [int(fits[-1])]
            for n in found:
                have[n] -= 1
                gap -= n
            parts += found
        pattern = Counter(parts)
        times = min(int(left[n]) // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= k * times
        out.append((pattern, times))
    return out


def placements(patterns: list[tuple[Counter, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, per sequence, offset), by length and rank: where ranks of a length go.

    Rank r of a row goes to sequence ``first + (r - first rank) // per``. As many rows as patterns have lengths; the
    number of patterns depends on the capacity, not on the corpus.
    """
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            rows.append((n, used[n], sequence, pattern[n], offset))
            used[n] += pattern[n] * times
            offset += n * pattern[n]
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _cut(path: str, end_id: int, capacity: int):
    def run(batches):
        enc, part, nth = encoder(path, SLOTS), TaskContext.get().partitionId(), Counter()
        for batch in cut_batches(batches, 1, CUT_BYTES):
            cols: list[list] = [[] for _ in range(7)]
            found, counts = enc.encode_all(batch.column(1))
            ends = np.cumsum(counts)
            coded, ends = memoryview(np.insert(found, ends, end_id)).cast("B"), 4 * (ends + np.arange(1, len(ends) + 1))
            for doc, first, last in zip(batch.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                raw = coded[first:last]
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at : at + 4 * capacity]
                    n = len(cut) // 4
                    for c, v in zip(cols, (part, doc, k, at // 4, n, zlib.crc32(cut), nth[n]), strict=True):
                        c.append(v)
                    nth[n] += 1
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in _PIECES.split(", ")])

    return run


def _place(table: np.ndarray):
    def run(batches):
        # one sorted key for length and rank: 2^44 ranks for each length
        keys = (table[:, 0] << 44) | table[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, (length << 44) | rank, side="right") - 1] if len(length) else table[:0]
            after = rank - row[:, 1]
            sequence, offset = row[:, 2] + after // row[:, 3], row[:, 4] + after % row[:, 3] * length
            cols = [batch.column(i) for i in (0, 1, 2)] + [pa.array(length), batch.column(4), pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text)."""
    scratch = Scratch(spark, "packing")
    with short_batches(spark, CUT_ROWS):
        pieces = scratch.table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(_cut(path, end_id, capacity)), _PIECES), "pieces")
    # a length may hold a third of all pieces: tasks number their own, and only their counts are summed by length
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.table(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")), "offsets")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        histogram[r["length"]] = r["n"]
    table = placements(plan(histogram, capacity))
    # merged, not broadcast: this table grows with the number of tasks
    ranked = pieces.join(offsets.select("part", "length", "earlier").hint("merge"), ["part", "length"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("earlier")).alias("rank")).mapInArrow(
        _place(table), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )

"""Best-fit packing of tokenized documents into sequences of a fixed number of tokens.

Bulk-synchronous best-fit. Pieces are range-sorted by length, then by (doc_id, piece), and get a rank
among the pieces of their length: a sort, per-partition counts and a prefix sum, with no task that
holds one length. A superstep then takes the longest unplaced length and sweeps over the open gaps in
order of size: the successor gap (the smallest that holds the piece) takes pieces first, the next one
after it, and a gap that can hold several takes them side by side. Pieces of equal length that want
the same gap are told apart by rank: rank r goes to the r-th place of the sweep. Gaps shrink by what
they took, fall back into the order, and the next superstep begins; what no gap holds opens sequences.

Lengths and gaps are integers of at most ``capacity``, so the sweep's state isn't rows but runs of
equal gaps: at most a few runs for each length, whatever the number of documents (``plan``). Each
superstep's matches are intervals of ranks; every piece finds its own interval in a table whose size
depends on the capacity alone, and so does its sequence and offset. This equals best-fit decreasing on
the rows themselves.

Cases: a null text is empty and still has the end id. Null doc_ids stay null. Equal rows are packed
each on its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import spread, written
from lakeweave.llm.tokens import encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """A row for each piece. A longer document's pieces are full but for the first, which may be shorter."""

    def cut(batches):
        for batch in batches:
            keys = batch.column("doc_id").cast(pa.int64())
            for at, ends, ids in encoder(tokenizer).encode_column(batch.column("text")):
                n = len(ends) - 1
                if not n:
                    continue
                sizes = np.diff(ends) + 1
                raw = np.full(len(ids) + n, end_id, "<u4")
                last = np.zeros(len(raw), bool)
                stops = np.cumsum(sizes)
                last[stops - 1] = True
                raw[~last] = ids
                view = memoryview(raw.tobytes())
                count = -(-sizes // capacity)
                owner = np.repeat(np.arange(n), count)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                head = sizes - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[owner], capacity)
                begin = (stops - sizes)[owner] + start
                crc = [zlib.crc32(view[4 * b : 4 * (b + k)]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, n).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(rows).mapInArrow(cut, PIECE)


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over runs of equal gaps.

    counts: pieces by length. Returns intervals (length, first rank, first sequence, pieces in each
    sequence, offset of the first piece): from the first rank on, every ``pieces`` ranks go side by side
    into one sequence, and the next ones into the next sequence; and the number of sequences.
    """
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), sorted by gap
    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank, at, changed = counts[length], 0, bisect_left(gaps, (length, -1, -1)), []
        while left and at < len(gaps):
            gap, first, n = gaps[at]
            each = gap // length
            full, odd = divmod(left, each)
            full = min(full, n)
            took = full * each
            if full:
                out.append((length, rank, first, each, capacity - gap))
                changed.append((gap - each * length, first, full))
            if full < n and (odd := min(odd, left - took)):
                out.append((length, rank + took, first + full, odd, capacity - gap))
                changed.append((gap - odd * length, first + full, 1))
                took += odd
            used = full + (took > full * each)
            rank, left = rank + took, left - took
            if used < n:
                gaps[at] = (gap, first + used, n - used)
                at += 1
            else:
                del gaps[at]
        if left:
            each = capacity // length
            full, odd = divmod(left, each)
            if full:
                out.append((length, rank, opened, each, 0))
                changed.append((capacity - each * length, opened, full))
            if odd:
                out.append((length, rank + full * each, opened + full, odd, 0))
                changed.append((capacity - odd * length, opened + full, 1))
            opened += full + bool(odd)
        for run in changed:
            if run[0] > 0:
                insort(gaps, run)
    return out, opened


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...), which should be a written table."""
    ordered = written(spark, pieces.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece").mapInArrow(_number_runs, f"{PIECE}, part int, local long"), "pieces-by-length")
    runs = ordered.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for row in sorted(runs, key=lambda r: (r.length, r.part)):  # a row for each partition and each length's first
        base[row.length, row.part] = counts.get(row.length, 0)
        counts[row.length] = counts.get(row.length, 0) + row.n
    intervals, _ = plan(counts, capacity)
    by_length: dict[int, list] = {}
    for length, *rest in intervals:
        by_length.setdefault(length, []).append(rest)
    tables = {k: np.array(sorted(v), np.int64) for k, v in by_length.items()}

    def place(batches):
        for batch in batches:
            length, part = batch.column("length").to_numpy(), batch.column("part").to_numpy()
            rank = batch.column("local").to_numpy().copy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                here = np.flatnonzero(length == k)
                for p in np.unique(part[here]):
                    rank[here[part[here] == p]] += base[int(k), int(p)]
                table = tables[int(k)]
                row = table[np.searchsorted(table[:, 0], rank[here], "right") - 1]
                beyond = rank[here] - row[:, 0]
                sequence[here] = row[:, 1] + beyond // row[:, 2]
                offset[here] = row[:, 3] + beyond % row[:, 2] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:-2], "sequence_id", "offset"])

    return ordered.mapInArrow(place, f"{PIECE}, sequence_id long, offset long")


def _number_runs(batches):
    """Number the rows of each length within a partition that is sorted by length."""
    part, now, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        length = batch.column("length").to_numpy()
        new = np.append(True, length[1:] != length[:-1])
        first = np.flatnonzero(new)
        local = np.arange(len(length)) - np.repeat(first, np.diff(np.append(first, len(length))))
        if length[0] == now:
            local[: first[1] if len(first) > 1 else len(length)] += seen
        now, seen = length[-1], int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(local)], names=[*batch.schema.names, "part", "local"])


def best_fit_pack(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Tokenize docs (doc_id, text), cut them into pieces and pack the pieces."""
    pieces = written(spark, cut_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack_pieces(spark, pieces, capacity)

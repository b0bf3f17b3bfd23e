"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids (its text's tokens, then the id `end`) are cut into pieces: as many of `capacity` ids as it has, each a
sequence by itself, and the rest in pieces of at most `part`. The rests are dealt out into groups of about WINDOWS windows. In
a group every piece starts as a partition of itself and empty windows; the two partitions of the largest imbalance are joined
again and again, the fullest window of one with the emptiest of the other, which leaves near-equal windows. While the fullest
exceeds the capacity, the group is packed again with one window more.

Null and empty texts are the one id `end`. Every row of docs is packed, repeated rows and null ids too. Rows are dealt out
by their place in a stored table, not by their values, so that no copy or id makes a large group. An empty table gives an
empty result. The result has columns of its own only; extra columns of docs, whatever their names, are not read. Only pieces' numbers are shuffled, no ids.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from ._runtime import modest, release, stored

CAPACITY, PART, WINDOWS, END = 1024, 256, 64, 0


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """m windows of near-equal sums, each a list of indices."""
    empty: list[tuple[int, ...]] = [()] * m
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(m, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [(i,), *empty[1:]]))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a, wa = heapq.heappop(heap)
        _, _, b, wb = heapq.heappop(heap)
        both = a + b[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        joined = [x + y for x, y in zip(wa, reversed(wb), strict=True)]
        n += 1
        heapq.heappush(heap, (int(both[-1] - both[0]), n, both, [joined[i] for i in order.tolist()]))
    return [list(w) for w in heap[0][3]] if heap else [[] for _ in range(m)]


def packed(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows within capacity, as few as differencing finds from the least possible number on."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, m)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        m += 1


def pieces(docs: DataFrame, *, text: str, doc_id: str, path: str | None, capacity: int, part: int, end: int) -> DataFrame:
    """Stored: doc_id, start, length, ids_crc32, doc_tokens; texts are tokenized once."""
    path = path or tokens.default_path()
    modest(docs.sparkSession)
    close = np.array([end], "<u4").tobytes()

    def cut(batches):
        for b in batches:
            code = tokens.ids(path)
            row, start, length, crc, total = [], [], [], [], []
            for i, t in enumerate(b.column(1)):
                ids = code.ids(t.as_py() or "") + close
                n = len(ids) // 4
                whole = n - n % capacity
                bounds = [*range(0, whole, capacity), *range(whole, n, part), n]
                for x, y in zip(bounds, bounds[1:], strict=False):
                    row.append(i)
                    start.append(x)
                    length.append(y - x)
                    crc.append(zlib.crc32(ids[4 * x : 4 * y]))
                    total.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        tokens.ids(path).forget()
        release()

    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")


def packing(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", path: str | None = None, capacity: int = CAPACITY, part: int = PART, windows: int = WINDOWS, end: int = END) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = pieces(docs, text=text, doc_id=doc_id, path=path, capacity=capacity, part=part, end=end)
    rows = cut.withColumn("_sw_row", F.monotonically_increasing_id())
    full = rows.where(F.col("length") == capacity).withColumn("sequence_id", F.col("_sw_row") * 2 + 1).withColumn("offset", F.lit(0).cast("long")).drop("_sw_row")
    rest = rows.where(F.col("length") < capacity)
    total = cut.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (windows * capacity)))
    rest = rest.withColumn("_sw_group", F.pmod(F.xxhash64("_sw_row"), F.lit(groups)))
    kind = dict(docs.dtypes)[doc_id]

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_sw_row")
        found = packed(rows["length"].to_pylist(), capacity)
        each = [len(w) for w in found]
        out = rows.take(pa.array([i for w in found for i in w], pa.int64()))
        size, number = out["length"].to_numpy(), np.repeat(np.arange(len(found)), each)
        before = np.cumsum(size) - size
        offset = before - np.repeat(before[np.cumsum(each) - each], each)
        sequence = ((out["_sw_group"].to_numpy() << 20) | number) * 2
        return out.drop_columns(["_sw_row", "_sw_group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return full.unionByName(rest.groupBy("_sw_group").applyInArrow(pack, schema))

"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import checkpointed, freeing, joined_evenly, numbered, tune


#: Groups of a task that are differenced at once.
BLOCK = 1 << 14


def difference(partials: Sequence[Sequence[int]], bins: int) -> np.ndarray:
    """For each partial partition (its bins' sums), the final bin of each of its bins.

    The two partial partitions with the largest spread are combined again and again,
    the largest bins of one with the smallest of the other. Integers stay exact.
    """
    n = len(partials)
    if not n:
        return np.zeros((0, bins), np.int64)
    nodes: list[tuple[int, int, list[int], list[int]]] = []  # the two combined and where their bins go
    heap = []
    for k, sums in enumerate(partials):
        order = sorted(range(bins), key=lambda b: (-sums[b], b))
        values = [sums[b] for b in order]
        place = [0] * bins
        for new, b in enumerate(order):
            place[b] = new
        nodes.append((-1, -1, place, place))
        heap.append((values[-1] - values[0], k, values))
    heapq.heapify(heap)
    turn = range(bins - 1, -1, -1)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        summed = [x[k] + y[bins - 1 - k] for k in range(bins)]
        order = sorted(range(bins), key=summed.__getitem__, reverse=True)
        values = [summed[k] for k in order]
        place = [0] * bins
        for new, k in enumerate(order):
            place[k] = new
        nodes.append((a, b, place, [place[k] for k in turn]))
        heapq.heapreplace(heap, (values[-1] - values[0], len(nodes) - 1, values))
    final: list[list[int] | None] = [None] * len(nodes)
    final[-1] = list(range(bins))
    for k in range(len(nodes) - 1, n - 1, -1):
        a, b, pa_, pb = nodes[k]
        at = final[k]
        final[a], final[b], final[k] = [at[i] for i in pa_], [at[i] for i in pb], None
    return np.array([[final[k][i] for i in nodes[k][2]] for k in range(n)], np.int64)


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = 8) -> DataFrame:
    """A shard for every row; rows of equal text stay together and the shards' bytes are near equal.

    A row's size is the UTF-8 bytes of its text plus 1. Groups of equal text (by SHA-256)
    are summed before they meet; each task differences the groups dealt to it, the largest
    first and BLOCK at a time, into one partial partition, and the partial partitions, one of
    bins sums for each task, are differenced in turn: the same rule on each level, with nothing
    but sums at the top.
    Returns the id, size, text_crc32 (unsigned), law ('bytes'), shard, slot (from 0
    without gaps in a shard) and grown_shard (null: this law has none).

    A null text counts as empty and joins the group of empty texts. Repeated rows are
    rows of their own, null ids are kept, an empty table gives no rows; other columns
    are not read. A group larger than a fair share makes its shard that much larger.
    """
    tune(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
    )
    rows = checkpointed(rows)
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("_n")).sortWithinPartitions(F.desc("bytes"), "key")

    @freeing
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, whole = TaskContext.get().partitionId(), [0] * bins
        for batch in batches:
            for lo in range(0, len(batch), BLOCK):
                block = batch.slice(lo, BLOCK)
                sizes = block.column(1).to_pylist()
                bin_ = difference([[s, *[0] * (bins - 1)] for s in sizes], bins)[:, 0]
                sums = [0] * bins
                for s, k in zip(sizes, bin_.tolist(), strict=True):
                    sums[k] += s
                kept, new = difference([whole, sums], bins).tolist()  # the block's bins go where they even out what is there
                at = {f: k for k, f in enumerate(kept)}
                to = [at[f] for f in new]
                for k, s in zip(to, sums, strict=True):
                    whole[k] += s
                more = [pa.array(np.full(len(sizes), task, np.int64)), pa.array(np.array(to, np.int64)[bin_])]
                yield pa.RecordBatch.from_arrays([*block.columns, *more], ["key", "bytes", "_n", "task", "bin"])

    dealt = checkpointed(groups.mapInArrow(local, "key binary, bytes long, _n long, task long, bin long"))
    sums: dict[int, list[int]] = {}
    for r in dealt.groupBy("task", "bin").agg(F.sum("bytes").alias("bytes")).collect():  # bins rows for each task
        sums.setdefault(r["task"], [0] * bins)[r["bin"]] = r["bytes"]
    tasks = sorted(sums)
    place = difference([sums[t] for t in tasks], bins).tolist()
    lookup = [(t, b, place[k][b]) for k, t in enumerate(tasks) for b in range(bins)]
    to_shard = docs.sparkSession.createDataFrame(lookup, "task long, bin long, shard int")
    dealt = dealt.join(F.broadcast(to_shard), ["task", "bin"]).select("key", "shard", "_n")
    total = rows.count()

    @freeing
    def place_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(bins, np.int64)
        for batch in batches:
            shard = batch.column(3).to_numpy()
            k = np.zeros(len(shard), np.int64)
            for b in range(bins):
                own = shard == b
                k[own] = seen[b] + np.arange(own.sum())
                seen[b] += own.sum()
            more = [pa.array(np.full(len(k), part, np.int64)), pa.array(k)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "k"])

    kind = docs.schema[id_col].dataType.simpleString()
    met = joined_evenly(rows, dealt, "key", total).select("id", "size", "text_crc32", "shard")
    met = met.mapInArrow(place_in_task, f"id {kind}, size long, text_crc32 long, shard int, part long, k long")
    return numbered(checkpointed(met), "shard", "slot", across=False).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

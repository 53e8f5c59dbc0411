"""Packing of whole documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm import bpe, byte_bpe
from siltline.llm.common import checkpointed, freeing, tune

#: Pieces that one task packs at once. A hash deals them out, so each task meets the lengths of the whole table.
GROUP = 1 << 14


class OpenBins:
    """Bins of a fixed size by residual gap."""

    def __init__(self, most: int):
        self.most, self.made = most, 0
        self.count = np.zeros(most + 1, np.int64)  # open bins by gap; full ones are not open
        self.bins: dict[int, list[int]] = defaultdict(list)

    def gap_for(self, size: int) -> int:
        """The gap that an item of size should go to: where the sum of the squared counts becomes smallest, of equal ones the least gap; most for a new bin.

        Moving a bin from gap g to g - size changes the sum by 2 (count[g - size] - count[g]) + 2, and
        filling it by 1 - 2 count[g]. A new bin is opened only where no open one has room.
        """
        before = self.count[size : self.most]
        change = 2 * (self.count[: self.most - size] - before) + 2
        if len(change):
            change[0] = 1 - 2 * before[0]
            change[before == 0] = np.iinfo(np.int64).max
            g = int(change.argmin())
            if before[g]:
                return g + size
        return self.most

    def place(self, size: int) -> tuple[int, int]:
        """The bin that an item of size, of 1 to most, goes to, and where in it."""
        g = self.gap_for(size)
        if g == self.most:
            number, self.made = self.made, self.made + 1
        else:
            number = self.bins[g].pop()
            self.count[g] -= 1
        if g > size:
            self.bins[g - size].append(number)
            self.count[g - size] += 1
        return number, self.most - g


def _cut(vocabulary: str, ranks: str, most: int, end_id: int):
    """Rows (id, text) to the pieces of each, with the task that made them and their place in it."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe.encoder(vocabulary, ranks)
        task, last, made = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes(), 0
        for batch in (part for whole in batches for part in bpe.parts(whole)):
            ids, begin = encoder.encode(pc.fill_null(batch.column(1), ""))
            total = np.diff(begin) + 1
            head = np.where(total % most, total % most, most)  # the first piece takes what the others leave
            pieces = 1 + (total - head) // most
            row = np.repeat(np.arange(len(batch)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.where(piece, head[row] + (piece - 1) * most, 0)
            length = np.where(piece, most, head[row])
            crcs = []
            for k, n, lengths in zip(range(len(batch)), pieces.tolist(), np.split(length, np.cumsum(pieces)[:-1]), strict=True):
                doc, at = memoryview(ids[begin[k] : begin[k + 1]].astype("<u4").tobytes() + last), 0
                for size in lengths.tolist() if n > 1 else [len(doc) // 4]:
                    crcs.append(zlib.crc32(doc[4 * at : 4 * (at + size)]))
                    at += size
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
            columns += [pa.array(np.full(len(row), task)), pa.array(made + np.arange(len(row)))]
            made += len(row)
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "part", "k"])

    return rows


def _pack(most: int, groups: int):
    """Over rows (group, length, others), a group's together and the longest first: their sequence and place in it."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, OpenBins(most)
        for batch in batches:
            sequence, offset = [], []
            for group, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if group != now:
                    now, bins = group, OpenBins(most)
                number, at = bins.place(length)
                sequence.append(2 * (number * groups + group))
                offset.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*batch.schema.names[1:], "sequence_id", "offset"])

    return rows


def pack_whole(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = byte_bpe.VOCABULARY,
    ranks: str = byte_bpe.RANKS,
    most: int = 2048,
    end_id: int = 0,
    group: int = GROUP,
) -> DataFrame:
    """Documents packed whole into sequences of at most most ids, as few as the sum-of-squares rule gives.

    A document is its ids and then end_id. One of more than most ids is cut into pieces of most, its
    first piece being what is left over; no other is cut. Pieces of most ids are sequences of their
    own. The others are dealt by a hash to groups of about group pieces, and each group is packed by
    one task, the longest first: a piece goes where the sum of the squared counts of open bins for
    each residual gap becomes smallest, and to a new bin only where none has room. So at most one
    sequence of a group is half empty or less, and the state of a task is a count for each gap and
    the numbers of its open bins. Returns a row per piece: the id, piece (from 0), start (ids of its
    document before it), length, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers),
    sequence_id (any numbers; odd ones are pieces of most ids) and offset (ids before it there).

    A null or empty text is end_id alone; an empty table gives no rows. Repeated rows and null ids are
    packed like any others; very long texts give more pieces; pieces of equal length are taken in the
    order of the tasks that read them; other columns are not read.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    fields = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = checkpointed(rows.mapInArrow(_cut(vocabulary, ranks, most, end_id), f"{fields}, part long, k long"))
    short, full = pieces.where(F.col("length") < most), pieces.where(F.col("length") == most)
    groups = max(1, -(-short.count() // group))
    short = short.withColumn("group", F.pmod(F.xxhash64("part", "k"), F.lit(groups)))
    dealt = short.repartitionByRange(groups, "group").sortWithinPartitions("group", F.desc("length"), "part", "k")
    packed = dealt.select("group", "length", "id", "piece", "start", "ids_crc32").mapInArrow(
        _pack(most, groups), f"length long, id {kind}, piece int, start long, ids_crc32 long, sequence_id long, offset long"
    )
    own = (2 * (F.shiftleft("part", 33) + F.col("k")) + 1).alias("sequence_id")
    out = ["id", "piece", "start", "length", "ids_crc32"]
    full = full.select(*out, own, F.lit(0).cast("long").alias("offset"))
    packed = packed.select(*out, "sequence_id", "offset").unionAll(full)
    return packed.withColumnRenamed("id", id_col)

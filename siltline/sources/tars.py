"""Tar shards: a Spark data source that reads them as streams, an index of their headers, and reads of chosen members by their bytes."""

from __future__ import annotations

import io
import re
import tarfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from siltline.functions.expr import shard_number
from siltline.shared import checkpointed, shared_folder

# Extensions of audio files.
AUDIO = ("mp3", "wav", "flac", "m4a", "ogg", "opus")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path: by its scheme, or the file system that driver and executors share."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TarShard(InputPartition):
    def __init__(self, path: str, shard: int | None):
        self.path, self.shard = path, shard


class TarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.wanted = {int(s) for s in options.get("shards", "").split(",") if s}
        self.extensions = tuple(f".{e}" for e in options.get("extensions", ",".join(AUDIO)).split(","))
        self.most = int(options.get("limit_per_shard", 0))

    def partitions(self) -> list[TarShard]:
        store, path = _open(self.folder)
        scheme = self.folder.partition("://")[0] + "://" if "://" in self.folder else ""
        info = store.get_file_info(path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        out = []
        for f in sorted(found, key=lambda f: f.path):
            if f.is_file and re.search(r"\.tar(\.gz|\.bz2|\.xz)?$", f.path):
                digits = re.sub("[^0-9]", "", f.base_name.split(".tar")[0])
                shard = int(digits) if digits else None
                if not self.wanted or shard in self.wanted:
                    out.append(TarShard(f"{scheme}{f.path.lstrip('/') if scheme and not scheme.startswith('file') else f.path}", shard))
        return out

    def read(self, partition: TarShard) -> Iterator[tuple]:
        store, path = _open(partition.path)
        sent = 0
        with store.open_input_stream(path, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
            for member in tar:
                if self.most and sent >= self.most:  # the rest of the shard is not read
                    return
                name = member.name.rsplit("/", 1)[-1]
                if member.isfile() and name.lower().endswith(self.extensions):
                    sent += 1
                    yield partition.path, partition.shard, name, tar.extractfile(member).read()


class TarStream(DataSourceStreamReader):
    """New shards of a folder as a stream: an offset names the shards seen so far, so each is read in one batch, once."""

    def __init__(self, options: dict):
        self.shards = TarReader(options)

    def initialOffset(self) -> dict:
        return {"seen": []}

    def latestOffset(self) -> dict:
        return {"seen": [p.path for p in self.shards.partitions()]}

    def partitions(self, start: dict, end: dict) -> list[TarShard]:
        seen, now = set(start["seen"]), set(end["seen"])
        return [p for p in self.shards.partitions() if p.path in now and p.path not in seen]

    def read(self, partition: TarShard) -> Iterator[tuple]:
        return self.shards.read(partition)


class TarShards(DataSource):
    """Options: path (a folder or one tar), shards ('1,2'), extensions ('wav,mp3') and limit_per_shard (0: all)."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return "path string, shard int, name string, content binary"

    def reader(self, schema) -> TarReader:
        return TarReader(self.options)

    def streamReader(self, schema) -> TarStream:
        return TarStream(self.options)


def read_tars(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The members of tar shards: path, shard, name, content."""
    spark.dataSource.register(TarShards)
    return spark.read.format("tar_shards").options(path=path, **options).load()


def stream_tars(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The members of tar shards as a stream: a folder's shards at first, then those that have come since. A shard must be whole when it gets its name."""
    spark.dataSource.register(TarShards)
    return spark.readStream.format("tar_shards").options(path=path, **options).load()


#: Bytes of members that one task reads, about; a larger member stands alone.
SPLIT_BYTES = 64 << 20
#: Bytes of members that are handed on at once.
_HANDED = 8 << 20


def _seekable(path: str) -> bool:
    return path.endswith(".tar")


def tar_index(shards: DataFrame) -> DataFrame:
    """path, shard, name, member, offset and size of the files in tar shards (path): their headers are read, and no payload.

    A task goes through whole shards, several where there are many. offset is null for a compressed shard, whose bytes can't be found without
    reading all before them.
    """

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            store, where = _open(path)
            plain, rows = _seekable(path), []
            with store.open_input_file(where) if plain else store.open_input_stream(where, compression=None) as stream, tarfile.open(fileobj=stream, mode="r:" if plain else "r|*") as tar:
                for member in tar:
                    if member.isfile():
                        rows.append((path, member.name.rsplit("/", 1)[-1], member.name, member.offset_data if plain else None, member.size))
                    tar.members = []  # else the library keeps every header
                    if len(rows) >= 4096:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)

    names = shards.select("path").distinct()
    tasks = min(names.count(), 8 * names.sparkSession.sparkContext.defaultParallelism)  # a task for each of many small shards would cost more than their headers
    dealt = names.repartition(max(1, tasks), "path")  # a row for each shard
    out = dealt.mapInArrow(headers, "path string, name string, member string, offset long, size long")
    return out.select("path", shard_number(F.col("path")).alias("shard"), "name", "member", "offset", "size")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "name", "member", "offset", "size"])


def tar_payloads(members: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """members (of tar_index, with any further columns) and their content.

    Members are dealt out by ranges of (path, offset), so a large shard gives many tasks, each of which reads
    about split bytes of it, in order. Only the members asked for are read, of compressed shards all before the last of them.
    """
    members = checkpointed(members)  # names and places, no payload
    total = members.agg(F.sum("size")).first()[0] or 0
    dealt = members.repartitionByRange(max(1, -(-total // split)), "path", F.coalesce("offset", F.lit(0))).sortWithinPartitions("path", "offset", "member")
    path, member, offset, size = (members.columns.index(c) for c in ("path", "member", "offset", "size"))

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        places = zip(range(len(batch)), *(batch.column(k).to_pylist() for k in (path, member, offset, size)), strict=True)
        for p, own in groupby(places, key=itemgetter(1)):
            store, where = _open(p)
            if _seekable(p):
                with store.open_input_file(where) as file:
                    for k, _, _, at, n in own:
                        yield k, file.read_at(n, at)
                continue
            wanted = {m: k for k, _, m, _, _ in own}
            with store.open_input_stream(where, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
                for m in tar:
                    if m.name in wanted and m.isfile():
                        yield wanted.pop(m.name), tar.extractfile(m).read()
                        if not wanted:
                            break
                    tar.members = []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out, held = [], [], 0
            for k, data in contents(batch):
                at.append(k)
                out.append(data)
                held += len(data)
                if held >= _HANDED:
                    yield _with(batch, at, out)
                    at, out, held = [], [], 0
            if at:
                yield _with(batch, at, out)

    return dealt.mapInArrow(rows, T.StructType([*members.schema.fields, T.StructField("content", T.BinaryType())]))


def _with(batch: pa.RecordBatch, at: list[int], content: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, pa.array(content, pa.binary())], [*batch.schema.names, "content"])


def write_tars(members: DataFrame, folder: str, prefix: str = "shard") -> DataFrame:
    """Writes members (shard, name, content) as <folder>/<prefix>_<shard>.tar, by name in each; returns shard, path, members and bytes.

    One task writes a shard, as a tar is one sequence; how much is in one is the caller's to choose. A task that runs
    again writes its shards anew: each gets its name when it is whole.
    """
    spark = members.sparkSession
    folder = folder.rstrip("/")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((s, n, c) for b in batches for s, n, c in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
        for shard, own in groupby(found, key=itemgetter(0)):
            path = f"{folder}/{prefix}_{shard:03d}.tar"
            store, where = _open(path)
            store.create_dir(where.rpartition("/")[0], recursive=True)
            count = size = 0
            with store.open_output_stream(f"{where}.part", compression=None) as stream, tarfile.open(fileobj=stream, mode="w|") as tar:
                for _, name, content in own:
                    info = tarfile.TarInfo(name)
                    info.size = len(content or b"")
                    tar.addfile(info, io.BytesIO(content or b""))
                    count, size = count + 1, size + info.size
            store.move(f"{where}.part", where)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "members": pa.array([count], pa.int64()), "bytes": pa.array([size], pa.int64())})

    dealt = members.select(F.col("shard").cast("int"), "name", "content").repartition("shard").sortWithinPartitions("shard", "name")
    shared_folder(spark)
    return checkpointed(dealt.mapInArrow(rows, "shard int, path string, members long, bytes long"))

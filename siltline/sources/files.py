"""Rows as files: each task writes its own into the store that driver and executors share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.shared import checkpointed
from siltline.sources.tars import _open


def write_files(files: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """Writes content as the file <folder>/<path> of each row; returns path (relative) and bytes.

    A file gets its name when it is whole, and one of that name is replaced, so a task that runs again does
    no harm. Of several rows with one path one stays. A null content is an empty file; a null path is no file.
    """
    folder = folder.rstrip("/")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            names, sizes = [], []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, where = _open(f"{folder}/{name}")
                parent = where.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(f"{where}.part", compression=None) as stream:
                    stream.write(data or b"")
                store.move(f"{where}.part", where)
                names.append(name)
                sizes.append(len(data or b""))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    own = files.where(F.col(path).isNotNull()).groupBy(F.col(path).alias("path")).agg(F.first(content).cast("binary").alias("content"))
    return checkpointed(own.mapInArrow(rows, "path string, bytes long"))

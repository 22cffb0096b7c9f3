"""Files that the driver and all executors see."""

from __future__ import annotations

import gzip
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: What a file's name says about how it is packed.
PACKED = {"gz": "gzip", "bz2": "bz2", "zst": "zstd", "lz4": "lz4"}


def folder(spark: SparkSession, name: str) -> str:
    """A new place under spark.checkpoint.dir; a temporary folder only where that is unset and all work is done on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that the executors share")
        base = tempfile.mkdtemp(prefix="runloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def unpacked(path: str, content: pa.Buffer) -> bytes:
    """A file's content, unpacked as its name says (.gz, .bz2, .zst, .lz4); members behind each other are one file."""
    with pa.input_stream(content, compression=PACKED.get(path.rpartition(".")[2])) as stream:
        return stream.read()


def write_files(files: DataFrame, path: str) -> int:
    """Write rows (file, content) as binary files below a folder, each by the task that has it; returns their number."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path.removeprefix("file:"))
        for f in frames:
            for name, content in zip(f["file"], f["content"], strict=True):
                place = f"{root}/{name}"
                store.create_dir(place.rpartition("/")[0], recursive=True)
                with store.open_output_stream(place) as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(f)]})

    return files.select("file", "content").mapInPandas(run, "n long").groupBy().sum("n").first()[0] or 0


def gzipped(parts: DataFrame, text: str) -> DataFrame:
    """Rows with a column of text as gzip members, which behind each other are one gzip file: text that many files hold is compressed once."""
    at, schema = parts.columns.index(text), T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in parts.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [None if x is None else gzip.compress(x.encode(), mtime=0) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, text, pa.array(members, pa.binary()))

    return parts.mapInArrow(run, schema)


def write_parts(parts: DataFrame, path: str, compression: str | None = "detect") -> int:
    """Write rows (file, content) below a folder, the rows of a file behind each other as they come: all of them in one task, one after the other.  Returns the number of files.

    A file is streamed, so a task holds one batch of rows, however long the file is.  A name that says so is compressed, unless compression is None: then content is as it is to be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path.removeprefix("file:"))
        name, out, n = None, None, 0
        try:
            for batch in batches:
                for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                    if file.as_py() != name:
                        if out is not None:
                            out.close()
                        name, n = file.as_py(), n + 1
                        store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=compression)
                    out.write(content.as_buffer())
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return parts.select("file", "content").mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0

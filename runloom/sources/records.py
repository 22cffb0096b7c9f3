"""Files of fixed-length records as data sources, read in ranges of bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of a task, and of an Arrow batch.
TASK_BYTES = 32 << 20
BATCH_BYTES = 1 << 20


class Range(NamedTuple):
    """Bytes start to stop of a file."""

    path: str
    start: int
    stop: int
    key: tuple


@dataclass
class Ranges(InputPartition):
    ranges: list[Range]


def _store(path: str):
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _files(store, root: str) -> list:
    from pyarrow import fs

    return store.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True))


def _dealt(ranges: list[Range]) -> list[Ranges]:
    """Ranges in tasks of about TASK_BYTES."""
    out, size = [], TASK_BYTES
    for r in ranges:
        if size + r.stop - r.start > TASK_BYTES:
            out.append([])
            size = 0
        out[-1].append(r)
        size += r.stop - r.start
    return [Ranges(x) for x in out]


class BaseCalls(DataSource):
    """Options lanes, tiles, cycles: comma-separated numbers; only their folders are listed and only their files opened."""

    @classmethod
    def name(cls) -> str:
        return "runloom_base_calls"

    def schema(self) -> str:
        return "lane int, tile int, cycle int, cluster int, base string, qual int"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BaseCallReader(self.options)


class _BaseCallReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = {k: {int(x) for x in options[k].split(",")} if k in options else None for k in ("lanes", "tiles", "cycles")}

    def _in(self, kind: str, n: int) -> bool:
        return self.wanted[kind] is None or n in self.wanted[kind]

    def _listed(self, store, root: str) -> Iterator[tuple[int, int, int, str, int]]:
        for lane in _files(store, root):
            m = re.match(r"L00(\d)$", lane.base_name)
            if not (m and self._in("lanes", int(m[1]))):
                continue
            for cycle in _files(store, lane.path):
                c = re.match(r"C(\d+)\.1$", cycle.base_name)
                if not (c and self._in("cycles", int(c[1]))):
                    continue
                for file in _files(store, cycle.path):
                    t = re.match(rf"s_{m[1]}_(\d+)\.bcl$", file.base_name)
                    if t and self._in("tiles", int(t[1])):
                        yield int(m[1]), int(t[1]), int(c[1]), file.path, file.size

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        ranges, sizes = [], {}
        for lane, tile, cycle, path, size in sorted(self._listed(store, root)):
            if sizes.setdefault((lane, tile), size) != size:
                raise ValueError(f"the number of clusters in {path} is not that of the other cycles")
            for a in range(4, max(size, 5), TASK_BYTES):
                ranges.append(Range(path, a, min(size, a + TASK_BYTES), (lane, tile, cycle, size)))
        return _dealt(ranges) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        letters = pa.array(list("ACGT"))
        for r in partition.ranges:
            lane, tile, cycle, size = r.key
            with store.open_input_file(r.path) as f:
                if int.from_bytes(f.read_at(4, 0), "little") != size - 4:
                    raise ValueError(f"{r.path} does not hold as many clusters as it says")
                for a in range(r.start, r.stop, BATCH_BYTES):
                    c = np.frombuffer(f.read_at(min(BATCH_BYTES, r.stop - a), a), np.uint8)
                    same = lambda x, n=len(c): pa.array(np.full(n, x, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [same(lane), same(tile), same(cycle), pa.array(np.arange(a - 4, a - 4 + len(c), dtype=np.int32)), letters.take(pa.array(c % 4)), pa.array((c // 4 % 64).astype(np.int32))],
                        names=["lane", "tile", "cycle", "cluster", "base", "qual"],
                    )


class Metrics(DataSource):
    """Options version and kinds (numpy types of the fields, in the schema's order)."""

    @classmethod
    def name(cls) -> str:
        return "runloom_metrics"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _MetricReader(self.options, schema)


class _MetricReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.version, self.kinds, self.schema = options["path"], int(options["version"]), options["kinds"].split(","), schema

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        info = store.get_file_info(root)
        files = [info] if info.is_file else sorted((x for x in _files(store, root) if x.is_file and not x.base_name.startswith((".", "_"))), key=lambda x: x.path)
        ranges = []
        for x in files:
            with store.open_input_file(x.path) as f:
                version, length = f.read_at(2, 0)
            if version != self.version:
                raise ValueError(f"metrics of version {version}, not {self.version}: {x.path}")
            step = max(1, TASK_BYTES // length) * length
            stop = 2 + (x.size - 2) // length * length
            ranges += [Range(x.path, a, min(stop, a + step), (length,)) for a in range(2, stop, step)]
        return _dealt(ranges) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, _ = _store(self.path)
        target = to_arrow_schema(self.schema)
        offsets = np.cumsum([0, *(np.dtype(t).itemsize for t in self.kinds)])[:-1].tolist()
        for r in partition.ranges:
            (length,) = r.key
            kind = np.dtype({"names": self.schema.names, "formats": self.kinds, "offsets": offsets, "itemsize": length})
            step = max(1, BATCH_BYTES // length) * length
            with store.open_input_file(r.path) as f:
                for a in range(r.start, r.stop, step):
                    rows = np.frombuffer(f.read_at(min(step, r.stop - a), a), kind)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[n])).cast(target.field(n).type) for n in self.schema.names], schema=target)

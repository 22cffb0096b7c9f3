"""Small reference tables, request documents and tally artefacts."""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import runs
from . import shared

INDEX = "array<struct<name:string,p7:string,p5:string>>"
REQUEST = (
    "runid string, expname string, email string, sequencer string, protocol string, cyclesread1 string, cyclesread2 string, cyclesindx1 string, cyclesindx2 string, "
    "LaneCount string, SurfaceCount string, SwathCount string, TileCount string, lanes array<int>, lanesdedicated array<int>, freeibis boolean, bustard boolean, spikedin boolean, mergeoverlap boolean, "
    "filterseqexp boolean, filterentropy boolean, filterfrequency boolean, usebwa boolean, ctrlindex string, adapter1 string, adapter2 string, chimeras string, key1 string, key2 string, "
    f"seqNormExpcutoff string, entropycutoff string, frequencycutoff string, genomebwa string, parambwa string, indicesseq {INDEX}, indicesraw {INDEX}"
)


def read_index_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated index sheet with # comments: index1, index2, name."""
    return spark.read.schema("index1 string, index2 string, name string").option("sep", "\t").option("comment", "#").csv(path)


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows with their number from 1 in the order of some columns (nulls last), in many tasks: sorted by ranges, and numbered behind the counts of the ranges before.

    The sorted rows are kept under the checkpoint folder meanwhile, so that both passes see the same ranges.
    """
    by, path = [F.asc_nulls_last(c) for c in order], shared.folder(rows.sparkSession, "sorted")
    rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}).write.parquet(path)
    kept = rows.sparkSession.read.parquet(path)
    counts = kept.groupBy("__range").agg(F.max("__at").alias("last"))
    # One row a range.
    before = counts.select("__range", F.coalesce(F.sum(F.col("last") + 1).over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return kept.join(F.broadcast(before), "__range").withColumn(name, (F.col("__before") + F.col("__at") + 1).cast("long")).drop("__range", "__at", "__before")


def read_mask(spark: SparkSession, path: str) -> DataFrame:
    """Masked positions: the second column."""
    return spark.read.schema("ref string, pos int").option("sep", "\t").option("comment", "#").csv(path).select("pos").where("pos IS NOT NULL").distinct()


def read_tally(spark: SparkSession, path: str) -> DataFrame:
    """A group tally: of lines of more than six fields the group, its status and mapped reads."""
    f = lambda i: F.get("f", F.lit(i))
    return spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") > 6).select(f(0).alias("rg"), f(1).alias("status"), f(5).try_cast("long").alias("n_mapped")).where("n_mapped IS NOT NULL")


def read_request(spark: SparkSession, path: str) -> DataFrame:
    """Run request documents."""
    return spark.read.schema(REQUEST).option("multiLine", "true").json(path)


#: Keys that a request gives for each processing, the processing's number behind them; and how their values are read.
PROCESSING = {
    "adapter1": "string", "adapter2": "string", "chimeras": "string", "key1": "string", "key2": "string", "mergeoverlap": "boolean", "filterseqexp": "boolean", "filterentropy": "boolean", "filterfrequency": "boolean",
    "seqNormExpcutoff": "double", "entropycutoff": "double", "frequencycutoff": "double", "rgnofail": "boolean", "usebwa": "boolean", "genomebwa": "string", "parambwa": "string",
}


def _processings(docs: DataFrame) -> DataFrame:
    """Documents (doc: a map of texts, and further columns) as a row for each of their processings: runid, processing, PROCESSING's keys and `rest` beside them."""
    keys = F.map_keys("doc")
    number = lambda name: F.transform(F.filter(keys, lambda k: k.rlike(f"^{name}[0-9]+$")), lambda k: F.substr(k, F.lit(len(name) + 1)).cast("int"))
    numbers = F.array_sort(F.array_distinct(F.concat(*map(number, PROCESSING))))
    each = docs.select("*", F.explode_outer(numbers).alias("processing"))
    said = lambda name: F.coalesce(F.try_element_at("doc", F.concat(F.lit(name), F.col("processing").cast("string"))), F.try_element_at("doc", F.lit(name)))
    value = lambda name, kind: F.regexp_replace(said(name), "^'(.*)'$", "$1").try_cast(kind).alias(name)
    ours = "^(" + "|".join(PROCESSING) + ")[0-9]*$"
    rest = F.map_filter("doc", lambda k, v: ~k.rlike(ours) & ~k.isin("runid", "indicesraw"))
    return each.select(*docs.columns, F.try_element_at("doc", F.lit("runid")).alias("runid"), "processing", *[value(*x) for x in PROCESSING.items()], rest.alias("rest"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Run request documents, a row for each of their processings: runid, processing, PROCESSING's keys, indicesraw, and the document's other keys in `rest`.

    A key with a number behind it (adapter11: adapter1 of processing 1) holds for that processing, one without for all that have none of
    their own.  A document without numbered keys is one row with processing null.  Quotes around a value are taken off; a value that is not of its type is null.
    """
    docs = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("doc"))
    return _processings(docs).select("runid", "processing", *PROCESSING, F.from_json(F.try_element_at("doc", F.lit("indicesraw")), INDEX).alias("indicesraw"), "rest")


#: A dictionary of more ids is joined instead of sent to the tasks.
BOOK_ROWS = 250_000
#: Entries of a list in one row; characters from which on a list is kept by the worker that read it, and bytes of all that it keeps for one query.
PART_ENTRIES, KEPT_FROM, KEPT_BYTES = 4096, 4096, 128 << 20

_json = json.JSONDecoder()
_space = re.compile(r"[ \t\r\n]*")
#: Lists that this worker has read for one query (`of`): by their first characters the whole text and its rows.
_kept: dict = {"of": None, "bytes": 0, "lists": {}}


def _entries(text: str, at: int, book: dict[str, dict[str, str]], columns: tuple[str, ...], of: str) -> tuple[pa.Array | None, int]:
    """The list that begins at a place of a document, resolved, as rows of some entries behind its header, and where it ends.

    Many requests hold the same list.  One that begins with the whole text of a list read before is that list, since the text of a list tells where it ends; it is not parsed again.
    """
    if _kept["of"] != of:
        _kept.update({"of": of, "bytes": 0, "lists": {}})
    begin = text[at : at + KEPT_FROM]
    known, rows = _kept["lists"].get(begin, (None, None))
    if known is not None and text.startswith(known, at):
        return rows, at + len(known)
    made, end = _json.raw_decode(text, at)
    if made is None:
        return None, end
    if not isinstance(made, list) or not all(e is None or isinstance(e, dict) for e in made):
        raise ValueError("indicesraw is no list of objects")
    as_text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    given = {c: [as_text((e or {}).get(c)) for e in made[1:]] for c in ("name", "p7", "p5")}
    given |= {f"{k}_seq": [book[k].get(x) for x in given[k]] for k in ("p7", "p5")}
    entries = pa.StructArray.from_arrays([pa.array(given[c], pa.string()) for c in columns], list(columns))
    rows = pa.ListArray.from_arrays(pa.array([*range(0, len(entries), PART_ENTRIES), len(entries)], pa.int32()), entries)
    size = sys.getsizeof(text[at:end]) + entries.nbytes
    if end - at >= KEPT_FROM and begin not in _kept["lists"] and _kept["bytes"] + size <= KEPT_BYTES:
        _kept["lists"][begin] = (text[at:end], rows)
        _kept["bytes"] += size
    return rows, end


def _request_parts(batches: Iterator[pa.RecordBatch], book: dict[str, dict[str, str]], columns: tuple[str, ...], of: str) -> Iterator[pa.RecordBatch]:
    """Documents (path, content) as rows (text: the document without its list, entries: a part of the list)."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            text, rows, begin, end = shared.unpacked(path, content.as_buffer()).decode(errors="replace"), None, 0, 0
            step = lambda at, sign: _space.match(text, at + 1).end() if text.startswith(sign, at) else None  # noqa: B023, E731
            try:
                more = at = step(_space.match(text).end(), "{")
                while more is not None and text.startswith('"', at):
                    key, at = json.decoder.scanstring(text, at + 1)
                    at = step(_space.match(text, at).end(), ":")
                    if key == "indicesraw":
                        begin = at
                        rows, at = _entries(text, at, book, columns, of)
                        end = at
                    else:
                        _, at = _json.raw_decode(text, at)
                    at = _space.match(text, at).end()
                    more = step(at, ",")
                    at = at if more is None else more
                if at is None or not text.startswith("}", at):
                    raise ValueError("no object")
            except (TypeError, ValueError) as e:
                raise ValueError(f"{path} is no request document: {e}") from e
            if rows is not None and len(rows):
                texts = pa.array([f"{text[:begin]}null{text[end:]}"] * len(rows), pa.string())
                yield pa.RecordBatch.from_arrays([texts, rows], names=["text", "entries"])


def read_request_rows(spark: SparkSession, path: str, dictionary: DataFrame, columns: tuple[str, ...] = ("name", "p7", "p5", "p7_seq", "p5_seq")) -> DataFrame:
    """Request documents as `runs.request_rows` of `read_requests` gives them, with some columns of the indices; a file that is no JSON document raises.

    Lists are resolved where they are read, and one that many documents hold once in a worker; a dictionary of over BOOK_ROWS ids is joined instead.
    """
    ids = dictionary.where("kind IN ('p7', 'p5') AND id IS NOT NULL").groupBy("kind", "id").agg(F.min("seq").alias("seq")).limit(BOOK_ROWS + 1).collect()
    rest = ["runid", "processing", *PROCESSING, "rest"]
    if len(ids) > BOOK_ROWS:
        return runs.request_rows(read_requests(spark, path), dictionary).select(*rest, *columns)
    book = spark.sparkContext.broadcast({k: {r["id"]: r["seq"] for r in ids if r["kind"] == k} for k in ("p7", "p5")})
    of = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _request_parts(batches, book.value, columns, of)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parts = files.mapInArrow(run, f"text string, entries array<struct<{','.join(f'{c}:string' for c in columns)}>>")
    docs = parts.select(F.from_json("text", "map<string,string>").alias("doc"), "entries")
    return _processings(docs).select(*rest, F.inline("entries"))


def write_status(result: DataFrame, path: str) -> None:
    """K4: OK/ERROR rows as JSON."""
    result.write.json(path)

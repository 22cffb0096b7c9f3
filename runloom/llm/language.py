"""Operator 4: language identification by compression with per-language raw-content dictionaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bytes of a language's dictionary, and how many times as many are drawn from the labelled texts: the bound of the sample.
DICTIONARY_BYTES = 64 << 10
DRAWN = 1.5
#: Characters of a block that is drawn.
DRAWN_CHARS = 1024
#: Bytes that are compressed at a time; a text's size is the sum over all its blocks.
BLOCK_BYTES = 2048
LEVEL = 5
MIN_MATCH = 3
#: Texts whose best size is less than this share below the next one are rejected.
LEAST_MARGIN = 0.002
UNKNOWN = "und"

#: What is neither a letter nor a mark that \w takes; a stretch of it becomes one space before compression.
NOT_LETTERS = re.compile(r"[\W\d_]+")

_compressors: dict[tuple, list] = {}


def plain(text: str) -> bytes:
    """Lower-cased letters only, other stretches as one space: case, digits and marks tell no language."""
    return NOT_LETTERS.sub(" ", text).lower().encode()


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary for every language of the labelled rows.

    Every labelled text is cut, whole, into blocks of DRAWN_CHARS characters.  Of a language's blocks a share is
    drawn, by a hash of text and place, so that about DRAWN * `size` characters come together, however large
    the table; equal texts count once.  The drawn blocks, in the order of their hashes, make the dictionary
    of `size` bytes.  One dictionary is kept for each label, and only labels, sums and drawn blocks reach the driver.
    Rows without text or label teach nothing; without any other rows nothing is learned.
    """
    good = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.octet_length(text_col) > 0)).select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    sized = common.table(good.groupBy("lang", "h").agg(F.max(F.length("text")).alias("n")))
    totals = {r["lang"]: r["n"] for r in sized.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    limit = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1 << 30, int((1 << 30) * DRAWN * size / n) + 1))])
    places = sized.select("lang", "h", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / DRAWN_CHARS).cast("int"))).alias("k"))
    drawn = places.withColumn("draw", F.pmod(F.xxhash64("h", "k"), F.lit(1 << 30))).where(F.col("draw") < F.element_at(limit, F.col("lang")))
    blocks = good.join(F.broadcast(drawn), ["lang", "h"]).select("lang", "h", "k", "draw", F.substring("text", F.col("k") * DRAWN_CHARS + 1, F.lit(DRAWN_CHARS)).alias("text"))
    parts: dict[str, list] = {k: [] for k in totals}
    for r in blocks.dropDuplicates(["lang", "h", "k"]).collect():
        parts[r["lang"]].append((r["draw"], r["text"]))
    return {k: b" ".join(plain(x) for _, x in sorted(v))[:size] for k, v in parts.items()}


def compressor(content: bytes):
    """A zstandard compressor with a raw-content dictionary."""
    import zstandard

    parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_checksum=0, write_content_size=0, write_dict_id=0)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def _sizes(texts: list[bytes], model: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Compressed bytes of each text under each language, over whole texts."""
    if model not in _compressors:
        _compressors.clear()
        _compressors[model] = [compressor(content) for _, content in model]
    out = np.zeros((len(texts), len(model)), np.int64)
    for i, text in enumerate(texts):
        blocks = [text[a : a + BLOCK_BYTES] for a in range(0, len(text), BLOCK_BYTES)]
        for k, language in enumerate(_compressors[model]):
            out[i, k] = sum(len(language.compress(b"%b %b" % (x, x))) for x in blocks)
    return out


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """The language whose dictionary compresses the whole text best.

    Whole texts are lower-cased, reduced to letters and compressed in blocks, each against a fresh dictionary, so that a long text does
    not become its own dictionary.  Blocks of any length are measured alike: each stands twice, since zstandard stores
    tiny inputs as they are, and the second time costs next to nothing.  margin: share by which the best size is below the next one.
    Adds lang_pred (`und` if text is null or has no letter, or nothing was learned), score
    (0 to 1: the margin scaled so that 1 is 20 % or more; 0 for `und`) and rejected (`und`, or a margin under
    `least_margin`).  Equal sizes: the alphabetically first language.  If nothing was learned every row is `und` and
    rejected.  All input columns stay, but for such of the names added.  Rows are judged each for itself, repeated
    ones too; a text of any length is measured whole, in one task.
    """
    rows = docs.drop("lang_pred", "score", "rejected")
    model = tuple(sorted(dictionaries.items()))
    names = [k for k, _ in model]
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])
    place = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.parts(batches, place):
            raw = batch.column(place).to_pylist()
            ok = np.array([x is not None and bool(names) and any(map(str.isalpha, x)) for x in raw], dtype=bool)
            sizes = _sizes([plain(x) if good else b"" for x, good in zip(raw, ok.tolist(), strict=True)], model)
            best = sizes.argmin(1) if names else np.zeros(len(raw), np.int64)
            if len(names) > 1:
                two = np.partition(sizes, 1, axis=1)
                margin = np.where(ok, 1 - two[:, 0] / np.maximum(two[:, 1], 1), 0.0)
            else:
                margin = ok.astype(float)
            pred = [names[b] if good else UNKNOWN for b, good in zip(best.tolist(), ok.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred), pa.array(np.minimum(1.0, margin * 5)), pa.array(~ok | (margin < least_margin))], names=schema.names)

    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))

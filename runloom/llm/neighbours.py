"""Operator 9: approximate nearest neighbours by additive quantisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

#: Rows from which codebooks are trained at most, codebooks, words of each, kept beams, training rounds.
SAMPLE_ROWS = 16_384
BOOKS = 8
WORDS = 256
BEAMS = 4
ROUNDS = 8
#: Lengths of vectors, the most frequent ones, that get codebooks; rows of others are all measured exactly.
BOOKED_LENGTHS = 8
#: Rows of a block of candidates and of queries; candidates reranked exactly in each block: a share, at least so many.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 16_384
RERANK_SHARE = 0.08
RERANK_LEAST = 128


def train(rows: DataFrame, id_col: str, vector_col: str, n_rows: int, scale: float, seed: int = 7) -> np.ndarray:
    """Codebooks (books, words, dimensions) of vectors divided by scale: k-means on the residuals of the books before, on a bounded sample by hash of the id."""
    share = min(1.0, SAMPLE_ROWS / max(1, n_rows))
    drawn = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(vector_col)
    x = vectors.matrix(drawn.limit(2 * SAMPLE_ROWS).toArrow()[vector_col], scale).astype(np.float32)
    random = np.random.default_rng(seed)
    words = int(min(WORDS, max(1, len(x) // 4)))
    books = np.zeros((BOOKS, words, x.shape[1]), np.float32)
    for m in range(BOOKS):
        book = x[random.choice(len(x), words, replace=False)].copy()
        for _ in range(ROUNDS):
            near = (np.square(book).sum(1) - 2 * x @ book.T).argmin(1)
            order = np.argsort(near, kind="stable")
            found, first = np.unique(near[order], return_index=True)
            book[found] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
        books[m] = book
        x = x - book[(np.square(book).sum(1) - 2 * x @ book.T).argmin(1)]
    return books


def encode(x: np.ndarray, books: np.ndarray, beams: int = BEAMS) -> np.ndarray:
    """Codes (rows, books) by beam search: the best `beams` partial sums are kept from book to book."""
    n, words = len(x), books.shape[1]
    rest = x.astype(np.float32)[:, None, :]
    codes = np.zeros((n, 1, 0), np.uint8)
    for book in books:
        error = np.square(rest).sum(2)[:, :, None] - 2 * rest @ book.T + np.square(book).sum(1)
        flat = error.reshape(n, -1)
        keep = min(beams, flat.shape[1])
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
        parent, word = best // words, best % words
        rows = np.arange(n)[:, None]
        rest = rest[rows, parent] - book[word]
        codes = np.concatenate([codes[rows, parent], word[:, :, None].astype(np.uint8)], axis=2)
    return codes[np.arange(n), np.square(rest).sum(2).argmin(1)]


def index(rows: DataFrame, books: dict[int, tuple[float, np.ndarray]], id_col: str, vector_col: str) -> DataFrame:
    """Every row (ids, vector) with its codes and the squared norm of what they stand for; null where no codebooks are for its length."""
    schema = f"{id_col} array<long>, {vector_col} array<{rows.schema[vector_col].dataType.elementType.simpleString()}>, codes binary, norm double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                of_length = np.flatnonzero(lengths == dim)
                for a in range(0, len(of_length), 2048):
                    part = batch.take(pa.array(of_length[a : a + 2048]))
                    if dim in books:
                        scale, book = books[dim]
                        codes = encode(vectors.matrix(part.column(1), scale), book)
                        sums = book[np.arange(len(book)), codes].sum(1, dtype=np.float64)
                        made = [pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(np.square(sums).sum(1))]
                    else:
                        made = [pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.float64())]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=[id_col, vector_col, "codes", "norm"])

    return rows.select(id_col, vector_col).mapInArrow(run, schema)


def merged(good: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(ids, vector): each distinct vector once, with the k + 1 smallest ids that have it.

    A query's own id takes one of them at most, so no other copy can be among its k nearest.  The
    limit is applied before the shuffle too: a vector with any number of copies is no hot key.
    """
    order = Window.partitionBy(vector_col).orderBy(id_col)
    few = good.select(F.col(id_col).cast("long").alias(id_col), vector_col).distinct().withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= k + 1)
    listed = few.withColumn("__copy", F.row_number().over(order)).withColumn("__ids", F.collect_list(id_col).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return listed.where("__copy = 1").select(F.col("__ids").alias(id_col), vector_col)


def search(docs: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> DataFrame:
    """The k nearest rows of each query row by Euclidean distance.

    Equal vectors are merged first, under their k + 1 smallest ids.  The distinct ones are encoded by beam
    search over residual codebooks of full dimension and dealt into blocks; the queries go to every block,
    in blocks of their own. In a block a query's look-up tables score all rows (stored norm less twice the inner
    product), the best RERANK_SHARE and all that tie with the last of them are measured exactly, in double
    precision, and the k nearest ids leave the block; the best k over all blocks are the result.

    Returns query_id, rank, vec_id, score.  Null, zero and non-finite vectors, and rows without id, take no part;
    vectors are near only to those of their length, and each length is searched for itself (one row for each length
    reaches the driver).  Codes are of vectors divided by the largest component of their length's, so that none is too
    large for single precision.  Ties go to the smaller id; rows with the query's id are its own.  Equal rows count
    once; an id with several vectors asks with the smallest, and each of them is a candidate.  Fewer rows come back where
    there are fewer candidates.  Other columns are not returned.
    """
    spark = docs.sparkSession
    good = docs.where(F.col(id_col).isNotNull() & vectors.usable(vector_col)).select(id_col, vector_col, F.coalesce(is_query, F.lit(False)).alias("__query"))
    distinct = common.table(merged(good, id_col, vector_col, k))
    largest = F.max(F.greatest(F.array_max(vector_col), -F.array_min(vector_col)).cast("double")).alias("scale")
    sizes = distinct.groupBy(F.size(vector_col).alias("size")).agg(F.count("*").alias("n"), largest).orderBy(F.desc("n"), "size").collect()
    books = {r["size"]: (r["scale"], train(distinct.where(F.size(vector_col) == r["size"]), id_col, vector_col, r["n"], r["scale"])) for r in sizes[:BOOKED_LENGTHS]}
    # Blocks of each length; small tables are dealt out as well.
    parts = F.create_map(F.lit(-1), F.lit(1), *[F.lit(x) for r in sizes for x in (r["size"], max(-(-r["n"] // BLOCK_ROWS), min(common.partitions(spark), -(-r["n"] // 1024))))])
    n_parts = F.element_at(parts, F.size(vector_col))
    n_queries = good.where("__query").count()
    blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    length = F.size(vector_col).alias("length")
    rows = index(distinct, books, id_col, vector_col).withColumns({"length": F.size(vector_col), "part": F.pmod(F.xxhash64(id_col), n_parts)}).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asking = good.where("__query").groupBy(F.col(id_col).cast("long").alias("query_id")).agg(F.min(vector_col).alias(vector_col))
    asked = asking.select("query_id", F.col(vector_col).alias("query"), length, F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), n_parts.cast("long") - 1)).alias("part"))

    def score(key, t, asked_here):
        found: list[list] = [[], [], []]
        if t.num_rows and asked_here.num_rows:
            x, lists = vectors.matrix(t[vector_col]), t[id_col].combine_chunks()
            ids, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            limits = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            owner = np.repeat(np.arange(len(x)), sizes)
            order = np.argsort(ids, kind="stable")
            scale, book = books.get(x.shape[1], (1.0, None))
            shortlist = max(RERANK_LEAST, int(np.ceil(RERANK_SHARE * len(x)))) if book is not None else len(x)
            if shortlist < len(x):
                codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint8).reshape(len(x), -1).T.astype(np.int64)
                norm = t["norm"].to_numpy()
            for a in range(0, asked_here.num_rows, 1024):
                some = asked_here.slice(a, 1024)
                for q, vector in zip(some["query_id"].to_pylist(), vectors.matrix(some["query"]), strict=True):
                    # Vectors that only the query's own id has.
                    held = owner[order[np.searchsorted(ids, q, "left", order) : np.searchsorted(ids, q, "right", order)]]
                    own, times = np.unique(held, return_counts=True)
                    alone = own[times == sizes[own]]
                    if shortlist < len(x):
                        tables = book @ (vector / scale).astype(np.float32)
                        rough = norm - 2 * sum(table[code] for table, code in zip(tables, codes, strict=True))
                        rough[alone] = np.inf
                        at = np.flatnonzero((rough <= np.partition(rough, shortlist - 1)[shortlist - 1]) & (rough < np.inf))
                    else:
                        at = np.delete(np.arange(len(x)), alone)
                    exact = np.sqrt(np.square(x[at] - vector).sum(1))
                    if len(at) > k:
                        near = exact <= np.partition(exact, k - 1)[k - 1]
                        at, exact = at[near], exact[near]
                    listed = np.concatenate([ids[limits[i] : limits[i + 1]] for i in at.tolist()]) if len(at) else ids[:0]
                    exact = np.repeat(exact, sizes[at])
                    exact, listed = exact[listed != q], listed[listed != q]
                    best = np.lexsort((listed, exact))[:k]
                    found[0] += [q] * len(best)
                    found[1].append(listed[best])
                    found[2].append(exact[best])
        join = lambda v, kind: pa.array(np.concatenate(v) if v else [], kind)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": join(found[1], pa.int64()), "score": join(found[2], pa.float64())})

    near = rows.groupBy("length", "part", "block").cogroup(asked.groupBy("length", "part", "block")).applyInArrow(score, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

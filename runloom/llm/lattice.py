"""Operator 10: near-duplicate vectors by E8 lattice hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

#: Tables; E8 blocks whose points together are a cell; neighbouring cells probed besides the own one.
TABLES = 6
BLOCKS = 2
PROBES = 4
#: Length of a unit vector's projection, in units in which neighbouring lattice points are the root of 2 apart, times sqrt(dimensions / 8).
SCALE = 1.1
#: Members above which a cell's comparisons are dealt out in pairs of blocks.
BLOCK = 4096
MOST_BROADCAST = 50_000
SEED = 11


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1, 1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in product((-1, 1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(whole + half)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(y[odd] - near[odd]).argmax(1)
    step = np.where(y[odd, worst] >= near[odd, worst], 1.0, -1.0)
    near[odd, worst] += step
    return near


def nearest(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8, the integer points of even sum and those shifted by one half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    take = np.square(y - a).sum(1) <= np.square(y - b).sum(1)
    return np.where(take[:, None], a, b)


def _hash(points: np.ndarray) -> np.ndarray:
    """A hash of lattice points, given as rows."""
    h = np.zeros(len(points), np.uint64)
    for column in (2 * points).astype(np.int64).T:
        h = common.mix(h ^ (column.astype(np.uint64) + np.uint64(common.SEEDS[0])))
    return h


def _largest(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values) of the n largest of every row, largest first; x is overwritten."""
    rows = np.arange(len(x))
    best, value = np.empty((len(x), n), np.int64), np.empty((len(x), n))
    for k in range(n):
        best[:, k] = x.argmax(1)
        value[:, k] = x[rows, best[:, k]]
        x[rows, best[:, k]] = -np.inf
    return best, value


class Cells:
    """The cells of unit vectors of one dimension."""

    def __init__(self, dim: int, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE):
        random = np.random.default_rng(SEED)
        self.tables, self.blocks, self.probes = tables, blocks, probes
        size = scale * np.sqrt(dim / 8)
        self.maps, self.shifts = [], []
        for _ in range(tables):
            need = 8 * blocks
            full = np.linalg.qr(random.standard_normal((max(dim, need), max(dim, need))))[0][:dim, :need]
            self.maps.append(full * size)
            self.shifts.append(random.uniform(0, 1, need))
        self.roots = roots()

    def of(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) cell numbers, the own one first; the table is in the top bits."""
        out = np.zeros((len(x), self.tables, 1 + self.probes), np.int64)
        for t in range(self.tables):
            y = x @ self.maps[t] + self.shifts[t]
            own, cost, near = [], [], []
            for b in range(self.blocks):
                part = y[:, 8 * b : 8 * b + 8]
                point = nearest(part)
                best, near_by = _largest((part - point) @ self.roots.T, self.probes)
                own.append(_hash(point))
                cost.append(-near_by)
                near.append(np.stack([_hash(point + self.roots[best[:, p]]) for p in range(self.probes)], 1))
            whole = lambda parts: common.mix(sum((h * np.uint64(m)) for h, m in zip(parts, (*common.WINDOW_SEEDS, *common.SEEDS), strict=False)))
            tag = lambda h, t=t: ((h >> np.uint64(8)) | (np.uint64(t) << np.uint64(56))).view(np.int64)
            out[:, t, 0] = tag(whole(own))
            cheapest = np.argsort(np.concatenate(cost, 1), axis=1, kind="stable")[:, : self.probes]
            for p in range(self.probes):
                block, which = cheapest[:, p] // self.probes, cheapest[:, p] % self.probes
                mixed = [np.where(block == b, near[b][np.arange(len(x)), which], own[b]) for b in range(self.blocks)]
                out[:, t, 1 + p] = tag(whole(mixed))
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.square(x / np.abs(x).max(1, keepdims=True)).sum(1, keepdims=True)) / np.abs(x).max(1, keepdims=True)


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest cell in which two vectors meet: own cell of one, own or probed of the other."""
    out = np.empty(len(a), np.int64)
    none = np.iinfo(np.int64).max
    for s in range(0, len(a), 20_000):
        x, y = a[s : s + 20_000], b[s : s + 20_000]
        # A table's cells differ from those of the others, so only cells of one table are compared.
        left = np.where(x == y[:, :, :1], x, none).min((1, 2))
        out[s : s + 20_000] = np.minimum(left, np.where(y == x[:, :, :1], y, none).min((1, 2)))
    return out


def _pairs(cell: np.ndarray, own: np.ndarray, x: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one cell (sorted runs), one of them with the cell as its own, with cosine >= least."""
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.append(first, len(cell)))
    small = np.repeat(size <= 24, size)
    for lag in range(1, 24):
        if len(cell) <= lag:
            break
        at = np.flatnonzero(small[:-lag] & (cell[:-lag] == cell[lag:]) & (own[:-lag] | own[lag:]))
        for s in range(0, len(at), 50_000):
            part = at[s : s + 50_000]
            part = part[np.einsum("ij,ij->i", x[part], x[part + lag]) >= least]
            yield part, part + lag
    for s, n in zip(first[size > 24].tolist(), size[size > 24].tolist(), strict=True):
        for i in range(s, s + n, 1024):
            for j in range(i, s + n, 1024):
                a, b = slice(i, min(i + 1024, s + n)), slice(j, min(j + 1024, s + n))
                u, v = np.nonzero(((x[a] @ x[b].T) >= least) & (own[a, None] | own[None, b]))
                u, v = u + i, v + j
                for k in range(0, len(u), 200_000):
                    p, q = u[k : k + 200_000], v[k : k + 200_000]
                    yield p[p < q], q[p < q]


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs in portions of at least `most`, but for the last."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for a, b in pairs:
        if len(a):
            held.append((a, b))
            n += len(a)
        if n >= most:
            yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
            held, n = [], 0
    if held:
        yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9) -> DataFrame:
    """Links and components of the vectors with cosine >= least.

    Equal vectors are merged first.  Each distinct one is projected at random, in TABLES
    tables, to BLOCKS * 8 dimensions, decoded to E8 lattice points, and entered under
    its own cell and PROBES neighbouring cells.  Within a cell all pairs of which one owns the cell are
    verified by exact cosine in double precision; a pair is counted in the first cell in which it
    meets, so that no pairs are emitted: tasks give each vector's number of
    links and the edges of a spanning forest.  A cell with more than BLOCK members
    is cut into blocks whose pairs are dealt out.

    Returns id, n_links (other rows linked directly), component_id (smallest id reachable),
    kept (id = component_id), one row per input row.  Null, zero and non-finite vectors, and rows without id, link
    with nothing; vectors link only with those of their length.  Rows of one id are vectors of their own that share it.
    Other input columns are not returned.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).cast("long").alias(id_col), vector_col)
    good = base.where(F.col(id_col).isNotNull() & vectors.usable(vector_col))
    distinct = common.table(good.groupBy(vector_col).agg(F.min(id_col).alias("node"), F.count("*").alias("copies")))
    kind = np.dtype("<f4" if rows.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[int, Cells] = {}
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(0)])
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                for s in range(0, len(at), 2048):
                    part = batch.take(pa.array(at[s : s + 2048]))
                    cells = kinds.setdefault(dim, Cells(dim)).of(_unit(vectors.matrix(part.column(0)))) ^ dim
                    flat = cells.reshape(len(cells), -1)
                    # A cell entered twice by one vector counts once, as its own if it is.
                    order = np.argsort(flat, axis=1, kind="stable")
                    first = np.ones(flat.shape, bool)
                    sorted_cells = np.take_along_axis(flat, order, 1)
                    first[:, 1:] = sorted_cells[:, 1:] != sorted_cells[:, :-1]
                    chosen = np.zeros(flat.shape, bool)
                    np.put_along_axis(chosen, order, first, 1)
                    row, column = np.nonzero(chosen)
                    take = pa.array(row)
                    flat_bytes = vectors.matrix(part.column(0)).astype(kind).tobytes()
                    v = pa.array([flat_bytes[k : k + dim * kind.itemsize] for k in range(0, len(flat_bytes), dim * kind.itemsize)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(flat[row, column]), pa.array(column % (1 + PROBES) == 0), part.column(1).take(take), part.column(2).take(take), v.take(take)], names=["cell", "own", "node", "copies", "v"])

    entered = distinct.repartition(common.partitions(spark), "node").select(vector_col, "node", "copies").mapInArrow(enter, "cell long, own boolean, node long, copies long, v binary")

    def compare(t: pa.Table, cell: np.ndarray, i: np.ndarray, j: np.ndarray, cells: Cells) -> Iterator[pa.RecordBatch]:
        """Numbers of links and edges among the rows of whole runs, of vectors of one length."""
        run = np.cumsum(np.concatenate([[0], (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        own, copies, mine = (t[c].to_numpy() for c in ("own", "copies", "mine"))
        nodes, local = np.unique(t["node"].to_numpy(), return_inverse=True)
        x = _unit(np.frombuffer(b"".join(t["v"].to_pylist()), kind).reshape(t.num_rows, -1).astype(np.float64))
        sums, forest = np.zeros(len(nodes), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for a, b in _gathered(_pairs(run, own, x, least)):
            # In a pair of different blocks only pairs across them belong here.
            across = (i[a] == j[a]) | (mine[a] != mine[b])
            a, b = a[across], b[across]
            used, back = np.unique(np.concatenate([a, b]), return_inverse=True)
            where = cells.of(x[used]) ^ x.shape[1]
            here = _first_meeting(where[back[: len(a)]], where[back[len(a) :]]) == cell[a]
            a, b = a[here], b[here]
            np.add.at(sums, local[a], copies[b])
            np.add.at(sums, local[b], copies[a])
            forest = common.contract(np.concatenate([forest[0], local[a]]), np.concatenate([forest[1], local[b]]))
        linked = np.flatnonzero(sums)
        if len(linked):
            p, q = nodes[forest[0]], nodes[forest[1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes[linked], p])), pa.array(np.concatenate([np.full(len(linked), -1), q])), pa.array(np.concatenate([sums[linked], np.zeros(len(p), np.int64)]))], names=["a", "b", "links"])

    def verify(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
        kinds: dict[int, Cells] = {}
        kept: pa.Table | None = None
        crowded: int | None = None  # the cell whose rows are passed over
        for batch in _with_end(batches):
            t = kept if batch is None else pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            if t is None or not t.num_rows:
                continue
            cell, i, j = (t[c].to_numpy() for c in ("cell", "i", "j"))
            stay = np.ones(len(cell), bool)
            if crowded is not None:
                stay = cell != crowded
            going = np.zeros(len(cell), bool) if batch is None else (cell == cell[-1]) & (i == i[-1]) & (j == j[-1]) & stay
            if most is not None:
                cells, n = np.unique(cell[stay], return_counts=True)
                over = cells[n > most]
                if len(over):
                    stay &= ~np.isin(cell, over)
                    yield pa.RecordBatch.from_arrays([pa.array(over), pa.array(over), pa.array(np.full(len(over), -1))], names=["a", "b", "links"])
                if len(over) and cell[-1] in over:
                    crowded = int(cell[-1])
            kept = t.filter(pa.array(going & stay)).combine_chunks()
            now = np.flatnonzero(stay & ~going)
            if not len(now):
                continue
            t = t.take(pa.array(now)).combine_chunks()
            cell, i, j = cell[now], i[now], j[now]
            # A batch has vectors of several lengths; only those of one length are compared.
            lengths = pc.binary_length(t["v"]).to_numpy() // kind.itemsize
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                part = t if len(at) == t.num_rows else t.take(pa.array(at))
                yield from compare(part, cell[at], i[at], j[at], kinds.setdefault(dim, Cells(dim)))

    def compared(rows: DataFrame, most: int | None) -> DataFrame:
        """Cells' rows meet, sorted, and are compared as runs stream by; of a cell with more than `most` only its number comes out."""
        dealt = rows.repartition(common.partitions(spark), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        return common.table(dealt.mapInArrow(lambda batches: verify(batches, most), "a long, b long, links long"))

    zero = F.lit(0)
    found = compared(entered.select("cell", zero.alias("i"), zero.alias("j"), "own", "node", "copies", zero.alias("mine"), "v"), BLOCK)
    large = found.where("links < 0").select(F.col("a").alias("cell"))
    n_large = large.count()
    if n_large:
        # Crowded cells are cut into blocks, and every pair of blocks is compared for itself.
        crowd = entered.join(F.broadcast(large) if n_large <= MOST_BROADCAST else large, "cell", "left_semi")
        blocks = common.checkpoint(crowd.groupBy("cell").agg(F.ceil(F.count("*") / (BLOCK // 2)).cast("int").alias("blocks")))
        mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        marked = crowd.join(F.broadcast(blocks) if n_large <= MOST_BROADCAST else blocks, "cell").withColumn("mine", mine)
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("mine", k).alias("i"), F.greatest("mine", k).alias("j")))
        found = found.unionByName(compared(marked.withColumn("p", F.explode(pairs)).select("cell", "p.i", "p.j", "own", "node", "copies", "mine", "v"), None))
    # Rows with links above 0 are numbers of links of a, those with 0 edges.
    joined = common.components(found.where("links = 0"))
    counts = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = distinct.join(counts, "node", "left").join(joined, "node", "left").select(vector_col, F.coalesce("component", "node").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = good.join(classes, vector_col).select(id_col, "n_links", "component_id")
    alone = base.where(F.col(id_col).isNull() | ~vectors.usable(vector_col)).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def _with_end(batches):
    yield from (x for x in batches if x.num_rows)
    yield None

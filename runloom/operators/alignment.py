"""Aligned bases: CIGAR and MD walked with array functions, and the profiles over them."""

from __future__ import annotations

import functools
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sequence
from . import walk

SUBSTITUTIONS = [f"{a}>{b}" for a in sequence.BASES for b in sequence.BASES if a != b]


def cigar_operations(cigar: str = "cigar") -> Column:
    """The CIGAR as one letter per base of the read or reference: 10M2I -> MMMMMMMMMMII."""
    tokens = F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHP=X])"))
    return F.array_join(F.transform(tokens, lambda t: F.repeat(F.right(t, F.lit(1)), F.regexp_extract(t, "^([0-9]+)", 1).cast("int"))), "")


def _md_tokens(md: str) -> Column:
    return F.regexp_extract_all(md, F.lit("([0-9]+|\\^[A-Z]+|[A-Z])"))


def _number(t: Column) -> Column:
    return F.regexp_extract(t, "^([0-9]*)", 1).try_cast("int")


def md_columns(md: str = "md") -> Column:
    """One character per aligned column: = for a match, else the reference base."""
    kept = F.filter(_md_tokens(md), lambda t: ~t.startswith("^"))
    return F.array_join(F.transform(kept, lambda t: F.when(t.rlike("^[0-9]"), F.repeat(F.lit("="), _number(t))).otherwise(t)), "")


#: What the walk reads.
WALKED = ["seq", "qual", "pos", "cigar", "md"]
_MISFIT = "alignment does not fit the read"


def explode_alignment(reads: DataFrame, keep: list[str] | None = None, strict: bool = False) -> DataFrame:
    """One row per base of each mapped read: i (from 0), op, read_length, base, q, ref, ref_pos, is_match.

    op M takes its reference base from MD; inserted and clipped bases hold the position and have
    no reference base.  CIGAR and MD of all reads of an Arrow batch are tokenised and walked together; the work is linear in their lengths.
    A read whose CIGAR and MD do not fit it or each other raises with strict; else it is left out.
    """
    keep = keep if keep is not None else ["name", "reverse", "first_mate", "second_mate", "paired", "nm"]
    used = reads.where("mapped").select(*dict.fromkeys([*keep, *WALKED]))
    schema = T.StructType([*(used.schema[c] for c in keep), *T.StructType.fromDDL("i int, op string, read_length int, base string, q int, ref string, ref_pos int, is_match boolean").fields])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                b, fits = walk.walk(part)
                if strict and not fits.all():
                    raise ValueError(_MISFIT)
                rows, match = pa.array(b.row), b.op == ord("M")
                made = [pa.array(b.i, pa.int32()), walk.characters(b.op), pa.array(b.length, pa.int32()), walk.characters(b.base), pa.array(b.q, pa.int32()), walk.characters(b.ref, match), pa.array(b.ref_pos, pa.int32()), pa.array(b.ref == b.base, pa.bool_(), mask=~match)]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(rows) for c in keep), *made], names=schema.names)

    return used.mapInArrow(run, schema)


TOTALS = "op string, n long, n_match long, n_mismatch long, sum_cycle long, sum_pos long, sum_q long"


def operation_totals(reads: DataFrame) -> DataFrame:
    """P15, P16 summed: bases, matches and mismatches of each operation, and the sums of their cycles, positions and qualities, as over explode_alignment(), whose rows are not made."""
    used = reads.where("mapped").select(*WALKED, F.coalesce(F.col("reverse"), F.lit(False)).alias("reverse"))

    def run(batches):
        sums = np.zeros((256, 6), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                b, _ = walk.walk(part)
                back = part.column("reverse").to_numpy(zero_copy_only=False)[b.row]
                cycles, same = np.where(back, b.length - b.i, b.i + 1), b.ref == b.base
                for op in np.flatnonzero(np.bincount(b.op, minlength=256)):
                    of = b.op == op
                    n, match = np.count_nonzero(of), np.count_nonzero(same & of) if op == ord("M") else 0
                    sums[op] += [n, match, n - match if op == ord("M") else 0, cycles[of].sum(), b.ref_pos[of].sum(), b.q[of].sum(dtype=np.int64)]
        ops = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([walk.characters(ops.astype(np.uint8)), *(pa.array(c) for c in sums[ops].T)], names=[c.split()[0] for c in TOTALS.split(", ")])

    made = used.mapInArrow(run, TOTALS)
    return made.groupBy("op").agg(*[F.sum(c).alias(c) for c in made.columns[1:]])


COUNTERS = "cycle int, read_length int, base string, ref string, q int, few_edits boolean, paired boolean, masked boolean, n long"


def base_counters(reads: DataFrame, mask: DataFrame | None = None, max_nm: int = 2, first_read_cycles: int | None = None, by_length: bool = False) -> DataFrame:
    """P15, P16 and the counting of A2-A7 in one scan: how many aligned (M) bases have each cycle, called base, reference base and quality.

    base and ref are on the read's strand; few_edits: NM of max_nm or less (a missing NM is more); masked: J3, the position is in the mask.
    read_length is 0 unless asked for.  A task walks its batches, counts in one array and sends its sums; keys can come from several tasks, and every table of this module sums them.
    A mask of up to MOST_MASKED positions goes to the tasks; a larger one is joined to the reads by stretches of MASK_BIN positions, and
    only to the exploded bases of reads that may be longer than a stretch.
    """
    places = None if mask is None else mask.select(F.col("pos").cast("long").alias("__pos")).where("__pos IS NOT NULL").distinct()
    if places is not None and places.limit(MOST_MASKED + 1).count() > MOST_MASKED:
        # MD spells out the deleted bases, so a read spans no more positions than it has letters in both.
        long = F.coalesce(F.length("seq") + F.length("md") > MASK_BIN, F.lit(False))
        joined = _joined_counters(reads.where(long), places, max_nm, first_read_cycles, by_length)
        return _counted(_with_masked(reads.where(~long), places), None, max_nm, first_read_cycles, by_length).unionByName(joined)
    told = None if places is None else reads.sparkSession.sparkContext.broadcast(np.sort(places.toArrow()["__pos"].to_numpy()))
    return _counted(reads, told, max_nm, first_read_cycles, by_length)


#: Positions of a stretch of a large mask.
MASK_BIN = 256


def _with_masked(reads: DataFrame, places: DataFrame) -> DataFrame:
    """Reads with the masked positions (__masked) of the stretch in which they begin and of the next."""
    stretch = F.floor(F.col("__pos") / MASK_BIN)
    bins = places.select("__pos", F.explode(F.array(stretch, stretch - 1)).alias("__bin")).groupBy("__bin").agg(F.collect_list("__pos").alias("__masked"))
    return reads.where("mapped").withColumn("__bin", F.floor(F.col("pos") / MASK_BIN)).join(bins, "__bin", "left").drop("__bin")


def _counted(reads: DataFrame, told: Broadcast | None, max_nm: int, first_read_cycles: int | None, by_length: bool) -> DataFrame:
    """base_counters() with the mask in a broadcast array, or in the column __masked of the reads, if they have it."""
    own = ["__masked"] if "__masked" in reads.columns else []
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    used = reads.where("mapped").select(*WALKED, *own, flag("reverse"), flag("second_mate"), flag("paired"), F.coalesce(F.col("nm") <= max_nm, F.lit(False)).alias("few"))

    def run(batches):
        masked_at = None if told is None else told.value
        held, sums = _Held(first_read_cycles or 0, by_length, HELD_PLACES), []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                b, _ = walk.walk(part)
                m = b.op == ord("M")
                row, i, q, ref_pos = b.row[m], b.i[m], b.q[m], b.ref_pos[m]
                column = lambda c, part=part: part.column(c).to_numpy(zero_copy_only=False)
                back, length = column("reverse"), np.zeros(part.num_rows, np.int64)
                length[b.row] = b.length
                first = np.where(back, length, 1)
                if first_read_cycles is not None:
                    first = first + first_read_cycles * column("second_mate")
                place = first[row] + np.where(back, -1, 1)[row] * i
                flags = (column("few") + 2 * column("paired"))[row]
                if own:
                    flags = flags + 4 * _hidden(row, ref_pos, *_of_lists(part.column("__masked")))
                elif masked_at is not None and len(masked_at):
                    flags = flags + 4 * _hidden(row, ref_pos, *_between(masked_at, row, ref_pos))
                turned = (back.astype(np.int64) << 8)[row]
                base, ref = _STRAND[turned + b.base[m]], _STRAND[turned + b.ref[m]]
                rest = held.add(length, row, place, base, ref, q, flags)
                if len(rest):
                    low = (base[rest].astype(np.int64) << 19) | (ref[rest].astype(np.int64) << 11) | ((q[rest].astype(np.int64) + 33) << 3) | flags[rest]
                    # The place and the length have 18 bits each; longer reads count by their numbers in a table.
                    distinct, number = np.unique(place[rest] << np.int64(32) | (length[row[rest]] if by_length else 0), return_inverse=True)
                    found, n = np.unique(number.astype(np.int64) << 27 | low, return_counts=True)
                    sums.append((np.stack([distinct[found >> 27], found & ((1 << 27) - 1)], 1), n))
            if sum(len(n) for _, n in sums) > 500_000:
                sums = [_merged(sums)]
        for keys, n in [held.counts(), *([_merged(sums)] if sums else [])]:
            place, low = keys[:, 0], keys[:, 1]
            character = lambda shift, low=low: walk.characters(((low >> shift) & 255).astype(np.uint8))
            bit = lambda k, low=low: pa.array((low >> k & 1).astype(bool))
            made = [pa.array(place >> 32, pa.int32()), pa.array(place & 0xFFFFFFFF, pa.int32()), character(19), character(11), pa.array((low >> 3 & 255) - 33, pa.int32()), bit(0), bit(1), bit(2), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=[c.split()[0] for c in COUNTERS.split(", ")])

    return used.mapInArrow(run, COUNTERS)


#: A letter as it is, and behind them as it is on the other strand.
_STRAND = np.concatenate([np.arange(256, dtype=np.uint8), walk.COMPLEMENT])
_CODE = np.full(256, -1, np.int64)
_CODE[[*b"ACGTN"]] = range(5)
#: Cells of a place in _Held: called base, reference base, qualities 0 to 63, three flags.
_CELLS = 5 * 5 * 64 * 8
#: Places (of all read lengths, if these are told apart) up to which a task counts in one array; bases of further places, as of odd letters and qualities, are counted by sorting.
HELD_PLACES = 512


class _Held:
    """Counts of bases in one array of a task."""

    def __init__(self, further: int, by_length: bool, most: int) -> None:
        self.further, self.by_length, self.most = further, by_length, most
        self.cells, self.begins, self.used = np.zeros(0, np.int64), {}, 0

    def add(self, length: np.ndarray, row: np.ndarray, place: np.ndarray, base: np.ndarray, ref: np.ndarray, q: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Count bases; returns which are not counted."""
        code = _CODE[base] * 5 + _CODE[ref]
        good = (_CODE[base] >= 0) & (_CODE[ref] >= 0) & (q >= 0) & (q < 64)
        slot = place
        if self.by_length:
            lengths, number = np.unique(length, return_inverse=True)
            for n in lengths.tolist():
                size = n + self.further + 1
                if n not in self.begins and self.used + size <= self.most:
                    self.begins[n], self.used = self.used, self.used + size
            begin = np.array([self.begins.get(n, self.most) for n in lengths.tolist()], np.int64)[number]
            slot = place + begin[row]
        good &= slot < self.most
        keys = slot * _CELLS + code * 512 + q * 8 + flags
        n = np.bincount(keys if good.all() else keys[good], minlength=len(self.cells))
        n[: len(self.cells)] += self.cells
        self.cells = n
        return np.flatnonzero(~good)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys, as base_counters makes them, and their counts."""
        found = np.flatnonzero(self.cells)
        place, length = found // _CELLS, np.zeros(len(found), np.int64)
        if self.by_length:
            lengths, begins = np.array(list(self.begins), np.int64), np.array(list(self.begins.values()), np.int64)
            at = np.searchsorted(begins, place, side="right") - 1
            place, length = place - begins[at], lengths[at]
        letter = np.frombuffer(b"ACGTN", np.uint8).astype(np.int64)
        low = letter[found // 2560 % 5] << 19 | letter[found // 512 % 5] << 11 | (found // 8 % 64 + 33) << 3 | found % 8
        return np.stack([place << 32 | length, low], 1), self.cells[found]


def _of_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the values of a column of lists."""
    n = np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.repeat(np.arange(len(column)), n), pc.list_flatten(column).to_numpy(zero_copy_only=False)


def _between(masked_at: np.ndarray, row: np.ndarray, ref_pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of the masked positions between the ends of each read; row and ref_pos are those of its bases, which rise."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    last = np.append(first[1:], len(row))[: len(first)] - 1
    low, high = np.searchsorted(masked_at, ref_pos[first], "left"), np.searchsorted(masked_at, ref_pos[last], "right")
    n = np.maximum(high - low, 0)
    return np.repeat(row[first], n), masked_at[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


def _hidden(row: np.ndarray, ref_pos: np.ndarray, of: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which bases lie at one of the positions of their read, (of, place)."""
    out = np.zeros(len(row), bool)
    if not len(row):
        return out
    bottom, top = ref_pos.min(), ref_pos.max()
    near = (place >= bottom) & (place <= top)
    span = top - bottom + 1
    of_base, of_place = row * span + (ref_pos - bottom), of[near] * span + (place[near] - bottom)
    at = np.minimum(np.searchsorted(of_base, of_place), len(row) - 1)
    out[at[of_base[at] == of_place]] = True
    return out


def _merged(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in sums]), axis=0, return_inverse=True)
    return keys, np.bincount(inverse.ravel(), np.concatenate([n for _, n in sums])).astype(np.int64)


def _joined_counters(reads: DataFrame, places: DataFrame, max_nm: int, first_read_cycles: int | None, by_length: bool) -> DataFrame:
    bases = explode_alignment(reads).where("op = 'M'")
    bases = bases.join(places.withColumn("masked", F.lit(True)), F.col("ref_pos") == F.col("__pos"), "left")
    keys = [cycle(first_read_cycles).alias("cycle"), (F.col("read_length") if by_length else F.lit(0)).alias("read_length"), _read_strand("base").alias("base"), _read_strand("ref").alias("ref"), "q"]
    flags = [F.coalesce(F.col("nm") <= max_nm, F.lit(False)).alias("few_edits"), F.coalesce("paired", F.lit(False)).alias("paired"), F.coalesce("masked", F.lit(False)).alias("masked")]
    return bases.groupBy(*keys, *flags).agg(F.count("*").alias("n"))


#: The grouping sets of profiles(): which table a row belongs to, by the keys it has.
TABLES = {"cycle": "A2", "cycle, base, ref": "A3", "q": "A4", "base, q": "A5", "cycle, q": "A6"}


def profiles(counters: DataFrame) -> DataFrame:
    """A2-A6 by one aggregation with grouping sets over the counters: one row for each table, its keys (others null) and class.

    table (A2-A6), cycle, base, ref, q; matches, mismatches; few_matches and few_mismatches: of reads with few edits.
    A2 and A3 count pairs of resolved bases of all positions, A4-A6 resolved reference bases (an N read base is a mismatch) of
    positions that are not masked.  A3's matches and mismatches are those of the one pair base, ref.
    """
    resolved = lambda c: F.col(c).isin(sequence.BASES)
    same = F.col("base") == F.col("ref")
    both, one = resolved("base") & resolved("ref"), resolved("ref") & ~F.col("masked")
    pick = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    by_set = [pick(k & w & f) for k in (both, one) for f in (F.lit(True), F.col("few_edits")) for w in (same, ~same)]
    names = [f"{k}{c}" for k in ("both_", "one_") for c in ("matches", "mismatches", "few_matches", "few_mismatches")]
    columns = [F.col(c) for c in ("cycle", "base", "ref", "q")]
    sets = [[F.col(c.strip()) for c in k.split(",")] for k in TABLES]
    made = counters.groupingSets(sets, *columns).agg(F.grouping_id(*columns).alias("gid"), *[x.alias(n) for x, n in zip(by_set, names, strict=True)])
    gid = {t: sum(8 >> i for i, c in enumerate(("cycle", "base", "ref", "q")) if c not in [x.strip() for x in k.split(",")]) for k, t in TABLES.items()}
    table = F.coalesce(*[F.when(F.col("gid") == g, F.lit(t)) for t, g in gid.items()])
    pairs = F.col("table").isin("A2", "A3")
    made = made.withColumn("table", table)
    out = made.select("table", "cycle", "base", "ref", "q", *[F.when(pairs, F.col(f"both_{c}")).otherwise(F.col(f"one_{c}")).alias(c) for c in ("matches", "mismatches", "few_matches", "few_mismatches")])
    return out.where("matches + mismatches > 0")


def cycle(first_read_cycles: int | None = None) -> Column:
    """The sequencing cycle (from 1) of base i: from the other end on the reverse strand, second mates behind the first."""
    c = F.when(F.col("reverse"), F.col("read_length") - F.col("i")).otherwise(F.col("i") + 1)
    return c if first_read_cycles is None else c + F.when(F.col("second_mate"), F.lit(first_read_cycles)).otherwise(0)


#: Rows of a mask (of 4 bytes) up to which it is broadcast; a larger one is joined by shuffling the reads.
MOST_MASKED = 1_000_000


def masked(bases: DataFrame, mask: DataFrame) -> DataFrame:
    """Without the bases at masked reference positions."""
    positions = mask.select(F.col("pos").alias("__pos")).distinct()
    small = positions.limit(MOST_MASKED + 1).count() <= MOST_MASKED
    return bases.join(F.broadcast(positions) if small else positions, F.col("ref_pos") == F.col("__pos"), "left_anti")


def _read_strand(base: str) -> Column:
    return F.when(F.col("reverse"), sequence.complement(F.col(base))).otherwise(F.col(base))


def _aligned(rows: DataFrame, max_nm: int | None = None, first_read_cycles: int | None = None) -> DataFrame:
    """Aligned bases with base and ref on the read's strand, cycle, and n: how many a row stands for (counters as they are, exploded bases one each)."""
    if "is_match" not in rows.columns:
        return rows if max_nm is None else rows.where("few_edits")
    used = rows.where("op = 'M'") if max_nm is None else rows.where("op = 'M'").where(F.col("nm") <= max_nm)
    return used.withColumns({"cycle": cycle(first_read_cycles), "base": _read_strand("base"), "ref": _read_strand("ref"), "n": F.lit(1).cast("long")})


def _sum(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n")).otherwise(0))


def _same() -> Column:
    return F.col("base") == F.col("ref")


def _resolved(*columns: str) -> Column:
    return functools.reduce(and_, (F.col(c).isin(sequence.BASES) for c in columns))


def cycle_error(rows: DataFrame, n_cycles: int, first_read_cycles: int | None = None) -> DataFrame:
    """A2: matches, mismatches and error % of each cycle; only resolved bases, every cycle listed.  rows: exploded bases or base_counters()."""
    used = _aligned(rows, None, first_read_cycles).where(_resolved("ref", "base"))
    counted = used.groupBy("cycle").agg(_sum(_same()).alias("matches"), _sum(~_same()).alias("mismatches"))
    cycles = rows.sparkSession.range(1, n_cycles + 1).select(F.col("id").cast("int").alias("cycle"))
    out = cycles.join(counted, "cycle", "left").na.fill(0, ["matches", "mismatches"])
    return out.withColumn("error_pct", sequence.ratio_percent(F.col("mismatches"), F.col("matches")))


def _kinds(rows: DataFrame, *by: Column) -> DataFrame:
    """Resolved bases and the 12 kinds of substitution, on the read's strand, counted by some keys."""
    kind = F.concat("ref", F.lit(">"), "base")
    return _aligned(rows).where(_resolved("ref", "base")).groupBy(*by).agg(F.sum("n").alias("n_bases"), *[_sum(kind == k).alias(k) for k in SUBSTITUTIONS])


def _listed(wide: DataFrame, keys: list[str]) -> DataFrame:
    return wide.unpivot([*keys, "n_bases"], SUBSTITUTIONS, "type", "n").withColumn("pct", sequence.ratio_percent(F.col("n"), F.col("n_bases") - F.col("n")))


def substitutions(rows: DataFrame, by: Column | None = None, name: str = "cycle") -> DataFrame:
    """A3: the 12 kinds of substitution, on the read's strand: count and % of all resolved bases of the cycle."""
    # One aggregation: a handful of counters per cycle, then unpivoted.
    return _listed(_kinds(rows, (F.col(name) if by is None else by).alias(name)), [name])


def observed_predicted(rows: DataFrame, by: list[Column] | None = None, max_nm: int | None = None) -> DataFrame:
    """Matches and mismatches by quality, and further columns; rows for every quality up to the largest seen.

    Only the reference base must be resolved, so an N read base is a mismatch here.  Counters have one limit of NM, that of
    base_counters(); any max_nm here means it.  Their masked bases are left out.
    """
    used = _aligned(rows, max_nm).where(_resolved("ref"))
    if "masked" in used.columns:
        used = used.where("NOT masked")
    keys = by or []
    counted = used.groupBy(*keys, "q").agg(_sum(_same()).alias("matches"), _sum(~_same()).alias("mismatches"))
    if keys:
        return counted
    # There are some 200 qualities at most; taken as one row, so that the reads are walked once for both the largest and the counts.
    pair = F.struct(F.col("q"), F.struct("matches", "mismatches"))
    seen = counted.agg(F.max("q").alias("top"), F.map_from_entries(F.collect_list(F.when(F.col("q").isNotNull(), pair))).alias("seen")).where("top IS NOT NULL")
    axis = seen.select(F.explode(F.sequence(F.lit(0), F.col("top"))).alias("q"), "seen").withColumn("seen", F.try_element_at("seen", F.col("q")))
    return axis.select("q", *[F.coalesce(F.col("seen")[c], F.lit(0).cast("long")).alias(c) for c in ("matches", "mismatches")])


def by_base() -> list[Column]:
    """A5: the called base, on the read's strand."""
    return [F.col("base")]


def by_cycle() -> list[Column]:
    """A6."""
    return [F.col("cycle")]


def observed_quality() -> Column:
    """-10 log10(mismatches / (mismatches + matches + 1)); null (infinite) without mismatches."""
    return F.when(F.col("mismatches") > 0, -10 * F.log10(F.col("mismatches") / (F.col("mismatches") + F.col("matches") + 1)))


def quality_rmse(counted: DataFrame) -> DataFrame:
    """Root mean square difference of predicted and observed quality over the qualities seen."""
    return counted.withColumn("observed", observed_quality()).where("observed IS NOT NULL").agg(F.count("*").alias("n_qualities"), F.sqrt(F.avg(F.pow(F.col("q") - F.col("observed"), 2))).alias("rmse"))


#: Upper limits of the quality bins, of widths 6, 6, 6, 6, 6, 5 and 5.
BIN_LIMITS = [6, 12, 18, 24, 30, 35, 40]


def cycle_quality_bins(counted: DataFrame, least: int = 200) -> DataFrame:
    """Observed quality by cycle and quality bin, weighted by observations; cells of more than `least` only."""
    bin_no = F.lit(len(BIN_LIMITS))
    for i in reversed(range(len(BIN_LIMITS))):
        bin_no = F.when(F.col("q") < BIN_LIMITS[i], i).otherwise(bin_no)
    n = F.col("matches") + F.col("mismatches")
    cells = counted.withColumn("bin", bin_no).withColumn("n", n).where(F.col("n") > least).withColumn("observed", observed_quality()).where("observed IS NOT NULL")
    return cells.groupBy("cycle", "bin").agg(F.sum("n").alias("n"), (F.sum(F.col("observed") * F.col("n")) / F.sum("n")).alias("observed"))


def end_substitutions(rows: DataFrame, ends: int = 20) -> DataFrame:
    """C-7: substitutions by distance from either end of the read (5' on the read's strand), of bases or of counters by length.

    Bases are counted by place and read length, and only these counts are then given to both ends.
    """
    rows = _aligned(rows)
    five = F.col("cycle")
    near = (five <= ends) | (F.col("read_length") - five + 1 <= ends)
    counted = _kinds(rows.where(near).drop("is_match"), five.alias("five"), F.col("read_length"))
    sides = F.array(F.struct(F.lit("5p").alias("side"), F.col("five").alias("distance")), F.struct(F.lit("3p").alias("side"), (F.col("read_length") - F.col("five") + 1).alias("distance")))
    at = counted.select(F.inline(F.filter(sides, lambda s: s["distance"] <= ends)), "n_bases", *[F.col(f"`{k}`") for k in SUBSTITUTIONS])
    return _listed(at.groupBy("side", "distance").agg(*[F.sum(f"`{k}`").alias(k) for k in ("n_bases", *SUBSTITUTIONS)]), ["side", "distance"]).select("side", "distance", "type", "n", "n_bases", "pct")

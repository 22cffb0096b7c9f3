"""Operator 13: conversation structure repair by iterative-deepening A*."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SPACE = " \t\n\v\f\r"
#: Costs of the edits, and of leaving a truncated row in.
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
#: Initials the repaired roles may have, and the states of the pattern (s?(ua)+)?: nothing yet, after s, u, a.
INITIALS = "sua"
NEXT = (2, 2, 3, 2)
KEEP = ((1, 2, -1), (-1, 2, -1), (-1, -1, 3), (-1, 2, -1))
ROLES = {2: "user", 3: "assistant"}
#: What it costs to end in each state, and the inserts that do it.
END_COST, END_EDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
INF = 1 << 60
#: A search spans so many rows at most; longer conversations are solved piece by piece.
SEGMENT = 64
#: Conversations of more rows or bytes than these are spread over tasks.
LONG_ROWS, LONG_BYTES = 4096, 32 << 20

EDITS = "step long, edit string, turn long, role string, text string, fault string, new_role string, cost long"
_EMPTY = ("", None, "", None, "", None, 0)


class Search:
    """Cheapest edits of rows lo..hi from one state to another, or to the end of the conversation.

    A row is (forced, initial, truncated): the number of rows that have to be deleted (0: none),
    the place of the role's initial in INITIALS (3: any other), whether the text is cut short.
    """

    def __init__(self, rows: list[tuple[int, int, bool]]):
        self.rows, self.failed = rows, {}
        own = [DELETE * m if m else DELETE if cut else (REROLE if k > 2 else 0) for m, k, cut in rows]
        n = len(rows)
        self.low = low = [0] * (n + 1)
        after, between = -1, 0
        for i in range(n - 1, -1, -1):
            forced, kind, cut = rows[i]
            low[i] = own[i] + low[i + 1]
            between += own[i]
            if not forced and not cut:
                # Two rows that both stay for nothing and may not be neighbours, with only deletions between.
                if kind <= 2 and after >= 0 and KEEP[kind + 1][rows[after][1]] < 0:
                    low[i] = max(low[i], between + 1 + low[after + 1])
                after, between = (i, own[i]) if kind <= 2 else (-1, 0)

    def best(self, state: int, goal: int | None) -> tuple[int, str]:
        """(cost, edits) of the cheapest way to `goal` with no insert at the end, or, for None, to an allowed end.

        Depth first in the order D, I, K, R under a rising cost bound.  The table holds, for every (row, state)
        that failed, the least that any way on from there to the goal costs; it only grows and serves all bounds and starts.  The
        first accepted path under the least bound is the ASCII-least of the cheapest.
        """
        rows, low, end = self.rows, self.low, len(self.rows)
        at_end = END_COST if goal is None else tuple(0 if s == goal else INF for s in range(4))
        failed = self.failed.setdefault(goal, {end * 4 + s: c for s, c in enumerate(at_end)})

        def ways(i: int, s: int) -> list[tuple[int, int, str]]:
            if i == end:
                return [(INSERT, i * 4 + NEXT[s], "I")] if goal is None and s in (1, 2) else []
            forced, kind, cut = rows[i]
            out = [(DELETE * max(forced, 1), i * 4 + 4 + s, "D" * max(forced, 1)), (INSERT, i * 4 + NEXT[s], "I")]
            if not forced:
                extra = UNFINISHED if cut else 0
                if kind <= 2 and KEEP[s][kind] >= 0:
                    out.append((extra, i * 4 + 4 + KEEP[s][kind], "K"))
                out.append((REROLE + extra, i * 4 + 4 + NEXT[s], "R"))
            return out

        def least(node: int) -> int:
            known = failed.get(node)
            return low[node >> 2] if known is None else known

        while True:
            bound = least(state)
            stack = [[state, bound, ways(0, state), 0, INF]]
            path: list[str] = []
            while stack:
                frame = stack[-1]
                node, budget, options, k, over = frame
                if node >> 2 == end and at_end[node & 3] == 0:
                    return bound, "".join(path)
                if k == len(options):
                    failed[node] = max(least(node), over)
                    stack.pop()
                    if path:
                        path.pop()
                    continue
                cost, child, edit = options[k]
                need = cost + least(child)
                if need > budget:
                    frame[3], frame[4] = k + 1, min(over, need)
                else:
                    # Comes back to this option when the child has failed, with its new bound.
                    stack.append([child, budget - cost, ways(child >> 2, child & 3), 0, INF])
                    path.append(edit)


def _exits(rows: list[tuple[int, int, bool]], state: int) -> list[int]:
    """States that edits of these rows, the last edit no insert, can lead to."""
    if state:
        return [1, 2, 3] if state == 1 else [2, 3]
    return [0, 2, 3] + [1] * any(not m and k == 0 for m, k, _ in rows)


def _segments(rows: list) -> list[list]:
    return [rows[i : i + SEGMENT] for i in range(0, len(rows), SEGMENT)]


def costs(rows: list[tuple[int, int, bool]]) -> np.ndarray:
    """Least costs from each state to each other over all the rows (min-plus product of the segments')."""
    total = None
    for part in _segments(rows):
        search, m = Search(part), np.full((4, 4), INF, np.int64)
        for s in range(4):
            for e in _exits(part, s):
                m[s, e] = search.best(s, e)[0]
        total = m if total is None else np.minimum((total[:, :, None] + m[None]).min(1), INF)
    return total


def solve(rows: list[tuple[int, int, bool]], state: int = 0, after: tuple[int, ...] | None = None) -> tuple[str, int]:
    """(edits, last state): the ASCII-least of the cheapest, if going on from each state costs `after` (None: the conversation ends).

    No insert ends a segment but the last, so of two edit sequences of the same rows none begins the other, and
    the least whole is made of the least parts.
    """
    if not rows:
        return (END_EDITS[state] if after is None else ""), state
    parts = _segments(rows)
    if len(parts) == 1 and after is None:
        return Search(rows).best(state, None)[1], 3
    to_go = [np.array(END_COST if after is None else after, np.int64)]
    for part in reversed(parts[1:]):
        to_go.append(np.minimum((costs(part) + to_go[-1][None]).min(1), INF))
    edits = []
    for k, (part, left) in enumerate(zip(parts, reversed(to_go), strict=True)):
        search = Search(part)
        if k == len(parts) - 1 and after is None:
            edits.append(search.best(state, None)[1])
            break
        found = [(c + int(left[e]), text, e) for e in _exits(part, state) if left[e] < INF for c, text in [search.best(state, e)]]
        _, text, state = min(found)
        edits.append(text)
    return "".join(edits), state


def _row(forced: int, role: str, cut: bool) -> tuple[int, int, bool]:
    return forced, INITIALS.find(role[0]) if role and role[0] in INITIALS else 3, cut


def _edit_rows(turns: list[tuple], edits: str, state: int, step: int):
    """Rows of EDITS, in order: turns are (turn, role, text, fault)."""
    at = iter(turns)
    for edit in edits:
        turn, role, text, fault = (None, None, "", None) if edit == "I" else next(at)
        cost = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit] + (UNFINISHED if fault == "truncated" and edit in "KR" else 0)
        new = None
        if edit in "IR":
            state = NEXT[state]
            new = ROLES[state]
        elif edit == "K":
            state, new = KEEP[state][INITIALS.index(role[0])], role
        yield (step, edit, turn, role, text, fault, new, cost)
        step += 1


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of every row after the damage that its crc32 names; a dropped row has no copies."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def _solid(text: str) -> Column:
    return F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest edits that give each conversation the role pattern (s?(ua)+)?, one row for each edit, in order.

    turns has conv_id, turn (long), role, text and, if wanted, copies (how often the row stands there; 0: it does not,
    but its conversation is reported).  A conversation's rows are taken by turn (nulls first), then role and text
    in byte order.  Null roles and texts are one space.  Null conv_ids are one conversation.  Rows that are blank or repeat role and text of an
    earlier one are deleted (2 each); others are kept (0), given another role (1) or deleted; empty ones may be
    inserted (5); a kept text that ends without one of .!? costs 5 more.  Of the cheapest edit sequences the ASCII-least one is taken.
    Other columns are dropped.  An empty table gives no rows.

    Returns conv_id and EDITS: step, edit (D, I, K, R; empty in the single row of a conversation without rows), turn, role
    and text as they were (text empty for inserts), fault (blank, duplicate, truncated or null), new_role
    (null if deleted) and cost.  Rows of one conversation are neighbours, in order, in one partition.

    A conversation is solved in one task if it is short; those of over LONG_ROWS rows or LONG_BYTES
    bytes are cut along their order into pieces for many tasks.  Both ways give the same edits.
    """
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    size = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.greatest("copies", F.lit(1))).alias("bytes"))
    long = common.table(size.where((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv_id").alias("long_id")))
    if long.isEmpty():
        return _short(rows)
    same = rows["conv_id"].eqNullSafe(long["long_id"])
    return _short(rows.join(long, same, "left_anti")).unionByName(_long(rows.join(long, same, "left_semi")))


def _schema(rows: DataFrame) -> T.StructType:
    return T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(EDITS).fields])


def _short(rows: DataFrame) -> DataFrame:
    schema = _schema(rows)

    def solve_all(batches):
        held: list[tuple] = []
        out: list[tuple] = []
        kind, weight = None, 0

        def finished():
            seen, turns, items = set(), [], []
            for _, turn, role, text, n in held:
                solid = text.strip(SPACE)
                for _ in range(n):
                    fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
                    seen.add((role, text))
                    turns.append((turn, role, text, fault))
                    items.append(_row(fault in ("blank", "duplicate"), role, fault == "truncated"))
            conv = held[0][0]
            if turns:
                return [(conv, *x) for x in _edit_rows(turns, solve(items)[0], 0, 0)]
            return [(conv, 0, *_EMPTY)]

        def flush():
            nonlocal out, weight
            batch = _batch(out, kind)
            out, weight = [], 0
            return batch

        for part in common.parts(batches, "text"):
            kind = part.schema.field("conv_id").type
            for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")), strict=True):
                if held and held[0][0] != row[0]:
                    out += finished()
                    weight += sum(len(x[3]) + 64 for x in held)
                    held = []
                    if weight > 1 << 20:
                        yield flush()
                held.append(row)
        if held:
            out += finished()
        if out:
            yield flush()

    return rows.repartition(common.partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(solve_all, schema)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [("conv_id", kind), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("new_role", pa.string()), ("cost", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], schema=pa.schema(types))


def _long(rows: DataFrame) -> DataFrame:
    """Long conversations: equal rows are counted, the rest range-sorted, so a conversation's pieces lie in many tasks.

    Each piece gives a 4 x 4 matrix of costs; from the end backwards these give what going on from each state costs behind
    each piece; with that each piece tells which state each entry leads to; chained, these fix the entries.
    A conversation gives one matrix for each range at most.
    """
    spark, schema = rows.sparkSession, _schema(rows)
    solid = _solid("text")
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    merged = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    merged = common.table(merged.withColumns({"same": same, "rank": F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("t")), "blank": solid == "", "cut": ~F.right(solid, F.lit(1)).isin(".", "!", "?")}))
    first = merged.where("NOT blank").groupBy("conv_id", "same").agg(F.min("rank").alias("first")).withColumnsRenamed({"conv_id": "c", "same": "s"})
    told = merged.join(first, merged["conv_id"].eqNullSafe(first["c"]) & (merged["same"] == first["s"]), "left")
    told = common.table(told.select("conv_id", "turn", "role", "text", "n", "blank", "cut", (F.col("rank") == F.col("first")).alias("is_first")))
    order = ["conv_id", "turn", "role", "text"]
    ordered = told.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)
    ordered = common.table(ordered.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}))

    def items(t: pa.Table) -> list[tuple]:
        out = []
        for role, n, blank, cut, is_first in zip(*(t[c].to_pylist() for c in ("role", "n", "blank", "cut", "is_first")), strict=True):
            if blank:
                out.append(_row(n, role, False))
                continue
            if is_first:
                out.append(_row(0, role, cut))
            if n - bool(is_first):
                out.append(_row(n - bool(is_first), role, False))
        return out

    slim = ordered.select("conv_id", "part", "pos", "role", "n", "blank", "cut", "is_first")
    edge = [slim.schema["conv_id"], slim.schema["part"]]

    def measure(key, t):
        return pa.table({"conv_id": t["conv_id"][:1], "part": t["part"][:1], "m": pa.array([costs(items(t.sort_by("pos"))).ravel().tolist()], pa.list_(pa.int64()))})

    matrices = slim.groupBy("conv_id", "part").applyInArrow(measure, T.StructType([*edge, T.StructField("m", T.ArrayType(T.LongType()))]))

    def backwards(key, t):
        t = t.sort_by("part")
        left, out = np.array(END_COST, np.int64), []
        for m in reversed(t["m"].to_pylist()):
            out.append(left.tolist())
            left = np.minimum((np.array(m).reshape(4, 4) + left[None]).min(1), INF)
        return pa.table({"conv_id": t["conv_id"], "part": t["part"], "left": pa.array(out[::-1], pa.list_(pa.int64())), "last": pa.array([False] * (len(out) - 1) + [True])})

    to_go = common.table(matrices.groupBy("conv_id").applyInArrow(backwards, T.StructType([*edge, *T.StructType.fromDDL("left array<long>, last boolean").fields])))

    def exits(key, t, left):
        todo, after = items(t.sort_by("pos")), tuple(left["left"][0].as_py())
        leads = [solve(todo, s, after)[1] if min(left["left"][0].as_py()) < INF else 0 for s in range(4)]
        return pa.table({"conv_id": t["conv_id"][:1], "part": t["part"][:1], "leads": pa.array([leads], pa.list_(pa.int64()))})

    def chain(key, t):
        t = t.sort_by("part")
        state, out = 0, []
        for leads in t["leads"].to_pylist():
            out.append(state)
            state = leads[state]
        return pa.table({"conv_id": t["conv_id"], "part": t["part"], "entry": pa.array(out, pa.int64())})

    by_piece = slim.groupBy("conv_id", "part").cogroup(to_go.groupBy("conv_id", "part"))
    entries = by_piece.applyInArrow(exits, T.StructType([*edge, *T.StructType.fromDDL("leads array<long>").fields])).groupBy("conv_id").applyInArrow(chain, T.StructType([*edge, *T.StructType.fromDDL("entry long").fields]))
    plan = common.table(to_go.join(entries.withColumnsRenamed({"conv_id": "c", "part": "p"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p"))

    def decide(key, t, plan):
        """The edits at every row: those before it, then its own."""
        t = t.sort_by("pos")
        edits, _ = solve(items(t), plan["entry"][0].as_py(), None if plan["last"][0].as_py() else tuple(plan["left"][0].as_py()))
        at, state, rows = 0, plan["entry"][0].as_py(), []
        for role, n in zip(t["role"].to_pylist(), t["n"].to_pylist(), strict=True):
            begin, begun, left = at, state, n
            while left:
                left -= edits[at] != "I"
                state = NEXT[state] if edits[at] in "IR" else KEEP[state][INITIALS.index(role[0])] if edits[at] == "K" else state
                at += 1
            rows.append([edits[begin:at], begun])
        if rows:
            rows[-1][0] += edits[at:]
        return pa.table({"conv_id": t["conv_id"], "pos": t["pos"], "edits": pa.array([x for x, _ in rows], pa.string()), "begun": pa.array([s for _, s in rows], pa.int64())})

    decided = slim.groupBy("conv_id", "part").cogroup(plan.groupBy("conv_id", "part")).applyInArrow(decide, T.StructType([edge[0], *T.StructType.fromDDL("pos long, edits string, begun long").fields]))
    decided = decided.drop("conv_id").withColumnRenamed("pos", "at")
    final = ordered.join(decided, F.col("pos") == F.col("at")).select("conv_id", "pos", "turn", "role", "text", "n", "blank", "cut", "is_first", "edits", "begun")

    def write(batches):
        conv, step, out, kind = object(), 0, [], None
        for part in common.parts(batches, "text"):
            kind = part.schema.field("conv_id").type
            for c, _, turn, role, text, n, blank, cut, is_first, edits, begun in zip(*(x.to_pylist() for x in part.columns), strict=True):
                if c != conv:
                    conv, step = c, 0

                def faults(n=n, blank=blank, cut=cut, is_first=is_first, turn=turn, role=role, text=text):
                    for k in range(n):
                        yield turn, role, text, "blank" if blank else "duplicate" if k or not is_first else "truncated" if cut else None

                for x in _edit_rows(faults(), edits, begun, step):
                    out.append((c, *x))
                    step += 1
                    if len(out) >= 4096:
                        yield _batch(out, kind)
                        out = []
        if out:
            yield _batch(out, kind)

    return final.repartition(common.partitions(spark), "conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(write, schema)


def digest(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and SHA-256 of the repaired text, of the rows repair() gives.

    Reads them in their order, one after another, and holds sums, the audit and a running hash of one conversation.
    """
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([edits.schema["conv_id"], *T.StructType.fromDDL(", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string").fields])

    def fold(batches):
        out: list[tuple] = []
        now, kind = None, None

        def done():
            low, high, distinct = now["turns"]
            gaps = high - low + 1 - distinct if distinct else 0
            return (now["conv"], gaps, *(now[n] for n in names[1:]), bytes(now["audit"]).decode(), now["hash"].hexdigest())

        def made():
            return pa.RecordBatch.from_arrays([pa.array(x, kind if k == 0 else pa.int64() if k < 7 else pa.string()) for k, x in enumerate(zip(*out, strict=True))], names=schema.names)

        for part in common.parts(batches, "text"):
            kind = part.schema.field("conv_id").type
            for conv, _, edit, turn, role, text, fault, new, cost in zip(*(x.to_pylist() for x in part.columns), strict=True):
                if now is None or now["conv"] != conv:
                    if now is not None:
                        out.append(done())
                    now = dict.fromkeys(names, 0) | {"conv": conv, "turns": (0, 0, 0), "audit": bytearray(), "hash": hashlib.sha256(), "last": None, "any": False}
                if len(out) >= 4096:
                    yield made()
                    out = []
                now["audit"] += edit.encode()
                now["cost"] += cost
                if fault:
                    now[fault] += 1
                if edit and edit != "I":
                    if now["last"] is not None:
                        now["illegal"] += now["last"] + role[:1] not in ("su", "ua", "au")
                    now["last"] = role[:1]
                    if turn is not None:
                        low, high, distinct = now["turns"]
                        now["turns"] = (turn, turn, 1) if not distinct else (low, turn, distinct + (turn != high))
                if new is not None:
                    now["hash"].update((("\n" if now["any"] else "") + new + ":" + text).encode())
                    now["any"] = True
        if now is not None:
            out.append(done())
        if out:
            yield made()

    return edits.mapInArrow(fold, schema)


def brute_force(rows: list[tuple[int | None, str, str]]) -> tuple[int, str]:
    """(cost, audit) of (turn, role, text) rows in order by a table over all prefixes, for tests."""
    seen: set = set()
    best: dict[int, tuple[int, str]] = {0: (0, "")}

    def with_inserts(table):
        table = dict(table)
        for _ in range(3):
            for s, (c, a) in list(table.items()):
                new = (c + INSERT, a + "I")
                table[NEXT[s]] = min(table.get(NEXT[s], new), new)
        return table

    for _, role, text in rows:
        solid, nxt = text.strip(SPACE), {}
        forced = not solid or (role, text) in seen
        seen.add((role, text))
        extra = 0 if forced or solid[-1] in ".!?" else UNFINISHED
        for s, (c, a) in with_inserts(best).items():
            ways = [(s, c + DELETE, a + "D")]
            if not forced:
                k = INITIALS.find(role[:1]) if role else -1
                if k >= 0 and KEEP[s][k] >= 0:
                    ways.append((KEEP[s][k], c + extra, a + "K"))
                ways.append((NEXT[s], c + REROLE + extra, a + "R"))
            for t, cost, audit in ways:
                nxt[t] = min(nxt.get(t, (cost, audit)), (cost, audit))
        best = nxt
    return min(x for s, x in with_inserts(best).items() if s in (0, 3))

"""Operator 2: linking quotations to the messages they come from, and conversations without quotes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Quote marks in front of a line, and the line that introduces a quotation.
MARKS = re.compile(r"(?:[ \t]*>)+ ?")
INTRODUCES = re.compile(r"(?:wrote|writes|schrieb|escribió|a écrit)\s*:\s*$", re.IGNORECASE)
#: A quoted line counts as a passage of its own from so many characters on.
LEAST_LINE = 16


def key(text: str) -> str | None:
    """A digest of a passage without differences of case and white space; None if nothing is left."""
    plain = " ".join(text.lower().split())
    return xxhash.xxh3_128_hexdigest(plain.encode()) if plain else None


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, passage)]): runs of lines with equally many quote marks.

    A line that introduces a quotation and stands right before a deeper run goes.
    """
    lines = []
    for line in text.split("\n"):
        m = MARKS.match(line) if ">" in line else None
        lines.append((m.group().count(">"), line[m.end() :]) if m else (0, line))
    runs: list[tuple[int, list[str]]] = []
    for i, (level, line) in enumerate(lines):
        if i + 1 < len(lines) and lines[i + 1][0] > level and INTRODUCES.search(line):
            continue
        if runs and runs[-1][0] == level:
            runs[-1][1].append(line)
        else:
            runs.append((level, [line]))
    own = "\n".join("\n".join(x) for level, x in runs if level == 0)
    return own, [(level, "\n".join(x)) for level, x in runs if level]


def _lines(text: str) -> set[str]:
    return {k for x in text.split("\n") if len(x.strip()) >= LEAST_LINE and (k := key(x))}


def parsed(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, own, keys, quotes): own text with the keys of its passages, and the quoted passages' keys."""
    schema = T.StructType([messages.schema[conv], messages.schema[turn], *T.StructType.fromDDL("own string, keys array<struct<key:string,whole:boolean>>, quotes array<struct<no:int,level:int,key:string,whole:boolean>>").fields])
    kinds = [pa.list_(pa.struct([("key", pa.string()), ("whole", pa.bool_())])), pa.list_(pa.struct([("no", pa.int32()), ("level", pa.int32()), ("key", pa.string()), ("whole", pa.bool_())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owns, keys, quotes = [], [], []
            for message in batch.column(2).to_pylist():
                if message is None:
                    owns.append(None)
                    keys.append([])
                    quotes.append([])
                    continue
                own, found = parse(message)
                whole = {k for x in (own, *re.split(r"\n\s*\n", own)) if (k := key(x))}
                owns.append(own)
                keys.append([{"key": k, "whole": True} for k in sorted(whole)] + [{"key": k, "whole": False} for k in sorted(_lines(own) - whole)])
                quotes.append([{"no": n, "level": level, "key": k, "whole": w} for n, (level, x) in enumerate(found) for w, ks in ((True, {key(x)} - {None}), (False, _lines(x) - {key(x)})) for k in sorted(ks)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(owns, pa.string()), pa.array(keys, kinds[0]), pa.array(quotes, kinds[1])], names=schema.names)

    return messages.select(conv, turn, text).mapInArrow(run, schema)


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", most_rounds: int = 40) -> DataFrame:
    """Replies linked to what they quote, and conversations in reply order without quotes.

    A quoted passage is a run of lines with equally many quote marks.  Its key (a digest
    without case and white space) is joined to the keys of the messages' own texts and
    paragraphs; a passage of which no whole is known is given to the message that holds most of its
    lines.  Originals come before the quoting message: the earliest one in the same conversation, else
    the earliest of all (by conversation and turn).  Both are aggregated to one row per key
    before the join, so a common passage multiplies nothing.  The first linked passage of level 1
    names the parent; roots and depths follow by pointer doubling.

    Returns one row per (conv, turn): own text (null stays null), parent_conv and parent_turn (null for a root),
    root_conv and root_turn, depth, n_quotes (quoted passages of any level) and n_linked, dealt out and sorted so
    that each thread stands in reply order: a message after the one it answers.  Repeated rows of one (conv, turn) are
    one message, the smallest text; rows with a null conv or turn are left out, as nothing can name them.
    Other input columns are not returned.
    """
    spark = messages.sparkSession
    base = messages.where(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull()).groupBy(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn")).agg(F.min(text_col).alias("text"))
    rows = common.table(parsed(base, "conv", "turn", "text"))
    own = rows.select("conv", "turn", F.explode("keys").alias("k")).select("conv", "turn", "k.key", "k.whole")
    near = own.groupBy("conv", "key").agg(F.min("turn").alias("near_turn"))
    far = own.where("whole").groupBy("key").agg(F.min(F.struct("conv", "turn")).alias("far"))
    quotes = rows.select("conv", "turn", F.explode("quotes").alias("q")).select("conv", "turn", "q.*")
    joined = quotes.join(near, ["conv", "key"], "left").withColumn("near_turn", F.when(F.col("near_turn") < F.col("turn"), F.col("near_turn")))
    joined = joined.join(far, "key", "left").withColumn("far", F.when(F.col("whole") & (F.col("far") < F.struct("conv", "turn")), F.col("far")))
    target = F.when(F.col("near_turn").isNotNull(), F.struct("conv", F.col("near_turn").alias("turn"))).otherwise(F.col("far"))
    votes = joined.select("conv", "turn", "no", "level", "whole", target.alias("to")).groupBy("conv", "turn", "no", "level", "to").agg(F.max("whole").alias("whole"), F.count("*").alias("n"))
    # Whole passages first, then most lines, then the earliest.
    rank = F.struct(F.col("to").isNotNull(), F.col("whole"), F.col("n"), -F.col("to.conv"), -F.col("to.turn"))
    passages = votes.groupBy("conv", "turn", "no", "level").agg(F.max_by("to", rank).alias("to"))
    # Of the passages that are nothing but blank there is no key and so no row.
    links = passages.groupBy("conv", "turn").agg(F.min_by("to", F.when((F.col("level") == 1) & F.col("to").isNotNull(), F.col("no"))).alias("parent"), F.count("*").alias("n_quotes"), F.count("to").alias("n_linked"))
    tree = rows.select("conv", "turn").join(links.select("conv", "turn", "parent"), ["conv", "turn"], "left")
    me = F.struct("conv", "turn")
    root = F.col("parent").isNull()
    up = common.checkpoint(tree.select(me.alias("id"), F.coalesce("parent", me).alias("top"), F.when(root, 0).otherwise(1).cast("long").alias("depth"), root.alias("done")))
    # Each round doubles the way that `top` reaches; only those not yet at a root take part.
    for _ in range(most_rounds):
        going = up.where("NOT done")
        if going.isEmpty():
            break
        over = up.select(F.col("id").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = going.join(over, "top").select("id", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        up = common.checkpoint(up.where("done").unionByName(moved))
    else:
        raise RuntimeError("replies nest deeper than 2 to the power of the rounds allowed")
    places = up.select("id.conv", "id.turn", F.col("top.conv").alias("root_conv"), F.col("top.turn").alias("root_turn"), "depth")
    out = rows.select("conv", "turn", "own").join(links, ["conv", "turn"], "left").join(places, ["conv", "turn"])
    order = ["root_conv", "root_turn", "depth", "conv", "turn"]
    return (
        out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("own").alias(text_col), F.col("parent.conv").alias("parent_conv"), F.col("parent.turn").alias("parent_turn"), "root_conv", "root_turn", "depth", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"))
        .repartitionByRange(common.partitions(spark), *[{"conv": F.col(conv_col), "turn": F.col(turn_col)}.get(c, F.col(c)) for c in order])
        .sortWithinPartitions(*[{"conv": conv_col, "turn": turn_col}.get(c, c) for c in order])
    )


def as_mail(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """Each turn as a mail that quotes the turn before it, and the one before that one level deeper."""
    base = conversations.select(conv_col, turn_col, text_col)
    before = lambda n: base.select(conv_col, (F.col(turn_col) + n).alias(turn_col), F.col(text_col).alias(f"before_{n}"))
    quoted = lambda c, mark: F.concat(F.lit(f"\n{mark} "), F.replace(F.col(c), F.lit("\n"), F.lit(f"\n{mark} ")))
    joined = base.join(before(1), [conv_col, turn_col], "left").join(before(2), [conv_col, turn_col], "left")
    tail = F.concat(F.lit("\nThe other side wrote:"), quoted("before_1", ">"), F.coalesce(F.concat(F.lit("\n> One wrote:"), quoted("before_2", "> >")), F.lit("")))
    return joined.select(conv_col, turn_col, F.concat(text_col, F.coalesce(tail, F.lit(""))).alias(text_col))

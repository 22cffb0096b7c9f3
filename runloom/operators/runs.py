"""Sequencing runs: ids, states, retention, request documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers from the weakest to the strongest state.
STATES = ["started", "progress", "failed", "completed"]


def run_fields(run_id: Column) -> dict[str, Column]:
    """P20: date (yyMMdd in front), instrument and experiment (all after the first underscore) of a run id."""
    parts = F.split(run_id, "_")
    return {
        "run_date": F.try_to_timestamp(F.when(run_id.rlike("^[0-9]{6}_"), F.substring(run_id, 1, 6)), F.lit("yyMMdd")).cast("date"),
        "instrument": F.get(parts, F.lit(1)),
        "experiment": F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "_")),
    }


def retention(runs: DataFrame, today: Column, date: str = "run_date", delete_after: int = 3650, drop_after: int = 180, allow: DataFrame | None = None) -> DataFrame:
    """What a run's age calls for; runs of the allow-list are kept.  Nothing is deleted."""
    age = F.datediff(today, F.col(date))
    kind = F.when(age > delete_after, "delete").when(age > drop_after, "drop_intensities").otherwise("keep")
    out = runs.withColumn("age_days", age).withColumn("retention", kind)
    if allow is None:
        return out
    marked = out.join(allow.select("run_id").distinct().withColumn("__allowed", F.lit(True)), "run_id", "left")
    return marked.withColumn("retention", F.when(F.col("__allowed"), "keep").otherwise(F.col("retention"))).drop("__allowed")


def rank(marker: str = "marker") -> Column:
    out = F.lit(-1)
    for i, s in enumerate(STATES):
        out = F.when(F.col(marker) == s, i).otherwise(out)
    return out


def lane_status(events: DataFrame) -> DataFrame:
    """The strongest marker of each run and lane, with its number of markings and processings."""
    return events.groupBy("run_id", "lane").agg(F.max_by("marker", rank()).alias("status"), F.count("*").alias("n_markers"), F.count_distinct(F.when(F.col("marker") == "completed", F.col("proc"))).alias("n_done"))


def latest(listing: DataFrame, by: str, name: str = "name", time: str = "mtime") -> DataFrame:
    """O2: the newest entry of each folder."""
    return listing.groupBy(by).agg(F.max_by(name, F.struct(time, name)).alias(name), F.max(time).alias(time))


def resolve_request(requests: DataFrame, dictionary: DataFrame) -> DataFrame:
    """J1 on request documents: indicesraw (ids; the first element is the header) becomes indicesseq (sequences), in order."""
    one = requests.select("runid", F.posexplode("indicesraw").alias("pos", "x")).select("runid", "pos", "x.name", "x.p7", "x.p5")
    kind = lambda k: dictionary.where(F.col("kind") == k).dropDuplicates(["id"]).select(F.col("id").alias(k), F.col("seq").alias(f"{k}_seq"))
    done = one.join(kind("p7"), "p7", "left").join(kind("p5"), "p5", "left")
    head = F.col("pos") == 0
    row = F.struct("pos", "name", F.when(head, F.col("p7")).otherwise(F.col("p7_seq")).alias("p7"), F.when(head, F.col("p5")).otherwise(F.col("p5_seq")).alias("p5"))
    seqs = done.groupBy("runid").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(r["name"].alias("name"), r["p7"].alias("p7"), r["p5"].alias("p5"))).alias("indicesseq"))
    return requests.drop("indicesseq").join(seqs, "runid", "left")


def request_rows(requests: DataFrame, dictionary: DataFrame) -> DataFrame:
    """J1 on request documents or their processings: a row for each index of indicesraw behind its header, ids as sequences (p7_seq, p5_seq; null if unknown).

    A list stays in the task that read it: its entries meet the dictionary one by one, and no list is shuffled or put together again.
    """
    rest = [c for c in requests.columns if c != "indicesraw"]
    each = requests.select(*rest, F.inline(F.slice("indicesraw", F.lit(2), F.size("indicesraw"))))
    kind = lambda k: dictionary.where(F.col("kind") == k).groupBy(F.col("id").alias(k)).agg(F.min("seq").alias(f"{k}_seq"))
    return each.join(kind("p7"), "p7", "left").join(kind("p5"), "p5", "left").select(*rest, "name", "p7", "p5", "p7_seq", "p5_seq")

"""Runs as a stream of marker events (run_id, marker, lane, proc, cycle, ts)."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet", files_per_trigger: int | None = 16) -> DataFrame:
    """The files of that name in a folder as a stream, in the shape of run events."""
    files = spark.readStream.schema(EVENTS).option("pathGlobFilter", name)
    if files_per_trigger is not None:
        files = files.option("maxFilesPerTrigger", files_per_trigger)
    marker = F.when(F.col("event_type") == "signup", "started").when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise("progress")
    return files.parquet(folder).select(F.concat(F.lit("RUN"), F.col("user_id").cast("string")).alias("run_id"), marker.alias("marker"), (1 + F.col("event_id") % 120).cast("int").alias("cycle"), "ts")


def new_runs(events: DataFrame) -> DataFrame:
    """Each finished run once, however late and in whatever order its events come; the state is one row per finished run."""
    return events.where(F.col("marker") == "completed").select("run_id").dropDuplicates(["run_id"])


def started_notices(events: DataFrame) -> DataFrame:
    """R2: how often a notice is due that a run has started, once until it is completed; for complete mode.

    Each run's started and completed events are kept in the state and walked in order of time, in whatever
    frames, files and triggers they come; completed goes before started at the same time.
    """
    decisive = events.where(F.col("marker").isin("started", "completed"))
    kept = decisive.groupBy("run_id").agg(F.array_sort(F.collect_set(F.struct("ts", "marker"))).alias("walk"))
    # Twice the notices, and 1 while the run is told of.
    step = lambda n, e: F.when(e["marker"] == "completed", n - n % 2).when(n % 2 == 1, n).otherwise(n + 3)
    return kept.select("run_id", F.shiftright(F.aggregate("walk", F.lit(0).cast("long"), step), 1).alias("n_notices")).where("n_notices > 0")


NOTICES = "run_id string, since timestamp, n_notices long"


class _Notices(StatefulProcessor):
    """Of a run the state keeps whether it is told of, how often it was, and the decisive events behind the watermark only until it passes them."""

    def __init__(self, forget_ms: int):
        self.forget_ms = forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "told boolean, n long, since timestamp, last timestamp")
        self.pending = handle.getListState("pending", "ts timestamp, marker string")

    @staticmethod
    def walk(events: list[tuple], told: bool, n: int) -> tuple[bool, int]:
        """Events in order of time, completed before started; equal ones count once."""
        for _, marker in sorted(set(events)):
            n += marker == "started" and not told
            told = marker == "started"
        return told, n

    def _kept(self) -> tuple[bool, int, object, object]:
        return self.run.get() if self.run.exists() else (False, 0, None, None)

    def _timer(self, at) -> None:
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        told, n, since, last = self._kept()
        new = [(ts.to_pydatetime(), m) for f in rows for ts, m in zip(f["ts"], f["marker"], strict=True)]
        waiting = [tuple(x) for x in self.pending.get()] if self.pending.exists() else []
        waiting = sorted({(pd.Timestamp(ts).to_pydatetime(), m) for ts, m in waiting} | set(new))
        times = [ts for ts, _ in waiting]
        since, last = min([times[0], *([pd.Timestamp(since).to_pydatetime()] if since is not None else [])]), max([times[-1], *([pd.Timestamp(last).to_pydatetime()] if last is not None else [])])
        self.pending.put(waiting)
        started = since if not self.run.exists() else self._kept()[2]
        self.run.update((told, n, started, last))
        self._timer(_ms(times[0]) + 1)
        yield pd.DataFrame({"run_id": [key[0]], "since": [pd.Timestamp(started)], "n_notices": [self.walk(waiting, told, n)[1]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs()
        told, n, since, last = self._kept()
        waiting = [(pd.Timestamp(ts).to_pydatetime(), m) for ts, m in self.pending.get()] if self.pending.exists() else []
        told, n = self.walk([x for x in waiting if _ms(x[0]) < passed], told, n)
        left = [x for x in waiting if _ms(x[0]) >= passed]
        end = _ms(pd.Timestamp(last).to_pydatetime()) + self.forget_ms
        if not left and end <= passed:
            self.run.clear()
            self.pending.clear()
        else:
            if left:
                self.pending.put(left)
            else:
                self.pending.clear()
            self.run.update((told, n, since, last))
            self._timer(_ms(left[0][0]) + 1 if left else end)
        yield pd.DataFrame({"run_id": pd.Series([], dtype=str), "since": pd.Series([], dtype="datetime64[us]"), "n_notices": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def _ms(t) -> int:
    return int(pd.Timestamp(t).timestamp() * 1000) if pd.Timestamp(t).tzinfo else int(pd.Timestamp(t).tz_localize("UTC").timestamp() * 1000)


def due_notices(events: DataFrame, delay: str = "30 days", forget_days: int = 400) -> DataFrame:
    """R2 with bounded state, for update mode: run_id, since, n_notices, a new row whenever a run's decisive events change.

    Events may come out of order by up to the delay; later ones are dropped.  Of a run the state is one row, and its
    decisive events of the last `delay`; when the watermark passes an event it is walked and forgotten, and a run without
    decisive events for forget_days is forgotten altogether.  If it then starts again it has another `since`:
    a run's notices are the sum over them (all_notices).
    """
    decisive = events.withWatermark("ts", delay).where(F.col("marker").isin("started", "completed")).select("run_id", "ts", "marker")
    return decisive.groupBy("run_id").transformWithStateInPandas(_Notices(forget_days * 86_400_000), NOTICES, "Update", "eventTime")


def all_notices(due: DataFrame) -> DataFrame:
    """R2: notices of each run, from the settled rows of due_notices."""
    return due.groupBy("run_id").agg(F.sum("n_notices").alias("n_notices")).where("n_notices > 0")


def run_listing(events: DataFrame) -> DataFrame:
    """The state of every run: its latest decisive marker."""
    rank = F.when(F.col("marker") == "completed", 3).when(F.col("marker") == "failed", 2).when(F.col("marker") == "started", 1).otherwise(0)
    return events.groupBy("run_id").agg(F.max_by("marker", F.struct(rank, "ts")).alias("state"), F.count("*").alias("n_events"))


def run_progress(events: DataFrame) -> DataFrame:
    """The furthest cycle of every run, and how many of its markers are of completion."""
    return events.groupBy("run_id").agg(F.max("cycle").alias("last_cycle"), F.count_if(F.col("marker") == "completed").alias("n_done"), F.count("*").alias("n_total")).withColumn("done_pct", 100.0 * F.col("n_done") / F.col("n_total"))


def fragment_progress(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Fragments done of the known total of each run, for update mode; counts: stream of (run_id, fragments), totals: table of (run_id, total).

    done_pct is null where the total is 0 or not known.  The table is read anew by each trigger.
    """
    known = totals.groupBy("run_id").agg(F.max("total").alias("total"))
    done = counts.groupBy("run_id").agg(F.sum("fragments").alias("n_done"))
    return done.join(known, "run_id", "left").select("run_id", "n_done", "total", F.try_divide(100.0 * F.col("n_done"), F.col("total")).alias("done_pct"))


def windowed_counts(events: DataFrame, window: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """Markers in tumbling windows, for append mode: a window is given out once, when the watermark has passed its end.

    The watermark is the latest time of the triggers before, less the delay.  An event whose window it has passed is dropped; one that is late
    by less still counts.  The state holds the windows that the watermark has not passed.
    """
    return events.withWatermark("ts", delay).groupBy(F.window("ts", window), "marker").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "marker", "n")


_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def settle(stream: DataFrame, mode: str, folder: str, keys: list[str] | None = None, progress: list[dict] | None = None) -> DataFrame:
    """Run a stream over all that is there; its rows are written as Parquet below the folder, by trigger, and read from there.

    In append mode the rows of all triggers are the result, in complete mode those of the last, in update mode of each key the row of its last
    trigger, so that a trigger writes changed rows only.  A trigger that is run again overwrites its own rows.  A second call with
    the same folder goes on where the first ended, and gives the rows of both.  progress gets what the stream says of each trigger.
    """
    spark = stream.sparkSession

    def write(rows: DataFrame, trigger: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/out/trigger={trigger}")

    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(_STORE[0], before) if before is not None else spark.conf.unset(_STORE[0])
    if query.exception():
        raise query.exception()
    if progress is not None:
        progress += query.recentProgress
    try:
        rows = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("trigger", T.LongType())])).parquet(f"{folder}/out")
    except AnalysisException:
        # No trigger had any files.
        return spark.createDataFrame([], stream.schema)
    if mode == "append":
        return rows.drop("trigger")
    if mode == "complete":
        last = rows.agg(F.max("trigger")).first()[0]
        return rows.where(F.col("trigger") == F.lit(last)).drop("trigger")
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "trigger").alias("row"))
    return latest.select("row.*")

"""Streams of run events in several batches, out of time order."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from runloom.streaming import runs

ZERO = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us", "UTC")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])


def write(folder, files):
    """A file per list of (hour, run, type), older by its place for the order in which the stream reads them."""
    for k, rows in enumerate(files):
        columns = [[1000 * k + i for i in range(len(rows))], [ZERO + dt.timedelta(hours=h) for h, _, _ in rows], [r for _, r, _ in rows], [t for _, _, t in rows], [0.0] * len(rows), [""] * len(rows)]
        path = f"{folder}/f{k:03d}.parquet"
        pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA), path)
        os.utime(path, (1_700_000_000 + 10 * k,) * 2)
    return str(folder)


def test_new_runs_over_several_unordered_batches(spark, tmp_path):
    """40 files (three triggers) over 400 days, newest first; run 7 completes again and again."""
    (tmp_path / "in").mkdir()
    folder = write(tmp_path / "in", [[(24 * 10 * (40 - k), k + 100, "purchase"), (24 * 10 * (40 - k), 7, "purchase"), (0, k + 500, "view")] for k in range(40)])
    made = runs.settle(runs.new_runs(runs.event_stream(spark, folder, "*.parquet")), "append", str(tmp_path / "made"))
    assert sorted(r["run_id"] for r in made.collect()) == sorted([f"RUN{k + 100}" for k in range(40)] + ["RUN7"])


def test_due_notices_with_bounded_state(spark, tmp_path):
    """Several triggers out of order within the delay: the same notices as a walk in order, and a state that does not grow with the events."""
    import random

    r = random.Random(8)
    events = [(h, r.choice([1, 1, 2, 3, 4]), r.choice(["signup", "purchase", "view", "error"])) for h in range(1200)]
    want, told = {}, set()
    for _, run, kind in events:
        if kind == "signup" and run not in told:
            told.add(run)
            want[f"RUN{run}"] = want.get(f"RUN{run}", 0) + 1
        elif kind == "purchase":
            told.discard(run)
    # Out of order by up to 40 hours, in 12 files that are read one after another.
    events = sorted(events, key=lambda e: e[0] + r.random() * 40)
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, [events[k * 100 : k * 100 + 100] for k in range(12)])
    told_of: list = []
    stream = runs.due_notices(runs.event_stream(spark, str(folder), "*.parquet", 1), "45 hours")
    made = runs.settle(stream, "update", str(tmp_path / "made"), ["run_id", "since"], told_of)
    assert sorted((x["run_id"], x["n_notices"]) for x in runs.all_notices(made).collect()) == sorted(want.items())
    rows = [x["stateOperators"][0]["numRowsTotal"] for x in told_of]
    assert len(rows) >= 12 and max(rows[6:]) <= 1.5 * max(rows[2:6]) and max(rows) < 200


def test_runs_are_forgotten_and_begin_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    day = 24
    write(folder, [[(0, 1, "signup")], [(40 * day, 2, "signup")], [(41 * day, 2, "purchase")], [(42 * day, 1, "signup")], [(43 * day, 3, "view")]])
    told_of: list = []
    made = runs.settle(runs.due_notices(runs.event_stream(spark, str(folder), "*.parquet", 1), "1 hour", forget_days=10), "update", str(tmp_path / "made"), ["run_id", "since"], told_of)
    assert sorted((x["run_id"], x["n_notices"]) for x in runs.all_notices(made).collect()) == [("RUN1", 2), ("RUN2", 1)]
    assert made.where("run_id = 'RUN1'").count() == 2


def test_late_events(spark, tmp_path):
    """Late by less than the delay counts, late by more does not; a second run goes on where the first ended."""
    folder = tmp_path / "in"
    folder.mkdir()
    hours = lambda: runs.windowed_counts(runs.event_stream(spark, str(folder), "*.parquet", 1), "1 hour", "5 hours")
    at = lambda df: {int((x["start"].replace(tzinfo=dt.timezone.utc) - ZERO).total_seconds() // 3600): x["n"] for x in df.collect()}
    files = [[(0, 1, "signup"), (10, 1, "signup")], [(6, 1, "signup"), (1, 1, "signup"), (20, 1, "signup")], [(90, 1, "signup")]]
    for k, want in enumerate(({0: 1}, {0: 1, 6: 1, 10: 1}, {0: 1, 6: 1, 10: 1, 20: 1})):
        write(tmp_path, files[: k + 1])
        os.rename(tmp_path / f"f{k:03d}.parquet", folder / f"f{k:03d}.parquet")
        assert at(runs.settle(hours(), "append", str(tmp_path / "made"))) == want


def test_fragments_of_a_total(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, [[(h, k % 3, "view") for h in range(5)] for k in range(6)])
    totals = spark.createDataFrame([("RUN0", 20), ("RUN1", 0)], "run_id string, total long")
    from pyspark.sql import functions as F

    counts = runs.event_stream(spark, str(folder), "*.parquet", 2).select("run_id", F.lit(1).cast("long").alias("fragments"))
    made = runs.settle(runs.fragment_progress(counts, totals), "update", str(tmp_path / "made"), ["run_id"])
    assert {r["run_id"]: tuple(r)[1:] for r in made.collect()} == {"RUN0": (10, 20, 50.0), "RUN1": (10, 0, None), "RUN2": (10, None, None)}


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    made = runs.settle(runs.new_runs(runs.event_stream(spark, str(tmp_path / "in"))), "append", str(tmp_path / "made"))
    assert made.collect() == []

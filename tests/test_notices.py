"""R2 over frames and files that are not in time order."""

import random

from test_streaming import write

from runloom.streaming import runs


def test_notices_in_order_across_frames_and_files(spark, tmp_path):
    r = random.Random(5)
    events = [(h, r.choice([1, 1, 1, 2, 3]), r.choice(["signup", "purchase", "view", "error"])) for h in range(900)]
    want, told = {}, set()
    for _, run, kind in events:
        if kind == "signup" and run not in told:
            told.add(run)
            want[f"RUN{run}"] = want.get(f"RUN{run}", 0) + 1
        elif kind == "purchase":
            told.discard(run)
    r.shuffle(events)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for n_files in (1, 20):  # one trigger, and two
            folder = tmp_path / str(n_files)
            (folder / "in").mkdir(parents=True)
            write(folder / "in", [events[k::n_files] for k in range(n_files)])
            stream = runs.started_notices(runs.event_stream(spark, str(folder / "in"), "*.parquet"))
            made = runs.settle(stream, "complete", str(folder / "made"))
            assert sorted((x["run_id"], x["n_notices"]) for x in made.collect()) == sorted(want.items())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)

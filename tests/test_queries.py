"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from runloom import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    made = queries.QUERIES[name](spark, SF)
    columns = sorted(made.columns)
    found = duck.execute(queries.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted(repr([norm(r[names.index(k)]) for k in columns]) for r in found.fetchall())
    assert sorted(repr([norm(r[k]) for k in columns]) for r in made.collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_notices_follow_the_events(spark):
    """R2 by a plain walk over each run's events in order."""
    events = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts").collect()
    told, want = set(), {}
    marker = {"signup": "started", "purchase": "completed"}
    for e in sorted(events, key=lambda e: (e["ts"], {"signup": "started", "purchase": "completed", "error": "failed"}.get(e["event_type"], "progress"))):
        run, m = f"RUN{e['user_id']}", marker.get(e["event_type"])
        if m == "started" and run not in told:
            told.add(run)
            want[run] = want.get(run, 0) + 1
        elif m == "completed":
            told.discard(run)
    assert {r["run_id"]: r["n_notices"] for r in queries.QUERIES["started_notices"](spark, SF).collect()} == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())

"""Read-shaped views, derived with the same SQL in Spark and DuckDB from the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READS = """
WITH k AS (
 SELECT concat(cast(l_orderkey as {S}),'.',cast(l_linenumber as {S}),'.',cast(l_partkey as {S}),'.',cast(l_suppkey as {S})) AS name,
        cast(l_orderkey as bigint) ok, cast(l_partkey as bigint) pk, cast(l_suppkey as bigint) sk, cast(l_linenumber as int) ln FROM lineitem),
b AS (SELECT *, translate(md5(name),'0123456789abcdef','ACGTACGTACGTACGT') AS seq0,
        translate(md5(concat('q',name)),'0123456789abcdef','5+?ABCDEFGHIIIII') AS qual,
        cast((ok + 7*pk) % 16 as int) AS m, cast(1 + pk % 32 as int) AS p FROM k),
c AS (SELECT *, CASE WHEN m = 0 THEN concat('NNNN', substr(seq0,5)) WHEN m = 1 THEN repeat('N',32) WHEN m = 2 THEN concat(repeat('A',28),substr(seq0,29)) ELSE seq0 END AS seq FROM b)
SELECT name, seq, qual,
 m NOT IN (3,4) AS mapped, m % 2 = 0 AS reverse, ln % 2 = 1 AS first_mate, ln % 2 = 0 AS second_mate, m < 14 AS paired, m < 13 AS proper_pair, (m = 5) AS is_duplicate, (m = 6) AS failed_qc,
 concat('chr', cast(1 + sk % 3 as {S})) AS ref, cast(pk * 10 as int) AS pos,
 CASE m % 4 WHEN 0 THEN '32M' WHEN 1 THEN '4S28M' WHEN 2 THEN '10M2I20M' ELSE '16M3D16M' END AS cigar,
 CASE m % 4 WHEN 0 THEN concat(cast(p-1 as {S}), translate(substr(seq,p,1),'ACGTN','CGTAA'), cast(32-p as {S}))
            WHEN 1 THEN '28' WHEN 2 THEN '30' ELSE '16^ACG16' END AS md,
 CASE m % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 3 END AS nm,
 cast(CASE WHEN ln % 2 = 1 THEN 30 + sk % 50 ELSE -(30 + sk % 50) END as int) AS insert_size,
 CASE WHEN m = 7 THEN NULL ELSE concat('RG', cast(1 + sk % 5 as {S})) END AS rg,
 substr(seq0,1,7) AS xi, substr(qual,1,7) AS yi, substr(seq0,8,7) AS xj, substr(qual,8,7) AS yj,
 cast(1 + sk % 2 as int) AS lane
FROM c"""

ERROR_METRICS = """
SELECT cast(1 + l_suppkey % 2 as int) AS lane, cast(1101 + l_partkey % 14 as int) AS tile, cast(1 + l_orderkey % 32 as int) AS cycle,
 avg(cast(l_discount as double)) AS error_rate FROM lineitem GROUP BY 1, 2, 3"""

TILE_METRICS = """
SELECT lane, tile, code, value FROM (
 SELECT cast(1 + o_custkey % 2 as int) AS lane, cast(1101 + o_orderkey % 14 as int) AS tile, 102 AS code, round(sum(cast(o_totalprice as double)), 0) AS value FROM orders GROUP BY 1, 2
 UNION ALL
 SELECT cast(1 + o_custkey % 2 as int), cast(1101 + o_orderkey % 14 as int), 103, round(sum(cast(o_totalprice as double) * 0.8), 0) FROM orders GROUP BY 1, 2) t"""

EXTRACTION_METRICS = """
SELECT cast(1 + l_suppkey % 2 as int) AS lane, cast(1101 + l_partkey % 14 as int) AS tile, cast(1 + l_orderkey % 32 as int) AS cycle,
 avg(cast(l_tax as double)) AS fwhm_a, avg(cast(l_tax as double) + 0.5) AS fwhm_c, max(cast(l_tax as double)) AS fwhm_g, min(cast(l_tax as double)) AS fwhm_t,
 cast(max(cast(l_quantity as double)) * 10 as int) AS int_a, cast(min(cast(l_quantity as double)) * 10 as int) AS int_c,
 CASE WHEN count(*) % 7 = 0 THEN NULL ELSE cast(count(*) as int) END AS int_g, cast(max(l_linenumber) as int) AS int_t
FROM lineitem GROUP BY 1, 2, 3"""

MASK = "SELECT DISTINCT cast(p_partkey * 10 + 5 as int) AS pos FROM part WHERE p_partkey % 3 = 0"

INDEX_DICT = """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'p7' ELSE 'p5' END AS kind, concat('I', cast(s_suppkey as {S})) AS id,
 translate(substr(md5(cast(s_suppkey as {S})),1,7),'0123456789abcdef','ACGTACGTACGTACGT') AS seq FROM supplier WHERE s_suppkey % 10 <> 9"""

INDEX_SHEET = """
SELECT CASE WHEN p_partkey % 17 = 0 THEN concat('control', cast(p_partkey as {S})) WHEN p_partkey % 23 = 0 THEN concat('bad name!', cast(p_partkey as {S})) ELSE concat('S', cast(p_partkey as {S})) END AS name,
 concat('I', cast((p_partkey % 40) * 2 as {S})) AS p7, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('I', cast((p_partkey % 40) * 2 + 1 as {S})) END AS p5
FROM part"""

RUN_EVENTS = """
SELECT concat('RUN', cast(user_id as {S})) AS run_id, CASE event_type WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'progress' END AS marker,
 cast(1 + event_id % 8 as int) AS lane, cast(event_id % 3 as int) AS proc, cast(1 + event_id % 120 as int) AS cycle, ts FROM events"""

VIEWS = {
    "reads": (READS, ["lineitem"]), "error_metrics": (ERROR_METRICS, ["lineitem"]), "tile_metrics": (TILE_METRICS, ["orders"]), "extraction_metrics": (EXTRACTION_METRICS, ["lineitem"]),
    "mask": (MASK, ["part"]), "index_dict": (INDEX_DICT, ["supplier"]), "index_sheet": (INDEX_SHEET, ["part"]), "run_events": (RUN_EVENTS, ["events"]),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, tables = VIEWS[name]
    sql = sql.replace("{S}", "string")
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **{t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in tables})


def spread(df: DataFrame) -> DataFrame:
    """A small table of fewer file splits than the cluster has cores is dealt out; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < 2 and df.rdd.getNumPartitions() < cores else df


def duck(*names: str) -> str:
    """The views as common table expressions for DuckDB, without WITH."""
    return ",\n".join(f"{n} AS ({VIEWS[n][0].replace('{S}', 'varchar')})" for n in names)

"""Sources and sinks on small files written here."""

import gzip
import json
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runloom.operators import indices, runs, tiles
from runloom.sources import fastq, instrument, sam, shared, tables

SAM = """@HD\tVN:1.6
@SQ\tSN:chr1\tLN:1000
@RG\tID:RG1\tSM:a
@RG\tID:RG2\tSM:b
r1\t99\tchr1\t11\t60\t4M\t=\t50\t44\tACGT\tIIII\tRG:Z:RG1\tXI:Z:ACGTACG\tYI:Z:IIIIIII\tNM:i:1\tMD:Z:1A2\tZQ:Z:a:b
r2\t1540\t*\t0\t0\t*\t*\t0\t0\tNNNN\t####
"""


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    made = {r["name"]: r for r in sam.read_sam(spark, str(tmp_path)).collect()}
    a, b = made["r1"], made["r2"]
    assert (a["paired"], a["proper_pair"], a["mapped"], a["first_mate"], a["second_mate"], a["reverse"]) == (True, True, True, True, False, False)
    assert (a["pos"], a["nm"], a["md"], a["xi"], a["rg"], a["tags"]) == (10, 1, "1A2", "ACGTACG", "RG1", {"ZQ": "a:b"})
    assert (b["mapped"], b["failed_qc"], b["is_duplicate"], b["ref"], b["cigar"], b["rg"]) == (False, True, True, None, None, None)
    assert {r[0] for r in sam.read_groups(spark, str(tmp_path)).collect()} == {"RG1", "RG2"}
    assert [tuple(r) for r in sam.references(spark, str(tmp_path)).collect()] == [("chr1", 1000)]
    sam.write_reads(sam.read_sam(spark, str(tmp_path)), str(tmp_path / "out"))
    assert spark.read.schema(sam.READS).parquet(str(tmp_path / "out")).count() == 2


def test_fastq(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fq").write_text("@r1\nACGTAC\n+\nIIIIII\n@r2\nTTGGCC\n+\n######\n")
    reads = fastq.read_fastq(spark, str(tmp_path / "in"))
    assert [tuple(r) for r in reads.orderBy("id").collect()] == [("r1", "ACGTAC", "IIIIII"), ("r2", "TTGGCC", "######")]
    cut = indices.control_reads_by_cycle(reads, "GT", 3, (1, 2), (5, 2)).collect()
    assert [(r["seq1"], r["seq2"], r["qual2"]) for r in cut] == [("AC", "AC", "II")]
    fastq.write_fastq(reads, str(tmp_path / "out"), "/1")
    back = fastq.read_fastq(spark, str(tmp_path / "out"))
    assert {r["id"] for r in back.collect()} == {"r1/1", "r2/1"}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.fq").write_text("r1\nAC\n+\nII\n")
    with pytest.raises(Exception, match="not a FASTQ"):
        fastq.read_fastq(spark, str(tmp_path / "bad")).collect()


def test_fastq_in_splits(spark, tmp_path):
    """Splits that begin and end anywhere in a record, and shorter ones than a record, give every read once; only shared records are shuffled."""
    reads = [(f"r{i}", "ACGT" * (i % 9), "@I+#" * (i % 9)) for i in range(300)] + [("long", "A" * 900, "@" * 900)]
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.fq").write_text("".join(f"@{a}/{k}\n{b}\n+\n{c}\n" for a, b, c in reads[k::3]))
    want = sorted((f"{a}/{k}", b, c) for k in range(3) for a, b, c in reads[k::3])
    for size in ("64", "500", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            made = fastq.read_fastq(spark, str(tmp_path / "in"))
            assert sorted(tuple(r) for r in made.collect()) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "in" / "4.fq").write_text("@r\nA\n+\n")
    with pytest.raises(Exception, match="no multiple of four"):
        fastq.read_fastq(spark, str(tmp_path / "in")).collect()
    plan = fastq.read_fastq(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan


def test_base_calls(spark, tmp_path):
    data = {1: [0, 5, 255], 2: [4 * 10 + 2, 4 * 20 + 3, 1]}
    for cycle, calls in data.items():
        d = tmp_path / "L001" / f"C{cycle}.1"
        d.mkdir(parents=True)
        (d / "s_1_1101.bcl").write_bytes(struct.pack("<I", len(calls)) + bytes(calls))
    calls = instrument.read_bcl(spark, str(tmp_path))
    made = {(r["cycle"], r["cluster"]): (r["base"], r["qual"]) for r in calls.collect()}
    assert made == {(1, 0): ("A", 0), (1, 1): ("C", 1), (1, 2): ("T", 63), (2, 0): ("G", 10), (2, 1): ("T", 20), (2, 2): ("C", 0)}
    assert instrument.check_clusters(calls).count() == 0 and instrument.check_clusters(calls.where("NOT (cycle = 2 AND cluster = 2)")).count() == 1
    found = tiles.control_fraction(tiles.index_of_calls(calls, 1, 2), ["AG", "TC"]).first()
    assert (found["n_control"], found["n_clusters"]) == (2, 3)


def test_base_calls_written(spark, tmp_path):
    """Each base is a byte of a part when it is shuffled, and a tile's clusters stand in one order in all cycles."""
    reads = [(1, 1101 + i % 2, "".join("ACGTN"[(i + j) % 5] for j in range(3)), chr(33 + i % 40) * 3) for i in range(500)]
    made = spark.createDataFrame(reads, "lane int, tile int, seq string, qual string").repartition(3)
    instrument.write_bcl(made, str(tmp_path))
    calls = instrument.read_bcl(spark, str(tmp_path)).collect()
    found = {}
    for r in calls:
        found.setdefault((r["lane"], r["tile"], r["cluster"]), {})[r["cycle"]] = (r["base"], r["qual"])
    want = [(lane, tile, tuple(("A", 0) if b == "N" else (b, ord(q) - 33) for b, q in zip(seq, qual, strict=True))) for lane, tile, seq, qual in reads]
    assert sorted((k[0], k[1], tuple(v[c] for c in (1, 2, 3))) for k, v in found.items()) == sorted(want)
    with pytest.raises(Exception, match="as many qualities"):
        instrument.write_bcl(spark.createDataFrame([(1, 1101, "ACG", "II")], "lane int, tile int, seq string, qual string"), str(tmp_path / "bad"))


def test_numbered(spark):
    """Lines are numbered over the whole sheet, by their order and not by what stands in their names."""
    rows = [(f"S{(i * 37) % 101}", f"I{i % 5}", None if i % 3 == 0 else f"I{i % 7}") for i in range(101)] + [("S1", "I9", None), ("S1", "I9", "I1")]
    made = tables.numbered(spark.createDataFrame(rows, "name string, p7 string, p5 string").repartition(5), "line", "name", "p7", "p5").orderBy("line").collect()
    want = sorted(rows, key=lambda r: (r[0], r[1], r[2] is None, r[2] or ""))
    assert [tuple(r) for r in made] == [(*r, i) for i, r in enumerate(want, 1)]


def test_request_rows(spark):
    """A request's indices meet the dictionary without a shuffle of the lists."""
    requests = spark.createDataFrame([("r", 1, [("#index", "p7", "p5"), ("a", "I2", "I3"), ("b", "I9", None)]), ("s", None, [("#index", "p7", "p5")])], f"runid string, processing int, indicesraw {tables.INDEX}")
    dictionary = spark.createDataFrame([("p7", "I2", "ACG"), ("p5", "I3", "TTT"), ("p5", "I2", "CCC")], "kind string, id string, seq string")
    made = runs.request_rows(requests, dictionary)
    assert sorted(tuple(r) for r in made.collect()) == [("r", 1, "a", "I2", "I3", "ACG", "TTT"), ("r", 1, "b", "I9", None, None, None)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "indicesraw" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_request_rows_from_files(spark, tmp_path, monkeypatch):
    """Lists that are resolved where they are read give the rows that documents, processings and dictionary give when joined; so does a dictionary too large to be sent."""
    head = {"name": "#index", "p7": "p7", "p5": "p5"}
    many = [head, *({"name": f"S{i}", "p7": f"I{i % 7}", "p5": f"I{i % 5}"} for i in range(3000))]
    docs = [
        {"runid": "r1", "adapter11": "A", "mergeoverlap1": True, "adapter12": "C", "indicesraw": many, "expname": "indicesraw"},
        {"indicesraw": many, "runid": "r2", "lanes": [1, 2]},
        {"runid": "r3", "indicesraw": [*many[:-1], {"name": "other"}], "rest": {"indicesraw": [1]}},
        {"runid": "r4", "indicesraw": [head, {"p7": "I1", "name": 'q"[]\u00fc', "more": [1]}, {"name": 5, "p7": True, "p5": None}, {"name": {"a": 1}}, None]},
        {"runid": "r5", "indicesraw": []}, {"runid": "r6", "indicesraw": [head]}, {"runid": "r7", "indicesraw": None}, {"runid": "r8"},
    ]
    for i, d in enumerate(docs):
        text = json.dumps(d, indent=i % 3 or None)
        (tmp_path / f"{i}.json").write_text(text) if i % 2 else (tmp_path / f"{i}.json.gz").write_bytes(gzip.compress(text[:50].encode()) + gzip.compress(text[50:].encode()))
    book = spark.createDataFrame([("p7", "I1", "ACG"), ("p7", "I1", "AAA"), ("p5", "I3", "TTT"), ("p5", "I2", None), ("p7", None, "GGG"), ("p9", "I2", "CCC")], "kind string, id string, seq string")
    joined = runs.request_rows(tables.read_requests(spark, str(tmp_path)), book)
    found = tables.read_request_rows(spark, str(tmp_path), book)
    some = ["runid", "processing", "adapter1", "mergeoverlap", "name", "p7", "p5", "p7_seq", "p5_seq", F.to_json("rest")]
    want = sorted(map(repr, joined.select(some).collect()))
    assert len(want) == 4 * 3000 + 4 and sorted(map(repr, found.select(some).collect())) == want
    monkeypatch.setattr(tables, "BOOK_ROWS", 2)
    assert sorted(map(repr, tables.read_request_rows(spark, str(tmp_path), book).select(some).collect())) == want


def test_a_list_of_many_requests_is_parsed_once(monkeypatch):
    """A list is known again only by its whole text, and a document that is none raises."""
    texts = [json.dumps({"runid": str(i), "indicesraw": [{}, *({"name": f"S{k}", "p7": "I"} for k in range(400)), {"name": f"T{i // 5}"}]}).encode() for i in range(10)]
    seen, decode = [], tables._json.raw_decode
    monkeypatch.setattr(tables, "_json", type("J", (), {"raw_decode": staticmethod(lambda s, at: (seen.append(s[at]), decode(s, at))[1])}))
    batch = lambda x: pa.RecordBatch.from_pydict({"path": [f"{i}.json" for i in range(len(x))], "content": pa.array(x, pa.binary())})
    made = list(tables._request_parts(iter([batch(texts[:5]), batch(texts[:5])]), {"p7": {"I": "A"}, "p5": {}}, ("name", "p7_seq"), "one"))
    assert seen.count("[") == 1 and len(made) == 10
    assert {(e["name"], e["p7_seq"]) for e in made[7]["entries"][0].as_py()} == {(f"S{k}", "A") for k in range(400)} | {("T0", None)}
    assert json.loads(made[7]["text"][0].as_py()) == {"runid": "2", "indicesraw": None}
    made = list(tables._request_parts(iter([batch(texts)]), {"p7": {}, "p5": {}}, ("name", "p7_seq"), "two"))
    assert [(m["entries"][0].as_py()[0]["p7_seq"], m["entries"][0].as_py()[-1]["name"]) for m in made] == [(None, f"T{i // 5}") for i in range(10)]
    for wrong in (b"", b"[]", b'{"runid": 1', b'{"indicesraw": {"name": "x"}}', b'{"indicesraw": [1]}', b'{"a" 1}'):
        with pytest.raises(ValueError, match="0.json is no request document"):
            list(tables._request_parts(iter([batch([wrong])]), {"p7": {}, "p5": {}}, ("name",), "three"))


def test_text_that_many_files_hold_is_compressed_once(spark, tmp_path):
    """Members behind each other are one file for Spark's reader and ours."""
    rows = spark.createDataFrame([(k, "line " * 1000 + str(k)) for k in range(3)], "k int, text string")
    packed = shared.gzipped(rows, "text").crossJoin(spark.range(4)).orderBy("id", "k").coalesce(1)
    assert shared.write_parts(packed.select(F.format_string("f%d.txt.gz", "id").alias("file"), F.col("text").alias("content")), str(tmp_path), compression=None) == 4
    want = "".join("line " * 1000 + str(k) for k in range(3))
    assert [r["value"] for r in spark.read.text(str(tmp_path), wholetext=True).collect()] == [want] * 4
    assert shared.unpacked("f1.txt.gz", pa.py_buffer((tmp_path / "f1.txt.gz").read_bytes())).decode() == want


def test_parts_of_files(spark, tmp_path):
    """Rows of a file are written behind each other; a name that says so is compressed."""
    parts = spark.range(300).select(F.concat(F.lit("f"), (F.col("id") % 7).cast("string"), F.lit(".json.gz")).alias("file"), F.col("id").cast("string").alias("at")).repartition("file").sortWithinPartitions("file", F.col("at").cast("int"))
    assert shared.write_parts(parts.select("file", F.encode(F.concat("at", F.lit(" ")), "UTF-8").alias("content")), str(tmp_path)) == 7
    assert (tmp_path / "f3.json.gz").read_bytes()[:2] == b"\x1f\x8b"
    found = {r["value"] for r in spark.read.text(str(tmp_path), wholetext=True).collect()}
    assert found == {"".join(f"{i} " for i in range(k, 300, 7)) for k in range(7)}


def test_positions(spark, tmp_path):
    for name, data in (("pos", {"s_1_1101_pos.txt": b"1 2\n3 4\n", "s_2_1102_pos.txt": b"1 2\n"}), ("locs", {"s_1_1101.locs": struct.pack("<IfI", 1, 1.0, 7)}), ("clocs", {"s_1_1101.clocs": b"\1" + struct.pack("<I", 3) + b"\2" + b"xxxx" + b"\0" + b"\1" + b"xx"})):
        d = tmp_path / name
        d.mkdir()
        for f, x in data.items():
            (d / f).write_bytes(x)
    count = lambda d: {(r["lane"], r["tile"]): r["n"] for r in instrument.count_positions(spark, str(tmp_path / d)).collect()}
    assert count("pos") == {(1, 1101): 2, (2, 1102): 1} and count("locs") == {(1, 1101): 7} and count("clocs") == {(1, 1101): 3}
    (tmp_path / "locs" / "s_1_1101_pos.txt").write_bytes(b"1\n")
    with pytest.raises(Exception, match="different kinds"):
        count("locs")


def test_metrics(spark, tmp_path):
    (tmp_path / "e.bin").write_bytes(bytes([3, 30]) + b"".join(struct.pack("<HHHf", 1, 1101, c, 0.5 * c) + bytes(20) for c in (1, 2)))
    (tmp_path / "x.bin").write_bytes(bytes([2, 38]) + struct.pack("<HHH4f4H", 1, 1101, 1, 1.5, 2.5, 3.5, 4.5, 10, 20, 30, 40) + bytes(8))
    (tmp_path / "t.bin").write_bytes(bytes([2, 10]) + b"".join(struct.pack("<HHHf", 1, 1101, c, v) for c, v in ((100, 1.0), (102, 99.6), (103, 80.2))))
    assert [tuple(r) for r in instrument.read_error_metrics(spark, str(tmp_path / "e.bin")).collect()] == [(1, 1101, 1, 0.5), (1, 1101, 2, 1.0)]
    assert tuple(instrument.read_extraction_metrics(spark, str(tmp_path / "x.bin")).first()) == (1, 1101, 1, 1.5, 2.5, 3.5, 4.5, 10, 20, 30, 40)
    row = tiles.tile_counts(instrument.read_tile_metrics(spark, str(tmp_path / "t.bin"))).first()
    assert (row["clusters"], row["pf_clusters"]) == (100, 80)
    (tmp_path / "w.bin").write_bytes(bytes([9, 10]))
    with pytest.raises(Exception, match="version 9"):
        instrument.read_tile_metrics(spark, str(tmp_path / "w.bin")).collect()


def test_run_documents(spark, tmp_path):
    (tmp_path / "run.xml").write_text('<RunInfo><Run Id="120101_M1_X"><Instrument>M1</Instrument><FlowcellLayout LaneCount="8" SurfaceCount="2" SwathCount="3" TileCount="16"/><Reads><Read Number="1" NumCycles="76"/><Read Number="2" NumCycles="7"/></Reads></Run></RunInfo>')
    row = instrument.read_run_info(spark, str(tmp_path / "run.xml")).first()
    assert (row["run"], row["instrument"], row["lanes"], row["tiles"], [(r["read"], r["length"]) for r in row["reads"]]) == ("120101_M1_X", "M1", 8, 96, [(1, 76), (2, 7)])
    (tmp_path / "old.xml").write_text('<RunInfo><Run Id="r"><FlowcellLayout LaneCount="1" TileCount="2"/><Reads><Read FirstCycle="1" LastCycle="50"/><Read FirstCycle="51" LastCycle="60"/></Reads></Run></RunInfo>')
    assert [r["length"] for r in instrument.read_run_info(spark, str(tmp_path / "old.xml")).first()["reads"]] == [50, 10]
    (tmp_path / "tl.xml").write_text('<Data><TL Key="1_1101" Val="0.5"/><TL Key="2_1102" Val="1.5"/></Data>')
    assert sorted(tuple(r) for r in instrument.read_tile_errors_xml(spark, str(tmp_path / "tl.xml")).collect()) == [(1, 1101, 0.5), (2, 1102, 1.5)]
    (tmp_path / "int.tsv").write_text("# made by\n9\t9\t9\t9\t9\nColor\tCycle\tLane\tTile\tIntensity\n0\t1\t0\t1101\t12.5\n3\t1\t0\t1101\tNaN\n2\t5\t0\t1101\t12.5\n")
    assert sorted((tuple(r) for r in instrument.read_tile_table(spark, str(tmp_path / "int.tsv"), "intensity").collect()), key=str) == [(1, 1101, 1, "A", 12.5), (1, 1101, 1, "T", None), (1, 1101, 5, "G", 12.5)]
    (tmp_path / "foc.tsv").write_text("Color\tCycle\tLane\tTile\tFocus\n4\t1\t1\t1101\t2.5\n")
    assert tuple(instrument.read_tile_table(spark, str(tmp_path / "foc.tsv"), "focus").first()) == (1, 1101, 1, "T", 2.5)


def test_lane_summary_and_cluster_table(spark, tmp_path):
    values = " ".join(f'{v}="{i}.5"' for i, v in enumerate(instrument.LANE_VALUES))
    (tmp_path / "lanes.xml").write_text(f'<?xml version="1.0"?><Summary densityRatio="0.7"><Lane key="1" {values}/><Lane key="2" ClustersRaw="3"/></Summary>')
    rows = {r["lane"]: r for r in instrument.read_lane_summary(spark, str(tmp_path / "lanes.xml")).collect()}
    assert rows[1]["density_ratio"] == 0.7 and [rows[1][v] for v in instrument.LANE_VALUES] == [i + 0.5 for i in range(14)] and rows[2]["Phasing"] is None
    (tmp_path / "clusters.tsv").write_text("1\t2\t3\nLane\tTile\tCluster\n0\t1101\t250.5\n7\t1102\tnan\nshort\t1\n")
    assert sorted((tuple(r) for r in instrument.read_cluster_table(spark, str(tmp_path / "clusters.tsv")).collect()), key=str) == [(1, 1101, 250.5), (8, 1102, None)]


def _bcl(folder, lane, tile, cycle, data, said=None):
    place = folder / f"L00{lane}" / f"C{cycle}.1"
    place.mkdir(parents=True, exist_ok=True)
    (place / f"s_{lane}_{tile}.bcl").write_bytes((len(data) if said is None else said).to_bytes(4, "little") + bytes(data))


def test_base_calls_are_pruned_and_read_in_ranges(spark, tmp_path, monkeypatch):
    from runloom.sources import records

    for cycle in (1, 2, 3):
        _bcl(tmp_path, 1, 1101, cycle, [4 * k % 256 + cycle for k in range(10)])
        _bcl(tmp_path, 1, 1102, cycle, [0, 255])
        _bcl(tmp_path, 2, 1101, cycle, [7], said=9)  # broken: opening it raises
    some = instrument.read_bcl(spark, str(tmp_path), lanes=[1], tiles=[1101], cycles=[2, 3])
    made = {(r["cycle"], r["cluster"]): (r["base"], r["qual"]) for r in some.collect()}
    want = {(c, k): ("ACGT"[(4 * k + c) % 4], (4 * k + c) // 4 % 64) for c in (2, 3) for k in range(10)}
    assert made == want and {(r["lane"], r["tile"]) for r in some.collect()} == {(1, 1101)}
    opened = []
    reader = records._BaseCallReader({"path": str(tmp_path), "lanes": "1", "tiles": "1102"})
    monkeypatch.setattr(records, "TASK_BYTES", 3)
    parts = reader.partitions()
    assert all(r.stop - r.start <= 3 for p in parts for r in p.ranges) and {r.key[1] for p in parts for r in p.ranges} == {1102}
    assert [(b.num_rows) for p in parts for b in reader.read(p)] == [2, 2, 2] and not opened
    wide = records._BaseCallReader({"path": str(tmp_path), "lanes": "1", "tiles": "1101", "cycles": "1"})
    assert [b.column(3).to_pylist() for p in wide.partitions() for b in wide.read(p)] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    with pytest.raises(Exception, match="as many clusters"):
        instrument.read_bcl(spark, str(tmp_path), lanes=[2]).collect()
    _bcl(tmp_path, 1, 1102, 3, [1, 2, 3])
    with pytest.raises(Exception, match="other cycles"):
        instrument.read_bcl(spark, str(tmp_path), lanes=[1]).collect()
    assert instrument.read_bcl(spark, str(tmp_path), lanes=[5]).collect() == []


def test_nothing_is_cut_short(spark, tmp_path):
    (tmp_path / "long.sam").write_text("a\t0\tr\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\tXX:Z:" + "x" * 1_000_005 + "\n")
    assert len(sam.read_sam(spark, str(tmp_path / "long.sam")).first()["tags"]["XX"]) == 1_000_005
    (tmp_path / "many.sam").write_text("a\t0\tr\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\t" + "\t".join(f"{a}{b}{c}".replace("", "")[:2] + ":Z:1" for a in "ABCDEFGHIJ" for b in "ABCDEFGHIJ" for c in "0") + "\n")
    assert len(sam.read_sam(spark, str(tmp_path / "many.sam")).first()["tags"]) == 100
    (tmp_path / "long.fq").write_text("@" + "n" * 1_000_002 + "\nAC\n+\nII\n")
    assert len(fastq.read_fastq(spark, str(tmp_path / "long.fq")).first()["id"]) == 1_000_002
    from pyspark.sql import functions as F

    fields = spark.createDataFrame([("120101_" + "_".join("ab" for _ in range(1500)),)], "run_id string").select(runs.run_fields(F.col("run_id"))["experiment"].alias("e"))
    assert fields.first()["e"] == "_".join("ab" for _ in range(1500))


def test_duplicates_of_several_insert_sizes(spark):
    from runloom.operators import profiles

    rows = [(n, True, "IIII", "RG1", "chr1", 10, False, size) for n, size in (("a", 100), ("b", 200), ("c", 100))]
    df = spark.createDataFrame(rows, "name string, mapped boolean, qual string, rg string, ref string, pos int, reverse boolean, insert_size int")
    assert sorted((r["name"], r["n_at_place"], r["duplicate"]) for r in profiles.mark_duplicates(df).collect()) == [("a", 2, False), ("b", 1, False), ("c", 2, True)]


def test_tables(spark, tmp_path):
    (tmp_path / "index.txt").write_text("#p7\tp5\tname\nACGTACG\tTTTTTTT\tS1\n")
    assert [tuple(r) for r in tables.read_index_sheet(spark, str(tmp_path / "index.txt")).collect()] == [("ACGTACG", "TTTTTTT", "S1")]
    (tmp_path / "mask.tsv").write_text("phix\t5\nphix\t9\nphix\t5\n")
    assert {r[0] for r in tables.read_mask(spark, str(tmp_path / "mask.tsv")).collect()} == {5, 9}
    (tmp_path / "tally.tsv").write_text("RG1\tpass\t1\t2\t3\t300000\tx\nshort\tpass\nhead\ta\tb\tc\td\te\tf\n")
    assert [tuple(r) for r in tables.read_tally(spark, str(tmp_path / "tally.tsv")).collect()] == [("RG1", "pass", 300000)]
    (tmp_path / "run.json").write_text(json.dumps({"runid": "r", "lanes": [1, 2], "indicesraw": [{"name": "name", "p7": "p7", "p5": "p5"}, {"name": "S", "p7": "1", "p5": "9"}, {"name": "T", "p7": "5"}]}, indent=1))
    request = tables.read_request(spark, str(tmp_path / "run.json"))
    book = spark.createDataFrame([("p7", "1", "ACGT"), ("p5", "9", "TTTT")], "kind string, id string, seq string")
    row = runs.resolve_request(request, book).first()
    assert [tuple(x) for x in row["indicesseq"]] == [("name", "p7", "p5"), ("S", "ACGT", "TTTT"), ("T", None, None)] and row["lanes"] == [1, 2]
    tables.write_status(spark.createDataFrame([("a", "OK")], "dataset string, status string"), str(tmp_path / "status"))
    assert spark.read.json(str(tmp_path / "status")).first()["status"] == "OK"


def test_fastq_over_splits(spark, tmp_path):
    """Splits of a few bytes, an empty read, a line of white space at the end of one, and a rest that is no record."""
    reads = [(f"r{i}", "" if i == 7 else "ACGT" * (i % 5 + 1), "" if i == 7 else "IIII" * (i % 5 + 1)) for i in range(40)]
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.fq").write_text("".join(f"@{i}\n{s}\n+\n{q}\r\n" for i, s, q in reads[k::2]))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert sorted(tuple(r) for r in fastq.read_fastq(spark, str(tmp_path / "in")).collect()) == sorted(reads)
        (tmp_path / "bad.fq").write_text("@a\nAC\n+\nII\n@b\nAC\n")
        with pytest.raises(Exception, match="multiple of four"):
            fastq.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_duplicates_are_dealt_out_once_and_deep_places_are_not(spark, monkeypatch):
    from runloom.operators import profiles

    rows = [(f"r{i:02d}", i != 5, "IIII"[: i % 5], "RG1" if i % 7 else None, "chr1", 10 if i < 30 else i, i % 2 == 0, 50) for i in range(40)]
    df = spark.createDataFrame(rows, "name string, mapped boolean, qual string, rg string, ref string, pos int, reverse boolean, insert_size int")
    want = {}
    for r in rows:
        if r[1]:
            want.setdefault(r[3:], []).append((-sum(ord(c) - 33 for c in r[2]), r[0]))
    want = sorted((name, -q, len(pile), name != min(pile)[1]) for pile in want.values() for q, name in pile)
    made = profiles.mark_duplicates(df)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, made.collect())) == want
    monkeypatch.setattr(profiles, "DEEP", 3)
    assert sorted(map(tuple, profiles.mark_duplicates(df).collect())) == want


def test_duplicates_of_several_references(spark):
    from runloom.operators import profiles

    rows = [(n, True, "IIII", "RG1", ref, 10, False, 50) for n, ref in (("a", "chr1"), ("b", "chr2"), ("c", "chr1"))]
    df = spark.createDataFrame(rows, "name string, mapped boolean, qual string, rg string, ref string, pos int, reverse boolean, insert_size int")
    assert {r["name"]: (r["n_at_place"], r["duplicate"]) for r in profiles.mark_duplicates(df).collect()} == {"a": (2, False), "b": (1, False), "c": (2, True)}


def test_sheet_problems(spark):
    lines = spark.createDataFrame([(0, "#index\tp7\tp5"), (1, "a\tb\tc"), (2, "a\tb")], "line long, value string")
    assert [tuple(r) for r in indices.sheet_problems(lines, True).collect()] == [(2, "not 3 fields")]
    assert sorted(tuple(r) for r in indices.sheet_problems(lines, False).collect()) == [(0, "not 2 fields"), (1, "not 2 fields")]


def test_requests_with_numbered_processings(spark, tmp_path):
    plain = {"runid": "r1", "expname": "e", "lanes": [1, 2], "adapter1": "'ACGTIII'", "key1": "", "mergeoverlap": False, "entropycutoff": "0.85", "indicesraw": [{"name": "#index", "p7": "p7", "p5": "p5"}, {"name": "S", "p7": "1"}]}
    many = {"runid": "r2", "adapter1": "AAA", "adapter12": "CCC", "key12": "TG", "key21": "GT", "mergeoverlap2": True, "entropycutoff2": "high", "indicesraw": []}
    for d in (plain, many):
        (tmp_path / f"{d['runid']}.json").write_text(json.dumps(d, indent=1))
    rows = {(r["runid"], r["processing"]): r for r in tables.read_requests(spark, str(tmp_path)).collect()}
    assert set(rows) == {("r1", None), ("r2", 1), ("r2", 2)}
    r = rows["r1", None]
    assert (r["adapter1"], r["key1"], r["mergeoverlap"], r["entropycutoff"], r["rest"]) == ("ACGTIII", "", False, 0.85, {"expname": "e", "lanes": "[1,2]"})
    assert [tuple(x) for x in r["indicesraw"]] == [("#index", "p7", "p5"), ("S", "1", None)]
    assert [(rows["r2", k]["adapter1"], rows["r2", k]["key1"], rows["r2", k]["key2"], rows["r2", k]["mergeoverlap"], rows["r2", k]["entropycutoff"]) for k in (1, 2)] == [("AAA", None, "GT", None, None), ("CCC", "TG", None, True, None)]


def test_report_comes_from_the_writing_job(spark, tmp_path):
    """Each row passes the flags once: an accumulator counts the rows that the scan gives."""
    from runloom.operators import flags
    from runloom.plans import filter_reads

    n, seen = 200, spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"r{i}", "ACGT" * 5 if i % 3 else "A" * 20, "I" * 20, i % 7 == 0) for i in range(n)]
    reads = spark.createDataFrame(rows, "name string, seq string, qual string, failed_qc boolean")
    reads = reads.mapInArrow(count, reads.schema)
    report = filter_reads.write_flagged(reads, str(tmp_path / "out"), entropy=1.0).first()
    assert seen.value == n and spark.read.parquet(str(tmp_path / "out")).count() == n
    assert report == filter_reads.filter_reads(reads, entropy=1.0)[1].first() and report["n_total"] == n


def test_sam_text_is_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    from runloom.sources import sam

    rows = [(f"r{i}", True, i * 10, "ACGT" * 8, "I" * 32, "RG1") for i in range(2000)]
    flags = {c: F.lit(False) for c in ("proper_pair", "paired", "reverse", "first_mate", "second_mate", "failed_qc", "is_duplicate")}
    texts = {c: F.lit("ACGTACG") for c in ("xi", "yi", "xj", "yj")}
    reads = spark.createDataFrame(rows, "name string, mapped boolean, pos int, seq string, qual string, rg string").withColumns(flags | texts | {"cigar": F.lit("32M"), "md": F.lit("32"), "nm": F.lit(0), "insert_size": F.lit(0)}).coalesce(1)
    monkeypatch.setattr(sam, "FILE_READS", 500)
    sam.write_sam(reads, str(tmp_path / "sam"), reads.select("rg").distinct(), "gzip")
    files = list((tmp_path / "sam").glob("*.gz"))
    assert len(files) == 4 and sum(f.stat().st_size for f in files) * 2 < 2000 * 100
    made = sam.read_sam(spark, str(tmp_path / "sam"))
    assert sorted(map(tuple, made.select("name", "mapped", "pos", "seq", "qual", "rg").collect())) == sorted(rows)
    assert [r["rg"] for r in sam.read_groups(spark, str(tmp_path / "sam")).collect()] == ["RG1"]

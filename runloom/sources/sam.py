"""SAM text and Parquet reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The schema of a reads table; read it with spark.read.schema(READS).
READS = (
    "name string, flag int, paired boolean, proper_pair boolean, mapped boolean, reverse boolean, first_mate boolean, second_mate boolean, failed_qc boolean, is_duplicate boolean, "
    "ref string, pos int, cigar string, insert_size int, seq string, qual string, rg string, xi string, yi string, xj string, yj string, nm int, md string, lane int, tags map<string,string>"
)
#: Flag bits.
FLAGS = {"paired": 1, "proper_pair": 2, "unmapped": 4, "reverse": 16, "first_mate": 64, "second_mate": 128, "failed_qc": 512, "is_duplicate": 1024}


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Reads of SAM text, of one input or of many: fields, flag bits and tags; positions from 0."""
    parts = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).select(F.split("value", "\t").alias("f"))
    field = lambda i: F.get("f", F.lit(i))
    value = lambda i: F.nullif(field(i), F.lit("*"))
    tags = F.map_from_entries(F.transform(F.filter("f", lambda t, i: (i >= 11) & t.rlike("^..:.:")), lambda t: F.struct(F.substring(t, 1, 2), F.substr(t, F.lit(6)))))
    out = parts.select(field(0).alias("name"), field(1).cast("int").alias("flag"), value(2).alias("ref"), (field(3).cast("int") - 1).alias("pos"), value(5).alias("cigar"), field(8).cast("int").alias("insert_size"), value(9).alias("seq"), value(10).alias("qual"), tags.alias("tags"))
    bit = lambda name: F.col("flag").bitwiseAND(F.lit(FLAGS[name])) != 0
    out = out.withColumns({k: bit(k) for k in FLAGS if k != "unmapped"}).withColumn("mapped", ~bit("unmapped"))
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    out = out.withColumns({"rg": tag("RG"), "xi": tag("XI"), "yi": tag("YI"), "xj": tag("XJ"), "yj": tag("YJ"), "nm": tag("NM").cast("int"), "md": tag("MD"), "lane": F.lit(None).cast("int")})
    rest = F.map_filter("tags", lambda k, v: ~k.isin("RG", "XI", "YI", "XJ", "YJ", "NM", "MD"))
    return out.withColumn("tags", rest).select(*[c.split()[0] for c in READS.replace("map<string,string>", "map").split(", ")])


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """The header's read groups, those without reads included."""
    return spark.read.text(path).where(F.col("value").startswith("@RG")).select(F.regexp_extract("value", "\tID:([^\t]+)", 1).alias("rg")).distinct()


def references(spark: SparkSession, path: str) -> DataFrame:
    """The header's reference sequences."""
    return spark.read.text(path).where(F.col("value").startswith("@SQ")).select(F.regexp_extract("value", "\tSN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", "\tLN:([0-9]+)", 1).cast("long").alias("length"))


def write_reads(flagged: DataFrame, path: str) -> None:
    """K1, K5: all reads with their marks and metrics; none is dropped."""
    flagged.write.parquet(path)


#: Reads of a compressed file, which one task reads.
FILE_READS = 1_000_000


def write_sam(reads: DataFrame, path: str, groups: DataFrame, compression: str | None = None) -> None:
    """Reads of the schema above as SAM text, with the header lines of their groups (rg) in a file of their own.

    Compressed (gzip), which read_sam reads as well, files take FILE_READS reads at most, since they are not read in splits.
    """
    bit = lambda name: F.when(~F.col("mapped") if name == "unmapped" else F.col(name), FLAGS[name]).otherwise(0)
    flag = sum((bit(k) for k in FLAGS), F.lit(0))
    tag = lambda name, kind: F.concat(F.lit(f"{name}:{kind}:"), F.col(name.lower()).cast("string"))
    or_star = lambda c: F.coalesce(F.col(c), F.lit("*"))
    ref = or_star("ref") if "ref" in reads.columns else F.lit("ref")
    fields = ["name", flag.cast("string"), ref, (F.col("pos") + 1).cast("string"), F.lit("60"), or_star("cigar"), F.lit("*"), F.lit("0"), F.col("insert_size").cast("string"), or_star("seq"), or_star("qual")]
    tags = [tag(*x) for x in (("RG", "Z"), ("XI", "Z"), ("YI", "Z"), ("XJ", "Z"), ("YJ", "Z"), ("NM", "i"), ("MD", "Z"))]
    groups.select(F.concat(F.lit("@RG\tID:"), "rg", F.lit("\tSM:x")).alias("value")).write.mode("append").text(path)
    lines = reads.select(F.concat_ws("\t", *fields, *tags).alias("value")).write.mode("append")
    if compression is not None:
        # The fastest level: indices repeat bases and qualities, and the rest is hardly smaller at slower ones.
        lines = lines.option("compression", compression).option("maxRecordsPerFile", FILE_READS).option("zlib.compress.level", "BEST_SPEED")
    lines.text(path)

"""Content-addressed, immutable artifacts."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.sources.snapshots import record_count


def content_digest(rows: DataFrame) -> str:
    """A digest of the rows as a multiset, whatever their order or partitions: counts and sums of row hashes, then sha256."""
    names = sorted(rows.columns)
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in names)), {"ignoreNullFields": "false"})
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), text).cast("decimal(38,0)"))
    n, a, b = rows.agg(F.count("*"), h(1), h(2)).first()
    return hashlib.sha256(f"{names} {n} {a} {b}".encode()).hexdigest()


def write_artifact(rows: DataFrame, folder: str) -> tuple[str, str]:
    """Writes Parquet under a path named by the content; an artifact that stands already is not written again. Read back."""
    digest = content_digest(rows)
    path = f"{folder.rstrip('/')}/{digest}"
    spark = rows.sparkSession
    if not _exists(spark, f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    read_artifact(spark, folder, digest)
    return digest, path


def read_artifact(spark: SparkSession, folder: str, digest: str) -> DataFrame:
    """The artifact's rows; an error if they are not what its name says."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{digest}")
    if content_digest(rows) != digest:
        raise ValueError(f"artifact {digest} does not hold its content")
    return rows


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def file_snapshots(spark: SparkSession, path: str, pattern: str = "*.json", most_bytes: int = 1 << 24) -> DataFrame:
    """File, bytes, digest (sha256, null over the cap), content and outcome (ok, too_large) of the files below `path`; files over the cap are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    held = files.where(F.col("length") <= most_bytes).select("path", "length", "content", F.lit("ok").alias("outcome"))
    over = files.where(F.col("length") > most_bytes).select("path", "length", F.lit(None).cast("binary").alias("content"), F.lit("too_large").alias("outcome"))
    return held.unionByName(over).select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"), "content", "outcome")


def checked_snapshots(spark: SparkSession, path: str, digests: dict[str, str], pattern: str = "*.json", most_bytes: int = 1 << 24, most_records: int = 5000) -> DataFrame:
    """File, name, records, value of JSON snapshots that are what `digests` (by file name) says; any other is an error of the job.

    A file without a digest, over the byte or record cap, of other content, or
    that changed while it was read (it is read a second time) fails.
    """
    first, again = file_snapshots(spark, path, pattern, most_bytes), file_snapshots(spark, path, pattern, most_bytes).select("file", F.col("digest").alias("later"))
    want = spark.createDataFrame(list(digests.items()) or [("", "")], "name string, want string")  # an argument of the call
    value = F.col("content").cast("string")
    rows = first.withColumn("name", F.element_at(F.split("file", "/"), -1)).join(again, "file", "left").join(F.broadcast(want), "name", "left")
    count = record_count(value)
    problem = (
        F.when(F.col("want").isNull(), "is not in the manifest").when(F.col("outcome") != "ok", "is over the byte cap").when(~F.col("later").eqNullSafe(F.col("digest")), "changed while it was read")
        .when(F.col("digest") != F.col("want"), "is not what its digest says").when(count > most_records, "is over the record cap")
    )
    rows = rows.withColumn("_problem", problem)
    fail = F.raise_error(F.concat(F.col("name"), F.lit(" "), F.col("_problem"))).cast("boolean")
    return rows.where(F.when(F.col("_problem").isNotNull(), fail).otherwise(F.lit(True))).select("file", "name", count.alias("records"), value.alias("value"))

"""Two-pass external shuffle into shards: records scatter into memory-sized buckets, each bucket is shuffled and written."""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from placeforge.llm.runtime import beside, cut, scratch

BUCKET_BYTES = 32 << 20  # text that one task shuffles in memory
ROW_BYTES = 64  # what a row counts besides its text
SEED = 20240
RUN = 4096  # buckets whose sizes are summed up at once


def _identity(docs: DataFrame, seed: int) -> Column:
    """A seeded hash of the whole row, columns with maps aside."""
    holds_map = lambda kind: isinstance(kind, MapType) or any(holds_map(getattr(kind, k)) for k in ("elementType",) if hasattr(kind, k)) or any(holds_map(f.dataType) for f in getattr(kind, "fields", ()))
    return F.xxhash64(F.lit(seed), *(F.col(f"`{f.name}`") for f in docs.schema.fields if not holds_map(f.dataType)))


def _starts(counts: DataFrame) -> DataFrame:
    """bucket, and how many rows the buckets before it hold; runs of RUN buckets are summed up first."""
    before = lambda by: by.rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("run", F.floor(F.col("bucket") / RUN))
    runs = counts.groupBy("run").agg(F.sum("n").alias("n"))
    runs = runs.select("run", F.coalesce(F.sum("n").over(before(Window.orderBy("run"))), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("n").over(before(Window.partitionBy("run").orderBy("bucket"))), F.lit(0))
    return counts.join(F.broadcast(runs), "run").select("bucket", (F.col("base") + within).alias("start"))


def scatter(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """row (all columns of `docs`), key and bucket: buckets of about `bucket_bytes` of text by a seeded hash of the row.

    Rows that repeat others in all columns hash by their places too, so that no bucket gets all of them.
    """
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + ROW_BYTES
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _identity(docs, seed).alias("key"), size.alias("size"))
    keys = cut(rows.groupBy("key").agg(F.count("*").alias("copies"), F.sum("size").alias("size")))
    total, repeats = keys.agg(F.sum("size"), F.count_if(F.col("copies") > 1)).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    salt = F.lit(0).cast("long")
    if repeats:
        known = beside(keys.where("copies > 1").select("key", F.lit(True).alias("repeats")), repeats)
        rows = rows.withColumn("place", F.monotonically_increasing_id()).join(known, "key", "left")
        salt = F.when(F.col("repeats"), F.col("place")).otherwise(0)
    return rows.select("row", "key", F.pmod(F.xxhash64(F.lit(seed), "key", salt), F.lit(buckets)).alias("bucket"))


def shuffle_shards(docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, folder: str | None = None, text: str = "text") -> DataFrame:
    """All columns of `docs` with `shard` (from 0) and `slot` (from 0 without gaps in each shard), in shuffled order.

    First pass: rows scatter uniformly into buckets of about `bucket_bytes`.
    Second pass: each bucket is put in the order of its rows' hashes,
    Fisher-Yates shuffled with a generator seeded by `seed` and the bucket, and
    written to `folder` (else a scratch folder that all executors share). The
    buckets one after the other make the shuffled whole, which is cut into
    shards whose counts differ by one at most. Equal rows, seeds and bucket
    sizes give equal shards however the rows are dealt to files; rows that
    repeat others in all columns may change places with each other, and shift
    what follows them. Null and empty texts are rows like others; a text longer
    than a bucket is shuffled as one record; ties need no rule, as places are
    drawn; an empty table gives an empty one. Columns of `docs` that are named
    shard or slot are replaced, others may have any name.
    """
    spark, docs = docs.sparkSession, docs.drop("shard", "slot")
    kind = StructType().add("bucket", "long").add("at", "long").add("row", docs.schema)

    def fisher_yates(key: tuple[Any, ...], rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        order = pc.sort_indices(rows, sort_keys=[("key", "ascending")]).to_numpy()
        order = order[np.random.default_rng([seed, bucket]).permutation(len(order))]  # numpy's is a Fisher-Yates shuffle
        at = np.arange(len(order))
        return pa.table([pa.array(np.full(len(order), bucket)), pa.array(at), rows.column("row").take(pa.array(order))], ["bucket", "at", "row"])

    folder = folder or scratch(spark, "shards")
    scatter(docs, seed, bucket_bytes, text).groupBy("bucket").applyInArrow(fisher_yates, kind).write.parquet(folder)
    written = spark.read.schema(kind).parquet(folder)
    starts = cut(_starts(written.groupBy("bucket").agg(F.count("*").alias("n"))))
    rows, buckets = written.agg(F.count("*")).first()[0], starts.count()
    place = F.col("start") + F.col("at")
    placed = written.join(beside(starts, buckets), "bucket").select("row", place.alias("place"))
    placed = placed.withColumn("shard", F.expr(f"cast(place * {shards} div {max(rows, 1)}L as int)"))
    return placed.select("row.*", "shard", F.expr(f"place - (shard * {rows}L + {shards - 1}) div {shards}").alias("slot"))


def write_shards(docs: DataFrame, target: str, **how) -> None:
    """Write `docs` as Parquet under `target`, one folder shard=k for each shard; slot numbers the rows. Edge cases: as in shuffle_shards."""
    shuffle_shards(docs, **how).write.partitionBy("shard").parquet(target)

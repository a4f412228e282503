"""Running numbers and sums over a whole table in a given order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 4096


def running(rows: DataFrame, keys: list[str], sums: dict[str, Column] | None = None, parts: int = 256) -> DataFrame:
    """Adds `number` (from 1, in the order of `keys`) and running sums; equal keys in the order of the rows' hashes.

    Rows are cut into at most `parts` ranges of keys and hash, at values of a
    bounded hash sample of the rows, so that a frequent key is cut too; numbers
    run within a range and start at what the ranges before it hold. Nulls come
    first.
    """
    plain = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and kind != "variant"]
    place = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.xxhash64(*plain).alias("tie"))
    kinds = rows.select(place.alias("p")).schema["p"].dataType
    sample = rows.select(place.alias("p"), F.xxhash64(F.lit(1), *plain).alias("drawn")).orderBy("drawn").limit(SAMPLE).agg(F.sort_array(F.collect_list("p")).alias("ps")).first()["ps"]
    bounds = list(dict.fromkeys(sample[len(sample) * i // parts] for i in range(1, parts))) if sample else []
    literals = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, kinds.fields, strict=True))) for b in bounds]
    # a binary search over the bounds: one comparison for each halving
    held, ranged, step = F.array(*literals), rows.withColumns({"_place": place, "_range": F.lit(0)}), 1 << len(bounds).bit_length() >> 1
    while step:
        ranged = ranged.withColumn("_range", F.col("_range") + F.when(F.get(held, F.col("_range") + (step - 1)) <= F.col("_place"), step).otherwise(0))
        step >>= 1
    sums = {"number": F.lit(1)} | (sums or {})
    totals = ranged.groupBy("_range").agg(*(F.sum(v).alias(f"_{k}") for k, v in sums.items()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most parts rows
    starts = totals.select("_range", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    within = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(starts), "_range")
    return out.withColumns({k: (F.col(f"_{k}") + F.sum(v).over(within)).cast("long") for k, v in sums.items()}).drop("_range", "_place", *(f"_{k}" for k in sums))

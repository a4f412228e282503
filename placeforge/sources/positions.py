"""Scans that resume at a place in pinned Parquet files, with budgets of files, rows, results and bytes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeforge.operators.order import running


@dataclass(frozen=True)
class Position:
    """The next row to scan: file number in the order of the paths (from 0), row in it (from 0)."""

    file: int = 0
    row: int = 0


@dataclass(frozen=True)
class Page:
    """Rows of one page (with `ordinal`, their place in the scan), how many were scanned for them, and where the next page starts."""

    rows: DataFrame
    scanned: int
    next: Position
    complete: bool


def located(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows of the Parquet files below `paths`, with their file and their number in it as Spark's scan knows them."""
    return spark.read.schema(schema).parquet(*paths).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def pinned(rows: DataFrame) -> DataFrame:
    """file, n (rows), number (from 1 by path) and rows_to (rows of the files up to it); only footers are read."""
    return running(rows.groupBy("file").agg(F.count("*").alias("n")), ["file"], {"rows_to": F.col("n")})


def files_digest(files: DataFrame) -> str:
    """A digest of the pinned files and their sizes, by which a cursor knows its release; files as `pinned` gives them."""
    line = F.sha2(F.concat_ws("\t", "number", "file", "n"), 256)
    parts = [F.sum(F.conv(F.substring(line, k, 14), 16, 10).cast("decimal(38,0)")).cast("string") for k in (1, 15)]
    return files.agg(F.sha2(F.concat_ws(":", F.count("*").cast("string"), *parts), 256)).first()[0]


def scan_page(rows: DataFrame, files: DataFrame, at: Position, wanted: Column, size: Column, most_files: int = 1, most_rows: int = 1_250_000, limit: int = 5000, most_bytes: int = 1 << 27) -> Page:
    """The page that starts at `at`: of the next `most_rows` rows of at most `most_files` files the wanted ones, up to `limit` rows and `most_bytes`.

    The filter on the file prunes the scan to the page's files before any is
    opened. A page ends behind its last row if a result limit ended it, else
    behind what was scanned; after the last file it is complete and the next one
    starts anew. A first row larger than `most_bytes` is an error.
    """
    near = files.where(F.col("number").between(at.file + 1, at.file + most_files)).orderBy("number").collect()  # at most most_files
    total = files.agg(F.max("number"), F.max("rows_to")).first()
    if not near or not 0 <= at.row <= near[0]["n"]:
        raise ValueError("the position lies outside the pinned files")
    base = near[0]["rows_to"] - near[0]["n"] + at.row
    before = F.create_map(*(F.lit(x) for f in near for x in (f["file"], f["rows_to"] - f["n"] - base)))
    here = rows.where(F.col("file").isin(*(f["file"] for f in near))).withColumn("ordinal", before[F.col("file")] + F.col("row"))
    found = here.where(F.col("ordinal").between(0, most_rows - 1) & F.coalesce(wanted, F.lit(False))).withColumn("size", size).orderBy("ordinal").limit(limit)
    in_order = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)  # at most `limit` rows
    found = found.withColumn("bytes_so_far", F.sum("size").over(in_order))
    page = found.where(F.col("bytes_so_far") <= most_bytes).drop("size")
    fits = F.col("bytes_so_far") <= most_bytes
    n, kept, last = found.agg(F.count("*"), F.count_if(fits), F.max(F.when(fits, F.col("ordinal")))).first()
    if n and not kept:
        raise ValueError("a row is larger than the page's bytes")
    scanned = last + 1 if kept < n or n == limit else min(most_rows, near[-1]["rows_to"] - base)
    end = base + scanned
    if end == total[1]:
        return Page(page, scanned, Position(), True)
    file = next((f for f in near if end < f["rows_to"]), None)
    return Page(page, scanned, Position(file["number"] - 1, end - (file["rows_to"] - file["n"])) if file else Position(near[-1]["number"], 0), False)

"""Snapshot pages, record counts, spider choice and report writers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.operators.order import running

# fixed values: limits of a snapshot page and its cursor, and names of arrays that wrap records
PAGE_ROWS, ROW_BYTES, CURSOR_BYTES = (1, 5000), (1, 1_048_576), 4096
WRAPPERS = ("records", "rows", "places", "features")


def bad_cursors(rows: DataFrame, cursor: str) -> DataFrame:
    """Cursor values that are null, blank, too long, or stand more than once."""
    c = F.col(cursor)
    return rows.groupBy(c.alias("cursor")).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("cursor").isNull() | (F.col("cursor") == "") | (F.octet_length("cursor") > CURSOR_BYTES))


def snapshot_page(rows: DataFrame, cursor: str, columns: list[str], after: str | None = None, page_rows: int = 500, row_bytes: int = 65_536, page_bytes: int = 1 << 24) -> DataFrame:
    """The next page in byte order of the cursor: cursor, payload (JSON), its bytes, and the running bytes with one more for each row.

    A payload is null where the row's texts are over `row_bytes`, or where the
    bytes so far pass `page_bytes`: such a page is to fail, never to be cut.
    """
    if not PAGE_ROWS[0] <= page_rows <= PAGE_ROWS[1] or not ROW_BYTES[0] <= row_bytes <= ROW_BYTES[1]:
        raise ValueError("page or row limit out of range")
    page = (rows if after is None else rows.where(F.col(cursor) > after)).orderBy(cursor).limit(page_rows)
    texts = [c for c, kind in rows.select(*columns).dtypes if kind == "string"]
    raw = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    payload = F.when(raw <= row_bytes, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    sized = page.select(F.col(cursor).alias("cursor"), payload.alias("payload")).withColumn("payload_bytes", F.coalesce(F.octet_length("payload"), F.lit(row_bytes + 1)))
    out = running(sized, ["cursor"], {"bytes_so_far": F.col("payload_bytes") + 1}).drop("number")
    fits = (F.col("bytes_so_far") <= page_bytes) & (F.col("payload_bytes") <= row_bytes)
    return out.withColumn("payload", F.when(fits, F.col("payload")))


def whole_page(page: DataFrame) -> DataFrame:
    """The page, or an error if a payload is missing."""
    return page.withColumn("payload", F.when(F.col("payload").isNull(), F.raise_error(F.lit("the snapshot page is over its byte limits"))).otherwise(F.col("payload")))


def record_count(text: Column) -> Column:
    """Records of a JSON value: an array's length, null 0, the length of its one wrapped array, else 1; two wrapped arrays are an error."""
    value = F.try_parse_json(text)
    kind = F.schema_of_variant(value)
    size = lambda path: F.size(F.try_variant_get(value, path, "array<variant>"))
    is_array = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(value, path, "variant")).startswith("ARRAY"), F.lit(False))
    found = sum((is_array(f"$.{w}").cast("int") for w in WRAPPERS), F.lit(0))
    wrapped = F.lit(1)
    for w in reversed(WRAPPERS):
        wrapped = F.when(is_array(f"$.{w}"), size(f"$.{w}")).otherwise(wrapped)
    one = F.when(found > 1, F.raise_error(F.lit("several recognised record arrays")).cast("int")).otherwise(wrapped)
    return F.when(text.isNull() | F.coalesce(kind == "VOID", F.lit(False)), 0).when(kind.startswith("ARRAY"), size("$")).when(kind.startswith("OBJECT"), one).otherwise(1)


def spiders(manifest: DataFrame, turn: int, n: int, group: str | None = None) -> DataFrame:
    """Of the enabled spiders (of a group) the next `n` from `turn` on, round robin in the order of their names."""
    rows = manifest.where("import_enabled")
    rows = rows if group is None else rows.where(F.col("group") == group)
    total = rows.agg(F.count("*").alias("total"))
    placed = running(rows, ["spider"]).crossJoin(F.broadcast(total))  # one row
    return placed.where(F.pmod(F.col("number") - 1 - turn, F.col("total")) < n).withColumn("turn", F.pmod(F.col("number") - 1 - turn, F.col("total"))).drop("total", "number")


def preflight(manifest: DataFrame, stats: DataFrame) -> DataFrame:
    """Enabled spiders with the counts of their last run and whether it is missing, empty, with warnings, or ok; stats: spider, features, warnings."""
    rows = manifest.where("import_enabled").join(stats, "spider", "left")
    state = F.when(F.col("features").isNull(), "missing").when(F.col("features") == 0, "empty").when(F.col("warnings") > 0, "warning").otherwise("ok")
    return rows.select("spider", "features", "warnings", state.alias("preflight"))


def tile_status(pages: DataFrame, limit: int) -> DataFrame:
    """Each tile's last release, rows, and whether its page ran over the limit (partial) or not (success)."""
    return pages.groupBy("tile").agg(F.max("release").alias("release"), F.count("*").alias("n")).withColumn("status", F.when(F.col("n") > limit, "partial").otherwise("success"))


def csv_lines(rows: DataFrame, columns: list[str], header: bool = True) -> DataFrame:
    """One text line for each row (and a first header line): quotes only where a value holds a quote, comma or line end."""
    quoted = lambda c: F.when(c.rlike(r'[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    lines = rows.select(F.concat_ws(",", *(quoted(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)).alias("line"))
    if not header:
        return lines
    return rows.sparkSession.createDataFrame([(",".join(columns),)], "line string").unionByName(lines)


def markdown_table(headers: list[str], rows: list[dict]) -> str:
    """A bounded report as a Markdown table; pipes are escaped and line ends become spaces."""
    if not rows:
        return "_none_"
    cell = lambda v: ("" if v is None else str(v)).replace("|", "\\|").replace("\n", " ")
    return "\n".join([f"| {' | '.join(headers)} |", f"| {' | '.join('---' for _ in headers)} |", *(f"| {' | '.join(cell(r.get(h)) for h in headers)} |" for r in rows)])


def json_report(payload: dict) -> str:
    """A bounded report as JSON text."""
    return json.dumps(payload, indent=2, ensure_ascii=False, default=str) + "\n"

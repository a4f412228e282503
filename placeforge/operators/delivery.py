"""Pages of an ordered delivery with the digests of all prefixes in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.runtime import cut
from placeforge.operators.order import running

MOST = 10_000  # rows of a page


def delivery_pages(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Page (from 0), start, end, page_id, prefix and last: the pages of `rows` in the order of `keys`.

    page_id digests a page's rows in order. prefix digests all rows up to the
    page's end: each row's digest, bound to its number, is summed by page, the
    sums run on over the pages, and count and sums are hashed, so that all
    prefixes take one pass. The pages are kept in the checkpoint folder, so that
    the rows are not read again to number them. Keys are to be unique.
    """
    if not 1 <= limit <= MOST:
        raise ValueError("invalid delivery limit")
    line = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"}), 256)
    numbered = running(rows.withColumn("_line", line).select(*keys, F.col("_line").alias("line")), keys)
    bound = F.sha2(F.concat_ws(":", "number", "line"), 256)
    part = lambda k: F.sum(F.conv(F.substring(bound, k, 7), 16, 10).cast("long"))
    in_order = F.sort_array(F.collect_list(F.struct("number", "line")))  # at most `limit` rows
    pages = numbered.groupBy(F.floor((F.col("number") - 1) / limit).alias("page")).agg(
        F.count("*").alias("n"), F.sha2(F.array_join(F.transform(in_order, lambda x: x["line"]), ""), 256).alias("page_id"), part(1).alias("a"), part(8).alias("b"),
    )
    pages = running(cut(pages), ["page"], {"end": F.col("n"), "a_to": F.col("a"), "b_to": F.col("b")})
    count = pages.agg(F.count("*").alias("pages"))
    out = pages.crossJoin(F.broadcast(count))  # one row
    return out.select("page", (F.col("end") - F.col("n")).alias("start"), "end", "page_id", F.sha2(F.concat_ws(":", "end", "a_to", "b_to"), 256).alias("prefix"), (F.col("number") == F.col("pages")).alias("last"))


def next_page(pages: DataFrame, state: dict) -> dict:
    """T4: the state with its pending page: the one that waits for its acknowledgement, else the next one; none behind the last.

    state: offset, prefix (null at 0), pending. What was delivered before must
    still have the same prefix digest, else it is an error.
    """
    if state["offset"]:
        ended = pages.where(F.col("end") == state["offset"]).first()
        if ended is None or ended["prefix"] != state["prefix"]:
            raise ValueError("the delivered rows have changed")
    if state.get("pending"):
        return state
    row = pages.where(F.col("start") == state["offset"]).first()
    return state | {"pending": row and row.asDict()}


def acknowledged(state: dict, page_id: str) -> dict:
    """The state once the pending page is delivered; another page is an error."""
    page = state.get("pending")
    if not page or page["page_id"] != page_id:
        raise ValueError("the acknowledgement is of another page")
    return {"offset": page["end"], "prefix": page["prefix"], "complete": page["last"], "pending": None}

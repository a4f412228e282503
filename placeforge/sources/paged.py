"""Record sources that are asked by pages of ids (S11): discovery checks, a batch data source with one partition a page, missing ids."""

from __future__ import annotations

import json
from collections.abc import Iterator
from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from placeforge.operators.order import running

# fixed values: ids of a source and of a page at most
MOST_IDS, PAGE_IDS = 250_000, 250


def discovered(ids: DataFrame, column: str, most: int = MOST_IDS, page: int = PAGE_IDS) -> DataFrame:
    """Id, copies, refused and page: each distinct id with why it is refused (missing, negative, duplicate), sound ones with their page by rank.

    More than `most` rows are an error of the job: such an answer breaks the
    source's contract as a whole.
    """
    counted = ids.groupBy(F.col(column).cast("long").alias("id")).agg(F.count("*").alias("copies"))
    total = ids.agg(F.count("*").alias("_total"))  # one row
    error = F.raise_error(F.lit(f"more than {most} ids")).cast("boolean")
    counted = counted.crossJoin(F.broadcast(total)).where(F.when(F.col("_total") > most, error).otherwise(F.lit(True))).drop("_total")
    refused = F.when(F.col("id").isNull(), "missing").when(F.col("id") < 0, "negative").when(F.col("copies") > 1, "duplicate")
    judged = counted.withColumn("refused", refused)
    sound = running(judged.where("refused is null"), ["id"]).withColumn("page", F.floor((F.col("number") - 1) / page)).drop("number")
    return sound.unionByName(judged.where("refused is not null").withColumn("page", F.lit(None).cast("long")))


def page_report(asked: DataFrame, returned: DataFrame) -> DataFrame:
    """Page, requested, first_id, last_id, returned, missing and unrequested ids; asked: id, page; returned: id."""
    got = returned.groupBy("id").agg(F.count("*").alias("n"))
    rows = asked.join(got, "id", "left")
    return rows.groupBy("page").agg(F.count("*").alias("requested"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("n").alias("returned"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("repeated"))


class IdPages(DataSource):
    """Format id_pages: options columns (a schema: the fields that are let through), id (the one that names a record), ids (a JSON array), fetch ("module:function").

    fetch(ids) gives the records of a page as dicts. Each page is one task, so a
    page that fails is asked again alone. Ids are checked before any page is
    asked: whole numbers from 0 on, distinct, at most MOST_IDS.
    """

    @classmethod
    def name(cls) -> str:
        return "id_pages"

    def schema(self) -> str:
        return f"{self.options['columns']}, page int"

    def reader(self, schema) -> PageFetcher:
        return PageFetcher(self.options, [f.name for f in schema.fields][:-1])


class IdPage(InputPartition):
    def __init__(self, number: int, ids: list[int]):
        super().__init__(number)
        self.number, self.ids = number, ids


class PageFetcher(DataSourceReader):
    def __init__(self, options, fields: list[str]):
        self.ids, self.id, self.fetch, self.fields = json.loads(options["ids"]), options["id"], options["fetch"], fields

    def partitions(self) -> list[IdPage]:
        ids = self.ids
        if len(ids) > MOST_IDS or any(type(i) is not int or i < 0 for i in ids) or len(set(ids)) < len(ids):
            raise ValueError("invalid, repeated or too many ids")
        ids = sorted(ids)
        return [IdPage(k, ids[at : at + PAGE_IDS]) for k, at in enumerate(range(0, len(ids), PAGE_IDS))] or [IdPage(0, [])]

    def read(self, page: IdPage) -> Iterator[tuple]:
        if not page.ids:
            return
        module, function = self.fetch.split(":")
        records = getattr(import_module(module), function)(page.ids)
        found = [r.get(self.id) for r in records]
        if len(set(found)) < len(found) or not set(found) <= set(page.ids):
            raise ValueError("the page holds records that were not asked for, or twice")
        for record in records:
            yield (*(record.get(f) for f in self.fields), page.number)

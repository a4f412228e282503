"""Municipal permits and plan cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions import text
from placeforge.operators import rules


def _head(address: Column) -> Column:
    return F.element_at(F.split(address, ","), 1)


def map_permits(raw: DataFrame) -> DataFrame:
    """Permit rows as projects; rows without id or address are not mapped (their source_id is null)."""
    c = F.col
    cost, units = text.number_prefix(c("cost")), text.number_prefix(c("num_units"), integer=True)
    use = F.when((F.coalesce(c("proposed_use_type"), F.lit("")) != "") & (F.lower("proposed_use_type") != "unknown"), F.concat(F.lit(" - "), c("proposed_use_type"))).otherwise("")
    title = F.substring(F.concat(F.coalesce(c("permit_type"), F.lit("Development")), use, F.lit(" at "), _head(c("address"))), 1, 500)
    return raw.select(
        "object_id", F.when((c("record_id") != "") & (c("address") != ""), c("record_id")).alias("source_id"), title.alias("title"), "address", F.lit("DETROIT").alias("city"),
        rules.detroit_category(c("proposed_use_type"), c("use_group")).alias("category"), rules.detroit_scale(c("permit_type"), cost, units).alias("scale"),
        F.when(c("issued"), "APPROVED").otherwise("PROPOSED").alias("phase"), cost.alias("estimated_cost"), units.alias("num_units"), "latitude", text.address_hash(c("address")).alias("address_hash"),
    )


def map_plan_cases(raw: DataFrame) -> DataFrame:
    """Plan cases as projects."""
    c = F.col
    kind, cls, status = F.coalesce(c("type"), F.lit("Planning Case")), F.coalesce(c("class"), F.lit("N/A")), F.lower(F.coalesce(c("status"), F.lit("")))
    phase = F.when(text.any_contains(status, ("approved", "complete", "paid")), "APPROVED").when(text.any_contains(status, ("denied", "withdrawn")), "CANCELLED").when(c("completeyear").isNotNull(), "COMPLETED").otherwise("PROPOSED")
    return raw.select(
        F.when((c("plannumber") != "") & (c("address") != ""), c("plannumber")).alias("source_id"), F.substring(F.concat(kind, F.lit(": "), _head(c("address"))), 1, 500).alias("title"),
        F.concat(kind, F.lit(": "), cls).alias("description"), F.lit("ANN_ARBOR").alias("city"), rules.ann_arbor_category(c("type"), c("class")).alias("category"),
        rules.ann_arbor_scale(c("type"), c("class")).alias("scale"), phase.alias("phase"), text.address_hash(c("address")).alias("address_hash"),
    )


def quarantine(mapped: DataFrame) -> DataFrame:
    """Adds `reason`: null for valid rows, else why the row is set aside."""
    c = F.col
    valid = (F.length(F.trim("title")) > 0) & (F.length("title") <= 500) & (F.length(F.trim("address")) > 0) & (c("latitude").isNull() | (F.abs("latitude") <= 90)) & (c("num_units").isNull() | c("num_units").between(-(1 << 31), (1 << 31) - 1))
    return mapped.withColumn("reason", F.when(c("source_id").isNull() | (F.trim("source_id") == ""), "identity_missing").when(~F.coalesce(valid, F.lit(False)), "mapped_contract_invalid"))

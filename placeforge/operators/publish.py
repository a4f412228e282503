"""Publication: identity guard, payload diffs, paging and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.functions import geo

OVERWRITE = ("style", "price_range")
MIRROR = ("phone", "name")


def plain(x: Column) -> Column:
    return F.trim(x.cast("string"))


def identity(local, public) -> Column:
    """ok, ok_legacy, or why two rows of one id are not the same place; arguments map a field to a Column."""
    blank = F.lit("")
    a, b = F.trim(F.coalesce(local("google_place_id"), blank)), F.trim(F.coalesce(public("google_place_id"), blank))
    metres = geo.haversine(local("lat"), local("lng"), public("lat"), public("lng"), geo.EARTH_IDENTITY_M)
    name = lambda s: F.trim(F.regexp_replace(F.lower(F.coalesce(s("name"), blank)), r"\s+", " "))
    state = lambda s: F.upper(F.trim(F.coalesce(s("state"), blank)))
    agree = (state(local) == "") | (state(public) == "") | (state(local) == state(public))
    legacy = (name(local) != "") & (name(local) == name(public)) & F.coalesce(metres <= 25, F.lit(False)) & agree
    return (
        F.when((a != "") & (b != "") & (a != b), "stable_id_mismatch")
        .when(a == "", "local_stable_id_missing")
        .when((b == "") & legacy, "ok_legacy")
        .when(b == "", "weak_legacy_match")
        .when(metres > 250, "coordinate_conflict")
        .otherwise("ok")
    )


def payload(local: DataFrame, public: DataFrame) -> DataFrame:
    """Per joined id the identity verdict and the changed columns; nulls never clear, but for the lifecycle."""
    p = public.select(*(F.col(c).alias(f"p_{c}") for c in public.columns))
    rows = local.join(p, local.id == p.p_id, "left")
    here, there = (lambda c: F.col(c)), (lambda c: F.col(f"p_{c}"))
    changed = [F.when(F.col(c).isNotNull() & ~plain(F.col(c)).eqNullSafe(plain(F.col(f"p_{c}"))), c) for c in (*OVERWRITE, *MIRROR)]
    changed.append(F.when(~plain(F.col("lifecycle_status")).eqNullSafe(plain(F.col("p_lifecycle_status"))), "lifecycle_status"))
    changed.append(F.when(F.col("p_qa_status").isNull(), "qa_status"))
    verdict = F.when(F.col("p_id").isNull(), "missing").otherwise(identity(here, there))
    return rows.withColumn("verdict", verdict).withColumn("changed", F.array_compact(F.array(*changed))).withColumn("publish", F.col("verdict").startswith("ok") & (F.size("changed") > 0))


def keyset_page(rows: DataFrame, order: list[str], after: tuple | None, size: int) -> DataFrame:
    """The next page behind a key (a tuple comparison), in key order."""
    if after is not None:
        rows = rows.where(F.struct(*order) > F.struct(*(F.lit(a).cast(rows.schema[c].dataType).alias(c) for a, c in zip(after, order, strict=True))))
    return rows.orderBy(*order).limit(size)


def chunked(rows: DataFrame, by: list[str], order: list[str], size: int) -> DataFrame:
    """Chunk numbers of `size` rows within each group."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("chunk", F.floor((number - 1) / size).cast("long"))


def ledger_changes(commands: DataFrame, versions: DataFrame) -> DataFrame:
    """Commands whose version differs from the last one staged for their source id, in object order.

    The first command of an id is held against the ledger, later ones against
    the one before, so A, B, A are three changes. commands: source_id,
    object_id, version; versions: source_id, version.
    """
    order = Window.partitionBy("source_id").orderBy("object_id")
    before = F.lag("version").over(order)
    rows = commands.withColumn("_before", before).withColumn("_rank", F.row_number().over(order))
    rows = rows.join(versions.select("source_id", F.col("version").alias("_ledger")), "source_id", "left")
    last = F.when(F.col("_rank") == 1, F.col("_ledger")).otherwise(F.col("_before"))
    return rows.withColumn("changed", ~F.col("version").eqNullSafe(last)).drop("_before", "_rank", "_ledger")


def readiness(rows: DataFrame, batch: int = 500) -> DataFrame:
    """Of compared rows (payload) how many would be updated, are unchanged, missing or held back, and the batches of the write."""
    missing, update = F.col("verdict") == "missing", F.col("publish")
    held = ~F.col("verdict").startswith("ok") & ~missing
    out = rows.agg(F.count("*").alias("rows"), F.count_if(update).alias("would_update"), F.count_if(missing).alias("missing"), F.count_if(held).alias("held_back"), F.sum(F.when(update, F.size("changed")).otherwise(0)).alias("changed_fields"))
    return out.withColumn("unchanged", F.col("rows") - F.col("would_update") - F.col("missing") - F.col("held_back")).withColumn("batches", F.ceil(F.col("would_update") / batch))


def command_version(contract: Column, transform: Column, policy: Column, mapped_digest: Column) -> Column:
    """The version of a command: sha256 of its contract, transform and policy versions and its mapped digest, as a JSON array."""
    return F.sha2(F.concat(F.lit("["), contract.cast("string"), F.lit(","), transform.cast("string"), F.lit(","), policy.cast("string"), F.lit(',"'), mapped_digest, F.lit('"]')), 256)


# fixed values: columns of which one must be set for a row to be published
SYNC_VALUES = ("style", "price_range", "style_confidence", "lifecycle_status")


def sync_select(rows: DataFrame, ids: list[int] | None = None, reconcile: bool = False, after_id: int = 0, checkpoint: tuple[str, int] | None = None, checkpoint_mode: bool = False, changed_since: str | None = None, only_classified: bool = False, batch: int = 500) -> DataFrame:
    """The next batch to publish: given ids, else the next ids, or in checkpoint mode the next by time and id."""
    ids = list(dict.fromkeys(i for i in ids or [] if i > 0))
    has = lambda names: F.expr(" or ".join(f"{c} is not null" for c in names))
    rows = rows.where(has([c for c in SYNC_VALUES if c in rows.columns]))
    by_time = (checkpoint_mode or checkpoint is not None) and not ids and not reconcile
    if ids:
        rows = rows.where(F.col("id").isin(ids))
    elif by_time:
        rows = rows.where("last_enriched_at is not null")
    else:
        rows = rows.where(F.col("id") > (checkpoint[1] if reconcile and checkpoint else after_id))
    if changed_since is not None:
        rows = rows.where(F.col("last_enriched_at") >= F.lit(changed_since).cast("timestamp"))
    if only_classified:
        rows = rows.where(has([c for c in SYNC_VALUES[:3] if c in rows.columns]))
    order = ["last_enriched_at", "id"] if by_time else ["id"]
    return keyset_page(rows, order, checkpoint if by_time else None, max(batch, len(ids)))

"""Projection, scope, refresh, model-output and quality rules."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from placeforge.functions import text
from placeforge.operators import constraints, rules
from placeforge.operators.order import running

# fixed values: flags that keep a row out, price bands, styles' evidence, dispositions of promoted fields
REMOVAL_FLAGS = ("delete", "doesntexist", "inappropriate", "privatevenue")
PRICES = ("$", "$$", "$$$", "$$$$")
DISPOSITIONS = (
    ("website_url", "contact", "auto_fill_if_blank"), ("phone", "contact", "auto_fill_if_blank"), ("menu_url", "contact", "evidence_only"), ("email", "contact", "evidence_only"),
    ("instagram_url", "social", "evidence_only"), ("facebook_url", "social", "evidence_only"), ("twitter_url", "social", "evidence_only"), ("whatsapp", "social", "evidence_only"),
    ("hours", "service", "evidence_only"), ("delivery", "service", "evidence_only"), ("takeaway", "service", "evidence_only"), ("drive_through", "service", "evidence_only"),
    ("outdoor_seating", "service", "evidence_only"), ("indoor_seating", "service", "evidence_only"), ("wheelchair", "service", "evidence_only"),
    ("name", "identity", "manual_review_only"), ("address", "identity", "manual_review_only"), ("lat", "identity", "manual_review_only"), ("lng", "identity", "manual_review_only"), ("state", "identity", "manual_review_only"),
    ("google_place_id", "identity", "manual_review_only"), ("brand", "identity", "manual_review_only"), ("brand_wikidata", "identity", "manual_review_only"), ("operator", "identity", "manual_review_only"), ("operator_wikidata", "identity", "manual_review_only"),
    ("style", "classifier_editorial", "blocked"), ("price", "classifier_editorial", "blocked"), ("price_range", "classifier_editorial", "blocked"), ("style_confidence", "classifier_editorial", "blocked"),
    ("rating", "editorial", "blocked"), ("notes", "editorial", "blocked"), ("status", "editorial", "blocked"), ("lifecycle_status", "lifecycle", "blocked"), ("lifecycle_replaced_by_id", "lifecycle", "blocked"), ("photos", "editorial", "blocked"),
)
# fixed values: the keys under which sources name the fields that fill blanks
SOURCE_KEYS = {"website_url": ("website", "website_url", "contact:website", "url"), "phone": ("phone", "contact:phone", "tel")}


def removal_flagged(flags: Column) -> Column:
    """A removal or privacy flag, whatever its case and signs."""
    return F.exists(flags, lambda f: F.regexp_replace(F.lower(f), "[^a-z]+", "").isin(*REMOVAL_FLAGS))


def host_projection(rows: DataFrame) -> DataFrame:
    """Adds `outcome`: excluded, rejected or projected; texts are trimmed and blanks become null.

    rows: id, name, lat, lng, flags (array) and any bounded texts.
    """
    trimmed = {c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c))) for c, kind in rows.dtypes if kind == "string"}
    rows = rows.withColumns(trimmed)
    valid = F.col("id").isNotNull() & (F.octet_length("id") <= 256) & F.col("name").isNotNull() & (F.octet_length("name") <= 1024) & F.col("lat").between(-90, 90) & F.col("lng").between(-180, 180)
    return rows.withColumn("outcome", F.when(F.coalesce(removal_flagged(F.col("flags")), F.lit(False)), "excluded").when(F.coalesce(valid, F.lit(False)), "projected").otherwise("rejected"))


def projection(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The projected rows with exactly the contract's columns, and an observation of input, projected, excluded and rejected rows.

    The figures come from the pass that reads the rows: take them after an action on the frame.
    """
    flags = F.col("unresolved_flags") if "unresolved_flags" in rows.columns else F.lit(None).cast("array<string>")
    closed = constraints.closed_keys(rows.withColumn("_gone", F.coalesce(removal_flagged(flags), F.lit(False))), (*constraints.RELEASE_V1, constraints.Rule("_gone", "flag")))
    bad = F.size(constraints.violations(constraints.RELEASE_V1)) > 0
    judged = closed.withColumn("_outcome", F.when(F.col("_gone"), "excluded").when(bad, "rejected").otherwise("projected"))
    seen = Observation()
    count = lambda x: F.count_if(F.col("_outcome") == x).alias(x)
    return judged.observe(seen, F.count("*").alias("input"), count("projected"), count("excluded"), count("rejected")).where("_outcome = 'projected'").drop("_outcome", "_gone"), seen


def prepared(rows: DataFrame, steps: list[tuple[str, Column]], most: int | None = None) -> tuple[DataFrame, Observation]:
    """the rows that pass all steps, and an observation of how many pass each and all before it, from the same pass.

    Over `most` rows left is an error of the job (a feed is never cut): the
    count is joined to the rows before any is given out.
    """
    so_far, passed, counters = F.lit(True), [], [F.count("*").alias("input")]
    for name, cond in steps:
        so_far = so_far & F.coalesce(cond, F.lit(False))
        passed.append(so_far)
        counters.append(F.count_if(so_far).alias(name))
    kept_by = passed[-1] if passed else F.lit(True)
    seen = Observation()
    kept = rows.observe(seen, *counters).where(kept_by)
    if most is not None:
        left = rows.where(kept_by).agg(F.count("*").alias("_left"))  # one row
        error = F.raise_error(F.concat(F.lit(f"more than {most} rows are eligible: "), F.col("_left").cast("string"))).cast("boolean")
        kept = kept.crossJoin(F.broadcast(left)).where(F.when(F.col("_left") > most, error).otherwise(F.lit(True))).drop("_left")
    return kept, seen


def cascade(rows: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """one row with how many rows pass each step and all before it."""
    out, so_far = [F.count("*").alias("input")], F.lit(True)
    for name, cond in steps:
        so_far = so_far & F.coalesce(cond, F.lit(False))
        out.append(F.count_if(so_far).alias(name))
    return rows.agg(*out)


def field_dispositions(rows: DataFrame, key: str, fields: Column) -> DataFrame:
    """key, field, grp, disposition, value, action for each known field that a source names; fields: a map of the source's texts.

    A field that fills blanks is looked up under its keys, normalised, and is
    `fill` if valid, else `invalid`; others are kept as `evidence`, go to
    `review`, or are `blocked`. Blank values and unknown fields give no row.
    """
    given = lambda k: F.when(F.trim(fields[k]) != "", F.trim(fields[k]))
    entries = []
    for name, group, disposition in DISPOSITIONS:
        raw = F.coalesce(*(given(k) for k in SOURCE_KEYS.get(name, (name,))))
        if disposition == "auto_fill_if_blank":
            value = text.canonical_website(raw) if name == "website_url" else F.regexp_replace(raw, r"\s+", " ")
            valid = value.isNotNull() if name == "website_url" else text.valid_phone(value)
            action = F.when(valid, "fill").otherwise("invalid")
        else:
            value, action = raw, F.lit({"evidence_only": "evidence", "manual_review_only": "review", "blocked": "blocked"}[disposition])
        entries.append(F.when(raw.isNotNull(), F.struct(F.lit(name).alias("field"), F.lit(group).alias("grp"), F.lit(disposition).alias("disposition"), value.alias("value"), action.alias("action"))))
    return rows.select(key, F.explode(F.array_compact(F.array(*entries))).alias("d")).select(key, "d.*")


def regions(catalog: DataFrame, requested: list[str]) -> DataFrame:
    """configured regions that are asked for, once each, in the order asked."""
    keys = list(dict.fromkeys(k.strip().upper() for k in requested if k and k.strip()))
    asked = catalog.sparkSession.createDataFrame([(k, i) for i, k in enumerate(keys)] or [("", -1)], "key string, turn int")
    return catalog.withColumn("key", F.upper(F.trim("key"))).join(F.broadcast(asked), "key")  # an argument of the call


def deferred(status: Column, next_retry: Column, as_of: Column) -> Column:
    """F8: failed or partial tiles whose next try lies ahead."""
    return F.coalesce(status.isin("failed", "partial") & (next_retry > as_of), F.lit(False))


def public_state(state: Column, aliases: dict[str, str]) -> Column:
    """At most ten characters, longer ones through the aliases; others are errors."""
    s = F.trim(state)
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair)) if aliases else F.create_map().cast("map<string,string>")
    return F.when(F.length(s) <= 10, s).when(state.isNotNull(), F.coalesce(table[F.lower(s)], F.raise_error(F.concat(F.lit("no alias for state "), s)).cast("string")))


def place_identity(source: Column, source_id: Column) -> Column:
    """Namespaced id of an imported place; osm ids lose their own prefix first."""
    return F.when(F.coalesce(source_id, F.lit("")) != "", F.concat(source, F.lit(":"), F.when(source == "osm", F.regexp_replace(source_id, "^osm:", "")).otherwise(source_id)))


# fixed values: names of chains by the report that found them
REPORT_NAMES = {
    "and_pizza-review.json": "&pizza", "bc_pizza-review.json": "B.C. Pizza", "california_pizza_kitchen-review.json": "California Pizza Kitchen", "dominos_pizza_us-review.json": "Domino's Pizza",
    "flippin_pizza_us-review.json": "Flippin' Pizza", "foxs_pizza-review.json": "Fox's Pizza", "grimaldis_pizzeria-review.json": "Grimaldi's Pizzeria", "larosas-review.json": "LaRosa's Pizzeria",
    "little_caesars_us-review.json": "Little Caesars", "marcos-review.json": "Marco's Pizza", "mod_pizza-review.json": "MOD Pizza", "monicals_pizza_us-review.json": "Monical's Pizza",
    "mountain_mikes_us-review.json": "Mountain Mike's Pizza", "papa_johns-review.json": "Papa John's", "papa_murphys-review.json": "Papa Murphy's", "pizza_ranch_us-review.json": "Pizza Ranch",
    "round_table_pizza-review.json": "Round Table Pizza", "sals_pizza_us-review.json": "Sal's Pizza", "simple_simons_pizza_us-review.json": "Simple Simon's Pizza", "vocelli_pizza_us-review.json": "Vocelli Pizza",
}
# fixed values: reports whose chain has several names, by a word of the row's own name
REPORT_VARIANTS = {"pizza_hut_us-review.json": ((("express", "Pizza Hut Express"),), "Pizza Hut"), "mr_gattis_pizza_us-review.json": ((("gattitown", "GattiTown"), ("gattiland", "GattiLand")), "Mr Gatti's Pizza")}


def report_name(source: Column, report: Column, name: Column) -> Column:
    """The name of a new place: spider reports of a chain name it, others keep the row's own."""
    own = F.lower(F.coalesce(name, F.lit("")))
    chain = F.create_map(*(F.lit(x) for pair in REPORT_NAMES.items() for x in pair))[report]
    for file, (words, plain) in REPORT_VARIANTS.items():
        pick = F.lit(plain)
        for word, full in reversed(words):
            pick = F.when(F.contains(own, F.lit(word)), full).otherwise(pick)
        chain = F.when(report == file, pick).otherwise(chain)
    return F.coalesce(F.when(source == "all_the_places", chain), F.nullif(name, F.lit("")))


def model_result(answer: Column, known: Column, sources: list[Column], entity: str = "pizza") -> tuple[Column, Column, Column]:
    """Style (or taco types), price and confidence of a model's answer: the JSON object in it, enums only, and only what the evidence supports.

    known: the evidence text; sources: JSON texts that may name a price. A style
    keeps the model's `confirmed`, else it is inferred; nothing kept, no confidence.
    """
    fields = F.from_json(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), "map<string,string>")
    price = F.when(F.trim(fields["price_range"]).isin(*PRICES), F.trim(fields["price_range"]))
    price = F.when(rules.has_price_evidence(price, *sources), price)
    if entity == "taco":
        parts = F.array_distinct(F.filter(F.transform(F.split(fields["style"], ","), lambda x: F.trim(x)), lambda x: x.isin(*rules.TACO_EVIDENCE) & rules.has_taco_evidence(x, known)))
        kept = F.when(F.size(parts) > 0, F.array_join(parts, ", "))
    else:
        style = rules.normalized_style(fields["style"])
        kept = F.when(rules.has_style_evidence(style, known), style)
    return kept, price, F.when(kept.isNotNull(), F.when(fields["style_confidence"] == "confirmed", "confirmed").otherwise("inferred"))


def override(name: Column, brand: Column) -> tuple[Column, Column, Column]:
    """Style (brand before name), price, and confidence without asking a model; nulls if neither is known."""
    style = F.coalesce(rules.style_from_brand(brand), rules.style_from_name(name, F.lit(""))[0])
    return style, rules.price_from_chain(name), F.when(style.isNotNull(), "confirmed")


# fixed values: the tags and page facts that a model is shown, and their limits
TAG_KEYS = ("amenity", "brand", "brand:wikidata", "cuisine", "name", "operator", "operator:wikidata", "website", "contact:website", "phone", "contact:phone", "addr:city", "addr:state", "addr:country")
_ENTRY = "struct<`@type`:string,name:string,description:string,servesCuisine:string,priceRange:string,telephone:string,url:string,menu:string,address:struct<streetAddress:string,addressLocality:string,addressRegion:string,addressCountry:string>>"
_NOTES = "jsonld string, style_hints string, protein_hints string, price_hint string, menu_url string, text_excerpt string"


def shortened(value: Column, most: int) -> Column:
    """A text of at most `most` characters; what is cut is marked."""
    return F.when(F.length(value) > most, F.concat(F.left(value, F.lit(most)), F.lit("..."))).otherwise(value)


def pruned_tags(tags: Column) -> Column:
    """The known tags of a JSON object that are not blank, shortened, as JSON in their fixed order; null without tags."""
    shown = lambda have: F.to_json(F.struct(*(shortened(F.nullif(have[k], F.lit("")), 300).alias(k) for k in TAG_KEYS)))
    return F.when(tags.isNotNull(), text.bound(F.from_json(tags, "map<string,string>"), shown))


def pruned_notes(notes: Column, entity: str = "pizza") -> Column:
    """Page facts by worth, as JSON of at most 2,500 characters; '' without any.

    Up to three linked-data entries with their telling fields, 15 hints, price
    and menu; the excerpt only where neither entries nor hints (for tacos: no
    hints) speak. Notes that are no JSON are an excerpt.
    """
    fields = [x.split()[0] for x in _NOTES.split(", ")]

    def read(f: Column) -> Column:
        is_json = F.coalesce(F.schema_of_variant(F.try_parse_json(notes)).startswith("OBJECT"), F.lit(False))
        return F.struct(is_json.alias("is_json"), *(F.nullif(f[k], F.lit("")).alias(k) for k in fields))

    def told(f: Column) -> Column:
        field = lambda k: F.when(f["is_json"], f[k])
        listed = F.coalesce(F.from_json(field("jsonld"), f"array<{_ENTRY}>"), F.array(F.from_json(field("jsonld"), _ENTRY)))
        entry = lambda x: F.struct(*((shortened(x[k], 500) if k == "description" else x[k]).alias(k) for k in ("@type", "name", "description", "servesCuisine", "priceRange", "telephone", "url", "menu", "address")))
        hints = lambda k: F.transform(F.slice(F.coalesce(F.from_json(field(k), "array<string>"), F.array(field(k))), 1, 15), lambda x: shortened(x, 120))
        own = "protein_hints" if entity == "taco" else "style_hints"

        def parts(entries: Column) -> Column:
            signal = field(own).isNotNull() if entity == "taco" else (field(own).isNotNull() | F.coalesce(F.size(entries) > 0, F.lit(False)))
            excerpt = F.when(~signal, shortened(F.when(f["is_json"], field("text_excerpt")).otherwise(F.nullif(notes, F.lit(""))), 1200))
            have = [entries.alias("jsonld"), F.when(field("style_hints").isNotNull(), hints("style_hints")).alias("style_hints")]
            have += [F.when(field("protein_hints").isNotNull(), hints("protein_hints")).alias("protein_hints")] if entity == "taco" else []
            return F.to_json(F.struct(*have, shortened(field("price_hint"), 120).alias("price_hint"), shortened(field("menu_url"), 300).alias("menu_url"), excerpt.alias("text_excerpt")))

        return text.bound(F.when(field("jsonld").isNotNull(), F.transform(F.slice(listed, 1, 3), entry)), parts)

    # what is read of the notes is bound, so that JSON is parsed once for all that asks for it
    out = text.bound(text.bound(F.from_json(notes, _NOTES), read), told)
    return text.bound(out, lambda x: F.when(x == "{}", "").otherwise(shortened(F.coalesce(x, F.lit("")), 2500)))


def prompt(place: dict[str, Column], tags: Column, evidence: Column, notes: Column, styles, label: str = "pizza", entity: str = "pizza") -> Column:
    """What a model is asked about a place: the answer's schema, the styles, the place, its tags, accepted evidence and page facts."""
    known = ", ".join(f'"{s}"' for s in styles)
    head = (
        f"Classify a restaurant into the {label} styles. Answer with JSON only: style (one of {known}, or null), price_range ($ to $$$$, or null), style_confidence (confirmed or inferred).\n"
        "Use null if unsure. confirmed: only if a source states the style. Structured data weighs most, then accepted evidence, then hints and excerpts.\n"
    )
    line = lambda k, v: F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit("")), F.lit("\n"))
    return F.concat(F.lit(head), *(line(k, v) for k, v in place.items()), line("tags", pruned_tags(tags)), line("evidence", shortened(evidence, 1800)), line("facts", pruned_notes(notes, entity)))


def feeder_capacity(active: Column, high_water: int = 2, batch: int = 2) -> Column:
    """How many jobs the feeder may add."""
    return F.greatest(F.lit(0), F.least(F.lit(batch), F.lit(high_water) - active))


def region_turn(index: Column, failures: Column, threshold: Column, n: Column) -> Column:
    """The region of a run: the stored one, or the next after `threshold` failures in a row (0: never)."""
    moved = (n > 1) & (threshold > 0) & (failures >= threshold)
    return F.pmod(index + moved.cast("int"), n)


def chosen_regions(state: DataFrame, backlogs: DataFrame) -> DataFrame:
    """Source, region, reason: a rotation that is due comes first, else the largest backlog (ties: the first), else the stored turn.

    state: source, region_index, failures, threshold, pending_rotation, regions
    (their number); backlogs: source, region, backlog (null: unknown).
    """
    turn = region_turn(F.col("region_index"), F.col("failures"), F.col("threshold"), F.col("regions")).cast("long")
    due = F.col("pending_rotation") | ((F.col("regions") > 1) & (F.col("threshold") > 0) & (F.col("failures") >= F.col("threshold")))
    best = backlogs.where("backlog > 0").groupBy("source").agg(F.min(F.struct(-F.col("backlog"), F.col("region").cast("long").alias("region"))).alias("best"))
    rows = state.join(best, "source", "left")
    return rows.select("source", F.when(due, turn).otherwise(F.coalesce("best.region", turn)).alias("region"), F.when(due, "rotated").when(F.col("best").isNotNull(), "backlog").otherwise("stored").alias("reason"))


def within_budget(rows: DataFrame, order: list[str], units: int) -> DataFrame:
    """The first pages, in order, that the work units of a run allow, one unit each."""
    if units < 1:
        raise ValueError("invalid work budget")
    return rows.orderBy(*order).limit(units)


def cached(cache: DataFrame, urls: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Urls with their newest cached row that has not expired; null without one."""
    fresh = cache.where(F.col("fetched_at") > F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS"))
    newest = fresh.groupBy("url").agg(F.max(F.struct("fetched_at", "data")).alias("m")).select("url", "m.*")
    return urls.join(newest, "url", "left")


def import_places(places: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New rows with the next ids, and changes of places that they replace (historical id, replaced by).

    candidates: google_place_id, name; those whose id belongs to an open place
    are left out. Ids follow the largest one in the order of google_place_id.
    """
    old = places.select(F.col("google_place_id"), F.col("id").alias("old_id"), F.coalesce("lifecycle_status", F.lit("")).alias("life"))
    rows = candidates.join(old, "google_place_id", "left").where(F.col("old_id").isNull() | F.col("life").isin("closed", "replaced", "demolished"))
    top = places.agg(F.max("id").alias("top"))
    new = running(rows, ["google_place_id"]).crossJoin(F.broadcast(top)).select((F.col("top") + F.col("number")).alias("id"), "name", "google_place_id", "old_id")
    gone = new.where("old_id is not null").select(F.col("old_id").alias("id"), F.concat(F.lit("historical:"), "google_place_id").alias("google_place_id"), F.lit("replaced").alias("lifecycle_status"), F.col("id").alias("replaced_by"))
    return new.drop("old_id"), gone


class InvalidInput(Exception):
    """What a publisher raises for a batch that holds invalid input; nothing of that batch is then written."""


def published(commands: DataFrame, key: str, publish: Callable[[pd.DataFrame], None], batch: int = 500) -> DataFrame:
    """Key, status, reason, batch and calls: a receipt for each command, however many of a batch are invalid.

    Batches of `batch` commands in the order of `key` go out as they are. One
    that the publisher refuses as invalid is halved until the invalid commands
    stand alone, so a batch with one of them takes about 2 log2(batch) calls;
    any other error fails the task. A task that is tried again sends the same
    commands under the same keys: the publisher is to know them.
    """

    def send(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(key, ignore_index=True)
        status, calls, todo = ["applied"] * len(rows), 0, [(0, len(rows))]
        while todo:
            a, b = todo.pop()
            calls += 1
            try:
                publish(rows.iloc[a:b])
            except InvalidInput:
                if b - a > 1:
                    todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
                else:
                    status[a] = "rejected"
        return pd.DataFrame({key: rows[key], "status": status, "reason": [None if s == "applied" else "database_input_invalid" for s in status], "batch": rows["batch"], "calls": calls})

    rows = running(commands, [key]).withColumn("batch", F.floor((F.col("number") - 1) / batch)).drop("number")
    return rows.groupBy("batch").applyInPandas(send, f"`{key}` {dict(commands.dtypes)[key]}, status string, reason string, batch long, calls long")


def identity_conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """V9: keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def classifier_candidates(places: DataFrame, evidence: DataFrame, entity: str = "pizza", least: float = 0.9) -> DataFrame:
    """places with an id, without style or price, that were scraped, have tags, or have evidence of at least `least`."""
    proven = evidence.where((F.col("entity_type") == entity) & (F.col("match_confidence") >= least)).select(F.col("place_id").alias("id")).distinct().withColumn("proven", F.lit(True))
    rows = places.where("trim(coalesce(google_place_id, '')) <> '' and (style is null or price_range is null)").join(proven, "id", "left")
    return rows.where("scrape_method in ('fetch', 'browser') or osm_tags is not null or proven").drop("proven")


def repaired_confidence(places: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Recently enriched places of map ids with a known style but no confidence, as they are once it is `inferred`."""
    fresh = F.col("last_enriched_at") >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    rows = places.where(fresh & F.col("google_place_id").like("osm:%") & F.col("style").isin(*rules.STYLES) & F.col("style_confidence").isNull())
    return rows.withColumn("style_confidence", F.lit("inferred"))


# fixed values: tables that may be published, by entity, and those that never leave
TARGETS = {"pizza": "pizza_places", "taco": "taco_places"}
LOCAL_ONLY = ("place_sources", "source_review_queue")


def sync_target(table: Column, entity: Column) -> Column:
    """null if rows of the entity may be written to the table, else why not."""
    own = F.create_map(*(F.lit(x) for pair in TARGETS.items() for x in pair))
    return F.when(table.isin(*LOCAL_ONLY), "local_only").when(~table.isin(*TARGETS.values()), "unsupported").when(entity.isNotNull() & ~F.coalesce(own[entity] == table, F.lit(False)), "wrong_entity")


def classification_flags(places: DataFrame, entity: str = "pizza") -> DataFrame:
    """Places with eight quality flags: four are faults, two warnings, two only counted."""
    s, c, p = (F.col(x) for x in ("style", "style_confidence", "price_range"))
    has = lambda x: F.coalesce(x != "", F.lit(False))
    known = rules.evidence_text(F.col("name"), F.col("website_url"), F.col("osm_tags"), F.col("scrape_notes"))
    chain = rules.style_from_name(F.col("name"), F.lit(""))[0] if entity == "pizza" else None
    chain_style = F.when(rules.known_chain(F.col("name")), chain)
    chain_price = rules.price_from_chain(F.col("name"))
    bad = (s.isNotNull() & ~s.isin(*rules.STYLES)) | (p.isNotNull() & ~p.isin(*PRICES)) | (c.isNotNull() & ~c.isin("confirmed", "inferred"))
    mismatch = (has(s) & has(chain_style) & (s != chain_style)) | (has(p) & has(chain_price) & (p != chain_price))
    flags = {
        "invalid_value": bad, "confidence_without_style": ~has(s) & has(c), "style_without_confidence": has(s) & ~has(c), "chain_mismatch": mismatch,
        "confirmed_without_evidence": has(s) & (c == "confirmed") & ~rules.has_style_evidence(s, known), "low_pizza_signal": has(s) & ~rules.has_pizza_signal(known),
        "price_only": ~has(s) & ~has(c) & has(p), "null_output": ~has(s) & ~has(c) & ~has(p),
    }
    return places.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})


def classification_qa(places: DataFrame, by: list[str], entity: str = "pizza") -> DataFrame:
    """By group the flags, totals and the verdict: FAIL with a fault, WARN with a warning, else OK."""
    rows = classification_flags(places, entity)
    names = ("invalid_value", "confidence_without_style", "style_without_confidence", "chain_mismatch", "confirmed_without_evidence", "low_pizza_signal", "price_only", "null_output")
    fault = sum((F.count_if(F.col(x)) for x in names[:4]), F.lit(0))
    warning = sum((F.count_if(F.col(x)) for x in names[4:6]), F.lit(0))
    verdict = F.when(fault > 0, "FAIL").when(warning > 0, "WARN").otherwise("OK")
    return rows.groupBy(*by).agg(F.count("*").alias("inspected"), F.count_if(F.col("style") != "").alias("with_style"), F.count_if(F.col("price_range") != "").alias("with_price"), *(F.count_if(F.col(x)).alias(x) for x in names), verdict.alias("verdict"))


def osm_summary(tiles: DataFrame, by: list[str], as_of: str, refresh_hours: int = 720) -> DataFrame:
    """A10: tiles by status, stale successes, and how many the refresh queue holds; tiles: status, completed_at."""
    status = F.coalesce(F.nullif("status", F.lit("")), F.lit("unprocessed"))
    done = lambda x: F.count_if(status == x)
    old = F.unix_millis(F.lit(as_of).cast("timestamp")) - F.unix_millis("completed_at") >= F.lit(refresh_hours * 3600000).cast("long")
    stale = F.count_if((status == "success") & (F.col("completed_at").isNull() | old))
    out = tiles.groupBy(*by).agg(F.count("*").alias("tiles"), done("success").alias("success"), done("failed").alias("failed"), done("partial").alias("partial"), stale.alias("stale"))
    c = F.col
    out = out.withColumn("unprocessed", F.greatest(c("tiles") - c("success") - c("partial") - c("failed"), F.lit(0)))
    return out.withColumn("retryable", c("failed") + c("partial")).withColumn("refresh_queue", c("unprocessed") + c("failed") + c("partial") + c("stale"))


def qa_repairable(flags: dict[str, int]) -> bool:
    """The only hard faults of a quality report are styles without a confidence."""
    return flags.get("style_without_confidence", 0) > 0 and not any(flags.get(k, 0) for k in ("invalid_value", "confidence_without_style", "chain_mismatch"))


def publication_gate(health, quality, repair, readiness, capability, write, check, rounds: int = 3) -> dict:
    """The publication sequence: health, quality with up to `rounds` repairs, readiness, bulk capability, a dry run, the write, health again.

    Each step is a function; quality gives (verdict, flags). The first step that
    fails ends the sequence before anything is written.
    """
    if not health():
        return {"published": False, "stopped_at": "health"}
    verdict, flags = quality()
    repairs = 0
    while verdict == "FAIL" and repairs < rounds and qa_repairable(flags):
        repair()
        repairs += 1
        verdict, flags = quality()
    out = {"published": False, "repairs": repairs}
    if verdict == "FAIL":
        return out | {"stopped_at": "quality"}
    for name, step in (("readiness", readiness), ("capability", capability), ("dry_run", lambda: write(True))):
        if not step():
            return out | {"stopped_at": name}
    write(False)
    return out | {"published": True, "stopped_at": None if check() else "post_health"}

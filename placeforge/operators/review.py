"""Review queue, evidence and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.functions import text

# fixed values: brand rules (id, report file, pattern of the nearest name, metres, pattern of the source name)
BRAND_RULES = (
    ("papa_murphys", "papa_murphys-review.json", r"^Papa Murph", 25, None),
    ("dominos", "dominos_pizza_us-review.json", r"^Domino", 100, None),
    ("dominos_typos", "dominos_pizza_us-review.json", r"^(Domoino|Domiono)'?s?$", 25, r"^Domino's Pizza$"),
    ("california_pizza_kitchen", "california_pizza_kitchen-review.json", r"^Cal+ifornia Pizza Kit?chen", 100, None),
    ("papa_johns", "papa_johns-review.json", r"^Papa Johns$", 25, None),
    ("papa_johns_variants", "papa_johns-review.json", r"^Papa John'?s( Pizza)?$|^Papa Jones$", 25, r"^Papa John's$"),
    ("pizza_hut_variants", "pizza_hut_us-review.json", r"^Pizza Hut( Delivery| Express)?$", 100, r"^Pizza Hut$"),
    ("pizza_hut_express", "pizza_hut_us-review.json", r"^Pizza Hut", 100, r"^Pizza Hut Express$"),
    ("simple_simons", "simple_simons_pizza_us-review.json", r"^Simple Simons Pizza$", 25, None),
    ("foxs_pizza", "foxs_pizza-review.json", r"^Fox", 100, r"Fox"),
    ("and_pizza", "and_pizza-review.json", r"^& ?pizza$", 25, None),
    ("round_table_pizza", "round_table_pizza-review.json", r"^Round Table Pizza", 100, None),
    ("little_caesars", "little_caesars_us-review.json", r"^Little C(aesars?|aesers?|easars?|easers?|esars?|esar'?s|aesar'?s)", 25, None),
    ("larosas", "larosas-review.json", r"^LaRosa['’]?s", 25, None),
    ("mod_pizza", "mod_pizza-review.json", r"^MOD Pizza$", 100, r"^MOD Pizza"),
    ("monicals_pizza", "monicals_pizza_us-review.json", r"^Monical['’]?s( Pizza)?$", 100, r"^Monical['’]?s Pizza"),
    ("marcos_variants", "marcos-review.json", r"^Marco['’]?s( Pizza| Pizaa)?$", 100, r"^Marco['’]?s Pizza$"),
    ("bc_pizza", "bc_pizza-review.json", r"^BC Pizza$", 25, None),
)
# fixed values: source, priority, days of freshness, least confidence
SOURCE_POLICY = (("osm", 100, 30, 0.9), ("fsq_os_places", 80, 180, 0.9), ("all_the_places", 70, 90, 0.9), ("overture_places", 60, 365, 0.85), ("wikidata", 50, 365, 0.85), ("official_website", 110, 30, 0.95))


def filled(x: Column) -> Column:
    return F.coalesce(x.cast("string") != "", F.lit(False))


def signal_count(address: Column, website: Column, phone: Column, lat: Column, lng: Column) -> Column:
    """How many of address, website, phone and a full coordinate pair are there."""
    return sum((s.cast("int") for s in (filled(address), filled(website), filled(phone), filled(lat) & filled(lng))), F.lit(0))


def readiness(rows: DataFrame) -> Column:
    """Class of a review row."""
    c = F.col
    missing = ~filled(c("source_name")) | ~filled(c("source_id")) | ~(filled(c("lat")) & filled(c("lng")))
    return F.when(c("review_kind") != "likely_new", "link_review").when(missing, "missing_required_data").when(c("nearest_distance_m") <= 150, "nearby_canonical_review").otherwise("candidate_ready")


def import_readiness(name: Column, lat: Column, lng: Column, source_id: Column, duplicate_status: Column, has_duplicate: Column, n_nearby: Column) -> Column:
    """What is missing, then duplicates, then neighbours."""
    missing = F.concat_ws("_", F.when(~filled(name), "name"), F.when(lat.isNull(), "lat"), F.when(lng.isNull(), "lng"), F.when(~filled(source_id), "source_id"))
    open_ = has_duplicate & ~F.coalesce(duplicate_status, F.lit("")).isin("closed", "replaced", "demolished")
    return F.when(missing != "", F.concat(F.lit("missing_"), missing)).when(open_, "duplicate_source_id").when(has_duplicate, "replacement_candidate_ready").when(n_nearby > 0, "nearby_canonical_review").otherwise("candidate_ready")


def next_action(accepted: Column, pending: Column, inspected: Column) -> Column:
    """M15."""
    return F.when((accepted > 0) & (inspected > 0), "review_preflight_readiness").when(accepted > 0, "increase_limit_or_check_source_filter").when(pending > 0, "accept_likely_new_candidates_in_admin").otherwise("no_likely_new_candidates")


def brand_rule(report_file: Column, nearest_name: Column, source_name: Column, distance: Column) -> Column:
    """Id of the first brand rule that fits (patterns ignore case)."""
    out = F.lit(None).cast("string")
    for name, report, nearest, metres, source in reversed(BRAND_RULES):
        fits = (report_file == report) & nearest_name.rlike(f"(?i){nearest}") & (distance <= metres)
        out = F.when(fits & source_name.rlike(f"(?i){source}") if source else fits, name).otherwise(out)
    return out


def _letters(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]", "")


def auto_link(
    queue: DataFrame, places: DataFrame, evidence: DataFrame, entity: str = "pizza", exact_identifiers: bool = False, exact_source_id: bool = False, source_identity: bool = False,
    brand_rules: bool = False, include_score_distance: bool = False, least_score: float = 0.98, most_metres: float = 100.0, source: str | None = None,
) -> DataFrame:
    """Pending ambiguous rows of an entity that may be linked to their nearest place, with the first reason that holds.

    Without a mode, name score and distance decide. The exact modes and the
    source identity leave that class out; brand rules do unless it is included.
    Rows whose source id already has evidence are out, in the exact modes only
    if it is of another place. Exact identifiers are address, phone and website,
    all three.
    """
    p = places.select(
        F.col("id").alias("nearest_place_id"), F.col("address").alias("p_address"), F.col("phone").alias("p_phone"), F.col("website_url").alias("p_website"), F.col("google_place_id").alias("p_google"),
        F.col("lifecycle_status").alias("p_life"), F.col("name").alias("p_name"), F.col("brand_wikidata").alias("p_brand"), F.col("osm_tags").alias("p_tags"), F.col("status").alias("p_status"), F.col("rating").alias("p_rating"), F.col("notes").alias("p_notes"),
    )
    rows = queue.where((F.col("status") == "pending") & (F.col("review_kind") == "ambiguous") & (F.col("entity_type") == entity))
    if source or exact_identifiers:
        rows = rows.where(F.col("source") == (source or "all_the_places"))
    key = ["entity_type", "source", "source_id"]
    known = evidence.select(*key, F.col("place_id").alias("e_place"))
    taken = rows.select("id", *key, "nearest_place_id").join(known, key)
    if exact_identifiers or exact_source_id:
        taken = taken.where("e_place <> nearest_place_id")
    rows = rows.join(taken.select("id").distinct(), "id", "left_anti").join(p, "nearest_place_id")
    c = F.col
    phone, own = F.right(F.regexp_replace(F.coalesce(c("phone"), F.lit("")), "[^0-9]", ""), F.lit(10)), F.right(F.regexp_replace(F.coalesce(c("p_phone"), F.lit("")), "[^0-9]", ""), F.lit(10))
    site, own_site = text.url_key(c("website")), text.url_key(c("p_website"))
    near = F.coalesce(c("nearest_distance_m") <= most_metres, F.lit(False))
    spaced = lambda x: F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), "[^a-z0-9]+", " "))
    same = (_letters(c("address")) != "") & (_letters(c("address")) == _letters(c("p_address"))) & (F.length(phone) == 10) & (phone == own) & (site != "") & (site == own_site) & near
    names_agree = spaced(c("source_name")) == spaced(c("p_name"))
    by_id = (c("source") == "osm") & F.coalesce(c("source_id") == c("p_google"), F.lit(False)) & near & (F.coalesce(c("p_life"), F.lit("")) == "") & ((spaced(c("source_name")) == "") | names_agree)
    brand = F.coalesce(c("source_id") == F.nullif(c("p_brand"), F.lit("")), F.lit(False)) | F.coalesce(c("source_id") == F.nullif(F.get_json_object(c("p_tags"), "$['brand:wikidata']"), F.lit("")), F.lit(False))
    latin = lambda x: F.coalesce(x.rlike("[A-Za-z]"), F.lit(False))
    unreviewed = (F.coalesce(c("p_status"), F.lit("unvisited")) == "unvisited") & c("p_rating").isNull() & (F.trim(F.coalesce(c("p_notes"), F.lit(""))) == "")
    identity = (c("source") == "wikidata") & brand & F.coalesce(c("nearest_distance_m") <= 25, F.lit(False)) & unreviewed & ~(latin(c("source_name")) & latin(c("p_name")) & ~names_agree)
    score = F.coalesce((c("nearest_name_score") >= least_score) & near, F.lit(False))
    rule = F.when(c("source") == "all_the_places", brand_rule(c("report_file"), c("nearest_place_name"), c("source_name"), c("nearest_distance_m")))
    scored = include_score_distance or not brand_rules
    modes = [(exact_identifiers, same, "exact_identifiers"), (exact_source_id, by_id, "exact_source_id"), (source_identity, identity, "source_identity"), (scored and not (exact_identifiers or exact_source_id or source_identity), score, "score_distance")]
    eligible, reason = F.lit(False), F.concat(F.lit("brand_rule:"), rule) if brand_rules else F.lit("unknown")
    reason = F.when(score, "score_distance").otherwise(reason) if scored else reason
    for on, cond, name in modes:
        eligible = eligible | cond if on else eligible
    for on, cond, name in reversed(modes[:3]):
        reason = F.when(cond, name).otherwise(reason) if on else reason
    if brand_rules:
        eligible = eligible | rule.isNotNull()
    return rows.where(eligible).withColumn("auto_link_reason", reason)


def linked(rows: DataFrame, reviewer: str, stamp: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of queue rows to be linked the new state, a history row, and an evidence row (guard: only pending rows move)."""
    move = rows.where("status = 'pending' and nearest_place_id is not null")
    when = F.lit(stamp).cast("timestamp")
    state = move.select("id", F.lit("linked").alias("status"), F.lit("linked_existing").alias("decision"), F.col("nearest_place_id").alias("canonical_place_id"))
    history = move.select(F.col("id").alias("queue_id"), F.col("status").alias("previous_status"), F.lit("linked").alias("next_status"), F.col("nearest_place_id").alias("canonical_place_id"), F.lit(reviewer).alias("reviewer"), when.alias("decided_at"))
    proof = move.select("entity_type", F.col("nearest_place_id").alias("place_id"), "source", "source_id", F.col("nearest_name_score").alias("match_confidence"), "auto_link_reason", when.alias("retrieved_at"))
    return state, history, proof


def website_provenance(places: DataFrame, entity: str, as_of: str) -> DataFrame:
    """An evidence row of the official website for each place that has one; `data` holds the scraped facts."""
    facts = ["phone", "menu_url", "email", "hours", "delivery", "takeaway", "scrape_method"]
    data = F.to_json(F.struct(F.col("website_url").alias("website"), *facts), {"ignoreNullFields": "false"})
    return places.where("trim(coalesce(website_url, '')) <> ''").select(
        F.lit(entity).alias("entity_type"), F.col("id").alias("place_id"), F.lit("official_website").alias("source"), F.concat(F.lit("place:"), "id").alias("source_id"), F.col("website_url").alias("source_url"),
        F.lit("first-party-factual-evidence").alias("license"), F.lit("official restaurant website").alias("attribution"), data.alias("data"), F.lit(1.0).alias("match_confidence"),
        F.lit("scraped_first_party").alias("match_method"), F.coalesce("last_enriched_at", F.lit(as_of).cast("timestamp")).alias("retrieved_at"),
    )


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of both sides, one for each key: the new one (of several, the first in `order`) before the old."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    first = Window.partitionBy(*keys).orderBy(F.desc("_new"), *(order or []))
    return both.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank", "_new")


def upsert_pending(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """As upsert, but old rows that are no longer pending stay as they are; keeps the old id and status."""
    values = [c for c in new.columns if c not in keys]
    n = new.select(*keys, *(F.col(v).alias(f"n_{v}") for v in values), F.lit(True).alias("_new"))
    joined = old.withColumn("_old", F.lit(True)).join(n, keys, "full")
    take = F.col("_old").isNull() | (F.col("_new").isNotNull() & (F.col("status") == "pending"))
    out = [F.when(take, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) if c in values else (F.coalesce("status", F.lit("pending")).alias("status") if c == "status" else F.col(c)) for c in old.columns]
    return joined.select(*out)


def promotions(evidence: DataFrame, places: DataFrame, as_of: str, least: float = 0.85, methods=("exact_identifier_nearby", "exact_name_nearby", "strong_spatial_name")) -> DataFrame:
    """Per field and place the first eligible, valid value in the order of source priority, then confidence.

    W6: only blank fields are filled.
    """
    policy = evidence.sparkSession.createDataFrame(list(SOURCE_POLICY), "source string, priority int, days int, minimum double")
    fresh = F.col("retrieved_at") >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.col("days"))
    rows = evidence.join(F.broadcast(policy), "source").where(fresh & F.col("match_method").isin(*methods) & (F.col("match_confidence") >= F.greatest(F.lit(least), F.col("minimum"))))
    rows = rows.join(places.select(F.col("id").alias("place_id"), F.col("website_url").alias("p_website"), F.col("phone").alias("p_phone")), "place_id")
    site = text.canonical_website(F.col("website"))
    digits = F.regexp_replace(F.coalesce("phone", F.lit("")), "[^0-9]", "")
    fields = F.array(
        F.struct(F.lit("website_url").alias("field"), site.alias("value"), F.col("p_website").alias("current")),
        F.struct(F.lit("phone").alias("field"), F.when(text.valid_phone(F.col("phone")), digits).alias("value"), F.col("p_phone").alias("current")),
    )
    rows = rows.select("place_id", "source", "source_id", "evidence_id", "priority", "match_confidence", F.explode(fields).alias("f")).select("*", "f.*").where("value is not null and trim(coalesce(current, '')) = ''")
    best = Window.partitionBy("field", "place_id").orderBy(F.desc("priority"), F.desc_nulls_last("match_confidence"), "evidence_id")
    return rows.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("field", "place_id", "value", "source", "source_id", "match_confidence")


def import_issues(evidence: DataFrame, places: DataFrame, queue: DataFrame, entity: str = "pizza") -> DataFrame:
    """Evidence of reviewed-new imports with its place and the queue row that its data names, and how many of nine checks fail."""
    p = places.select(F.col("id").alias("p_id"), F.col("google_place_id").alias("p_google"), F.col("name").alias("p_name"))
    q = queue.where("review_kind = 'likely_new'").select("entity_type", "source", F.col("source_id").alias("q_source_id"), F.col("id").alias("q_id"), "status", "decision", F.col("canonical_place_id").alias("q_place"))
    e = evidence.where((F.col("entity_type") == entity) & (F.col("match_method") == "reviewed_new_import"))
    e = e.withColumn("named", F.nullif(F.get_json_object("data", "$.review.queue_id"), F.lit("")).cast("long"))
    same_id = (F.col("source") != "osm") | (F.col("source_id") == F.regexp_replace("q_source_id", "^osm:", ""))
    hit = e.select("evidence_id", "entity_type", "source", "source_id", F.col("named").alias("q_id")).join(q, ["entity_type", "source", "q_id"]).where(same_id).select("evidence_id", "q_id", "status", "decision", "q_place")
    rows = e.join(p, e.place_id == p.p_id, "left").join(hit, "evidence_id", "left")
    c = F.col
    differs = lambda a, b: F.coalesce(a != b, F.lit(False))
    checks = [
        c("p_id").isNull(), c("q_id").isNull(), differs(c("p_id"), c("place_id")), differs(c("q_place"), c("place_id")), differs(c("status"), F.lit("linked")), differs(c("decision"), F.lit("imported_new")),
        ~c("p_google").eqNullSafe(F.concat(c("source"), F.lit(":"), c("source_id"))), ~c("p_name").eqNullSafe(F.get_json_object("data", "$.imported_place.name")),
        ~F.get_json_object("data", "$.imported_place.id").cast("int").eqNullSafe(c("place_id").cast("int")),
    ]
    return rows.withColumn("issue_count", sum((x.cast("int") for x in checks), F.lit(0)))


def unproven_links(queue: DataFrame, evidence: DataFrame, entity: str = "pizza") -> DataFrame:
    """Linked reviewed-new rows without an evidence row of their key and place."""
    rows = queue.where((F.col("entity_type") == entity) & F.expr("review_kind = 'likely_new' and status = 'linked' and decision = 'imported_new'"))
    rows = rows.withColumn("e_id", F.when(F.col("source") == "osm", F.regexp_replace("source_id", "^osm:", "")).otherwise(F.col("source_id")))
    e = evidence.select("entity_type", "source", F.col("source_id").alias("e_id"), F.col("place_id").alias("canonical_place_id"))
    return rows.join(e, ["entity_type", "source", "e_id", "canonical_place_id"], "left_anti").select("id", "canonical_place_id", "source", "source_id", "source_name")


def unpublished_imports(places: DataFrame, evidence: DataFrame, queue: DataFrame, public: DataFrame, entity: str = "pizza") -> DataFrame:
    """Classified places that a reviewed-new import made (by evidence or by a queue row) and that the public side lacks; public: id."""
    e = evidence.where((F.col("entity_type") == entity) & (F.col("match_method") == "reviewed_new_import")).select(F.col("place_id").alias("id"))
    q = queue.where((F.col("entity_type") == entity) & F.expr("status in ('accepted', 'linked') and decision = 'imported_new'")).select(F.col("canonical_place_id").alias("id"))
    rows = places.where("last_enriched_at is not null and (style is not null or price_range is not null or style_confidence is not null)")
    return rows.join(e.unionByName(q).distinct(), "id", "left_semi").join(public, "id", "left_anti")


def filled_places(places: DataFrame, promoted: DataFrame, most: int) -> DataFrame:
    """Places whose blank website or phone a promotion fills, the first `most` by id, as they then are; promoted: place_id, field, value."""
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"new_{f}")
    new = promoted.groupBy(F.col("place_id").alias("id")).agg(value("website_url"), value("phone"))
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rows = places.join(new, "id").where((F.col("new_website_url").isNotNull() & blank("website_url")) | (F.col("new_phone").isNotNull() & blank("phone"))).orderBy("id").limit(most)
    fill = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"new_{c}"))
    return rows.withColumns({c: fill(c) for c in ("website_url", "phone")}).drop("new_website_url", "new_phone")


def known_identities(candidates: DataFrame, external: DataFrame, places: DataFrame, entity: str = "pizza") -> DataFrame:
    """Identities of the candidates that exist: external ones as source:id, and legacy ids of places; once each."""
    own = F.when(F.col("source") == "osm", F.regexp_replace(F.trim("source_id"), "^osm:", "")).otherwise(F.trim("source_id"))
    keys = candidates.select(F.trim("source").alias("source"), own.alias("source_id"), "google_place_id").where("source <> '' and source_id <> '' and google_place_id is not null")
    hit = external.where(F.col("entity_type") == entity).select("source", F.col("external_id").alias("source_id")).join(keys, ["source", "source_id"], "left_semi")
    legacy = places.select("google_place_id").join(candidates.select("google_place_id"), "google_place_id", "left_semi")
    return hit.select(F.concat_ws(":", "source", "source_id").alias("identity")).unionByName(legacy.select(F.concat(F.lit("legacy:"), "google_place_id").alias("identity"))).distinct()


def review_rows(decisions: DataFrame) -> DataFrame:
    """Queue rows: ambiguous ones with their best place, likely new ones with the nearest; without id blocked."""
    kind = F.when(F.col("disposition") == "ambiguous_review", "ambiguous").when(F.col("disposition") == "likely_new", "likely_new")
    ambiguous = F.col("disposition") == "ambiguous_review"
    pick = lambda a, b: F.when(ambiguous, F.col(a)).otherwise(F.col(b))
    rows = decisions.select("source", "source_id", kind.alias("review_kind"), pick("best_canonical_place_id", "nearest_place_id").alias("place_id"), pick("best_distance_m", "nearest_distance_m").alias("distance_m"), pick("best_name_score", "nearest_name_score").alias("name_score"))
    return rows.where("review_kind is not null").withColumn("blocked", ~filled(F.col("source_id")))

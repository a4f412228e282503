"""Queries of the review, queue, quality, snapshot and report operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeforge.operators import governance, publish, review, rules
from placeforge.operators import jobs as J
from placeforge.operators import matching as M
from placeforge.operators.order import running
from placeforge.plans import fixtures as X
from placeforge.plans.queries import _BOX, _BRAND, _PAYLOAD, _PLAIN, AS_OF, Q_MATCH, SQL, T, candidates, decisions, payloads, q_digits, q_first, q_letters, q_norm, q_spaced, q_url, query
from placeforge.sources import feeds, snapshots, tiles

_FILTER = lambda cond, name: f"count(*) FILTER (WHERE {cond}) AS {name}"


def q_any(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t.replace(chr(39), chr(39) * 2)}')" for t in terms) + ")"


# ---- matching ------------------------------------------------------------------------------------------------------
_DECIDED = "SELECT count(*) AS decision_rows, " + ", ".join(_FILTER(f"route = '{r}'", f"route_{r}") for r in M.ROUTES) + ", " + ", ".join(
    _FILTER(f"disposition = '{d}'", n) for d, n in (("matched_existing", "matched_existing_places"), ("ambiguous_review", "ambiguous_review_candidates"), ("likely_new", "likely_new_unmatched_candidates"), ("closed_evidence", "closed_signals_matched"), ("closed_evidence_dropped", "closed_evidence_dropped"))
) + ", " + _FILTER("disposition = 'matched_existing' AND route = 'ready_for_match'", "active_matches_with_source_id") + " FROM decided"
_REPORT = Q_MATCH + f""", m AS (SELECT * FROM routed WHERE route IN ('ready_for_match', 'closed_evidence_candidate')),
  boxes AS (SELECT ty, tx, s - 100e0 / 111320e0 AS s, n + 100e0 / 111320e0 AS n, w - 100e0 / (111320e0 * greatest(cos((s + n) / 2e0 * pi() / 180e0), 0.01e0)) AS w, e + 100e0 / (111320e0 * greatest(cos((s + n) / 2e0 * pi() / 180e0), 0.01e0)) AS e FROM (SELECT floor(lat) AS ty, floor(lng) AS tx, min(lat) AS s, max(lat) AS n, min(lng) AS w, max(lng) AS e FROM m GROUP BY 1, 2)),
  fetched AS (SELECT DISTINCT p.canonical_place_id, p.lat, p.lng FROM canonical p JOIN boxes b ON abs(floor(p.lat) - b.ty) <= 1 AND abs(floor(p.lng) - b.tx) <= 1 AND p.lat BETWEEN b.s AND b.n AND p.lng BETWEEN b.w AND b.e)
  SELECT *, (SELECT count(*) FROM candidate) AS candidate_rows, route_ready_for_match AS active_candidates_compared, route_closed_evidence_candidate AS closed_candidates_compared, (SELECT count(*) FROM canonical) AS canonical_snapshot_rows,
   (SELECT count(*) FROM boxes) AS canonical_prefetch_tiles, (SELECT count(*) FROM fetched) AS canonical_rows_prefetched, (SELECT count(*) FROM (SELECT DISTINCT floor(lat / 0.02e0), floor(lng / 0.02e0) FROM fetched)) AS grid_cells_built, CAST(ceil((SELECT count(*) FROM boxes) / 100e0) AS BIGINT) AS canonical_prefetch_queries FROM ({_DECIDED})"""


def report(spark, sf):
    d = decisions(spark, sf)
    return M.full_report(M.route(candidates(spark, sf)), T(spark, sf, "canonical"), d)


@query("M7_match_report", _REPORT)
def _(spark, sf):
    return report(spark, sf)


# a faulty run: every fifth decision is of another kind than its route allows, every seventh has lost its match
_FAULTY = "CASE WHEN id % 5 = 0 THEN 'closed_evidence' ELSE disposition END"


@query("M10_violations", Q_MATCH + f""", f AS (SELECT *, CAST(substr(source_id, 5) AS BIGINT) AS id FROM decided), g AS (SELECT route, {_FAULTY} AS disposition, CASE WHEN id % 7 <> 0 THEN place END AS place, CASE WHEN id % 7 <> 0 THEN method END AS method, nearest_id, nd, d FROM f)
  SELECT route, disposition, count(*) AS n FROM (SELECT *, route IN ('ready_for_match', 'closed_evidence_candidate') AS cmp, coalesce(method IN ('exact_identifier_nearby', 'exact_name_nearby', 'strong_spatial_name'), false) AS acc, coalesce(method IN ('weak_spatial_name', 'spatial_only_review'), false) AS amb, route = 'ready_for_match' AS ready FROM g)
  WHERE (disposition = 'not_compared' AND (cmp OR place IS NOT NULL OR nearest_id IS NOT NULL)) OR (disposition <> 'not_compared' AND NOT cmp) OR (disposition = 'matched_existing' AND NOT (ready AND acc)) OR (disposition = 'ambiguous_review' AND NOT (ready AND amb)) OR (disposition = 'likely_new' AND NOT (ready AND coalesce(method, 'no_match') = 'no_match'))
   OR (disposition = 'closed_evidence' AND NOT (cmp AND NOT ready AND acc)) OR (disposition = 'closed_evidence_dropped' AND (ready OR NOT cmp OR acc)) OR (place IS NULL) <> (nearest_id IS NULL) OR coalesce(nd > d, false) GROUP BY 1, 2""")
def _(spark, sf):
    n = F.substring("source_id", 5, 20).cast("long")
    keep = lambda c: F.when(n % 7 != 0, F.col(c))
    faulty = decisions(spark, sf).withColumn("disposition", F.when(n % 5 == 0, "closed_evidence").otherwise(F.col("disposition"))).withColumns({c: keep(c) for c in ("best_canonical_place_id", "best_match_method")})
    return M.decision_violations(faulty).groupBy("route", "disposition").agg(F.count("*").alias("n"))


@query("J8_unreconciled", X.sql("candidate") + ", d AS (SELECT source_id FROM candidate WHERE c_custkey % 10 <> 3 UNION ALL SELECT source_id FROM candidate WHERE c_custkey % 10 = 4 UNION ALL SELECT 'x' FROM candidate WHERE c_custkey = 1) SELECT coalesce(c.source_id, d.source_id) AS source_id, coalesce(c.n, 0) AS candidates, coalesce(d.n, 0) AS decisions FROM (SELECT source_id, count(*) AS n FROM candidate GROUP BY 1) c FULL JOIN (SELECT source_id, count(*) AS n FROM d GROUP BY 1) d ON c.source_id = d.source_id WHERE coalesce(c.n, 0) <> 1 OR coalesce(d.n, 0) <> 1")
def _(spark, sf):
    c = T(spark, sf, "candidate")
    # a faulty run: decisions that are missing, doubled, or of nobody (the modulo makes the faults, all candidates are read)
    d = c.where("c_custkey % 10 <> 3").unionByName(c.where("c_custkey % 10 = 4")).select("source_id").unionByName(c.where("c_custkey = 1").select(F.lit("x").alias("source_id")))
    return M.reconciled(c, d, ["source_id"])


# ---- review --------------------------------------------------------------------------------------------------------
_AUTO = X.sql("queue", "canonical", "evidence") + f""", r AS (SELECT q.*, p.address AS pa, p.phone AS pp, p.website_url AS pw, p.google_place_id AS pg, p.lifecycle_status AS pl, p.name AS pn, p.brand_wikidata AS pb, p.osm_tags AS pt, p.status AS ps, p.rating AS pr, p.notes AS po, coalesce(q.nearest_distance_m <= 100, false) AS near,
  EXISTS (SELECT 1 FROM evidence e WHERE e.entity_type = q.entity_type AND e.source = q.source AND e.source_id = q.source_id) AS known, EXISTS (SELECT 1 FROM evidence e WHERE e.entity_type = q.entity_type AND e.source = q.source AND e.source_id = q.source_id AND e.place_id <> q.nearest_place_id) AS conflict
  FROM queue q JOIN canonical p ON p.id = q.nearest_place_id WHERE q.status = 'pending' AND q.review_kind = 'ambiguous' AND q.entity_type = 'pizza'),
  f AS (SELECT *, near AND {q_url('website')} <> '' AND {q_url('website')} = {q_url('pw')} AND {q_letters('address')} <> '' AND {q_letters('address')} = {q_letters('pa')} AND length({q_digits('phone')}) = 10 AND {q_digits('phone')} = {q_digits('pp')} AS same,
   source = 'osm' AND coalesce(source_id = pg, false) AND near AND coalesce(pl, '') = '' AND ({q_spaced('source_name')} = '' OR {q_spaced('source_name')} = {q_spaced('pn')}) AS by_id,
   source = 'wikidata' AND (coalesce(source_id = nullif(pb, ''), false) OR coalesce(source_id = nullif(json_extract_string(pt, '$."brand:wikidata"'), ''), false)) AND coalesce(nearest_distance_m <= 25, false) AND coalesce(ps, 'unvisited') = 'unvisited' AND pr IS NULL AND trim(coalesce(po, '')) = ''
    AND NOT (coalesce(regexp_matches(source_name, '[A-Za-z]'), false) AND coalesce(regexp_matches(pn, '[A-Za-z]'), false) AND {q_spaced('source_name')} <> {q_spaced('pn')}) AS identity,
   coalesce(nearest_name_score >= 0.98 AND near, false) AS score, CASE WHEN source = 'all_the_places' THEN {_BRAND} END AS rule FROM r)
  SELECT 'default' AS mode, id, 'score_distance' AS auto_link_reason FROM f WHERE NOT known AND score
  UNION ALL SELECT 'brands', id, 'brand_rule:' || rule FROM f WHERE NOT known AND rule IS NOT NULL
  UNION ALL SELECT 'brands_and_score', id, CASE WHEN score THEN 'score_distance' ELSE 'brand_rule:' || rule END FROM f WHERE NOT known AND (score OR rule IS NOT NULL)
  UNION ALL SELECT 'identifiers', id, 'exact_identifiers' FROM f WHERE NOT conflict AND source = 'all_the_places' AND same
  UNION ALL SELECT 'source_id', id, 'exact_source_id' FROM f WHERE NOT conflict AND by_id
  UNION ALL SELECT 'identity', id, 'source_identity' FROM f WHERE NOT known AND identity"""
_MODES = {"default": {}, "brands": {"brand_rules": True}, "brands_and_score": {"brand_rules": True, "include_score_distance": True}, "identifiers": {"exact_identifiers": True}, "source_id": {"exact_source_id": True}, "identity": {"source_identity": True}}


@query("J7_M12_auto_link", _AUTO)
def _(spark, sf):
    q, p, e = T(spark, sf, "queue", "canonical", "evidence")
    out = None
    for mode, flags in _MODES.items():
        rows = review.auto_link(q, p, e, **flags).select(F.lit(mode).alias("mode"), "id", "auto_link_reason")
        out = rows if out is None else out.unionByName(rows)
    return out


_LINKED = _AUTO.replace("  SELECT 'default' AS mode", "  , auto AS (SELECT 'default' AS mode", 1) + ") "


@query("W4_link_history", _LINKED + "SELECT q.id AS queue_id, q.status AS previous_status, 'linked' AS next_status, q.nearest_place_id AS canonical_place_id FROM auto a JOIN queue q ON q.id = a.id WHERE a.mode = 'default'")
def _(spark, sf):
    q, p, e = T(spark, sf, "queue", "canonical", "evidence")
    _, history, _ = review.linked(review.auto_link(q, p, e), "auto", AS_OF)
    return history.select("queue_id", "previous_status", "next_status", "canonical_place_id")


@query("W4_link_evidence", _LINKED + "SELECT q.entity_type, q.nearest_place_id AS place_id, q.source, q.source_id, q.nearest_name_score AS match_confidence FROM auto a JOIN queue q ON q.id = a.id WHERE a.mode = 'default'")
def _(spark, sf):
    q, p, e = T(spark, sf, "queue", "canonical", "evidence")
    return review.linked(review.auto_link(q, p, e), "auto", AS_OF)[2].select("entity_type", "place_id", "source", "source_id", "match_confidence")


@query("J12_import_issues", X.sql("evidence", "canonical", "queue") + """SELECT e.evidence_id, q.id AS q_id, CAST(p.id IS NULL AS INT) + CAST(q.id IS NULL AS INT) + CAST(coalesce(p.id <> e.place_id, false) AS INT) + CAST(coalesce(q.canonical_place_id <> e.place_id, false) AS INT) + CAST(coalesce(q.status <> 'linked', false) AS INT) + CAST(coalesce(q.decision <> 'imported_new', false) AS INT)
  + CAST(p.google_place_id IS DISTINCT FROM (e.source || ':' || e.source_id) AS INT) + CAST(p.name IS DISTINCT FROM json_extract_string(e.data, '$.imported_place.name') AS INT) + CAST(CAST(json_extract_string(e.data, '$.imported_place.id') AS INT) IS DISTINCT FROM e.place_id AS INT) AS issue_count
  FROM evidence e LEFT JOIN canonical p ON p.id = e.place_id LEFT JOIN queue q ON q.entity_type = e.entity_type AND q.source = e.source AND e.source_id = CASE WHEN q.source = 'osm' THEN regexp_replace(q.source_id, '^osm:', '') ELSE e.source_id END AND q.id = CAST(nullif(json_extract_string(e.data, '$.review.queue_id'), '') AS BIGINT) AND q.review_kind = 'likely_new'
  WHERE e.entity_type = 'pizza' AND e.match_method = 'reviewed_new_import'""")
def _(spark, sf):
    e, p, q = T(spark, sf, "evidence", "canonical", "queue")
    return review.import_issues(e, p, q).select("evidence_id", "q_id", "issue_count")


@query("J12_unproven_links", X.sql("evidence", "queue") + "SELECT q.id, q.canonical_place_id FROM queue q WHERE q.entity_type = 'pizza' AND review_kind = 'likely_new' AND status = 'linked' AND decision = 'imported_new' AND NOT EXISTS (SELECT 1 FROM evidence e WHERE e.entity_type = q.entity_type AND e.source = q.source AND e.source_id = CASE WHEN q.source = 'osm' THEN regexp_replace(q.source_id, '^osm:', '') ELSE q.source_id END AND e.place_id = q.canonical_place_id)")
def _(spark, sf):
    e, q = T(spark, sf, "evidence", "queue")
    return review.unproven_links(q, e).select("id", "canonical_place_id")


# places that no queued row is near to are not published yet
@query("J13_reconcile", X.sql("canonical", "evidence", "queue") + "SELECT DISTINCT p.id, p.last_enriched_at FROM canonical p LEFT JOIN evidence e ON e.entity_type = 'pizza' AND e.place_id = p.id AND e.match_method = 'reviewed_new_import' LEFT JOIN queue q ON q.entity_type = 'pizza' AND q.canonical_place_id = p.id AND q.status IN ('accepted', 'linked') AND q.decision = 'imported_new' WHERE (e.place_id IS NOT NULL OR q.canonical_place_id IS NOT NULL) AND p.last_enriched_at IS NOT NULL AND (p.style IS NOT NULL OR p.price_range IS NOT NULL OR p.style_confidence IS NOT NULL) AND p.id NOT IN (SELECT nearest_place_id FROM queue)")
def _(spark, sf):
    p, e, q = T(spark, sf, "canonical", "evidence", "queue")
    return review.unpublished_imports(p, e, q, q.select(F.col("nearest_place_id").alias("id")).distinct()).select("id", "last_enriched_at")


@query("O9_missing_ids", X.sql("canonical", "queue") + "SELECT c.id FROM canonical c WHERE NOT EXISTS (SELECT 1 FROM queue q WHERE q.nearest_place_id = c.id)")
def _(spark, sf):
    c, q = T(spark, sf, "canonical", "queue")
    return c.select("id").join(q.select(F.col("nearest_place_id").alias("id")), "id", "left_anti")


@query("E17_website_provenance", X.sql("canonical") + """SELECT 'pizza' AS entity_type, id AS place_id, 'place:' || CAST(id AS STRING) AS source_id, website_url AS source_url, coalesce(last_enriched_at, TIMESTAMP '2024-06-01 00:00:00') AS retrieved_at,
  '{"website":"' || website_url || '","phone":"' || phone || '","menu_url":' || coalesce('"' || menu_url || '"', 'null') || ',"email":' || coalesce('"' || email || '"', 'null') || ',"hours":' || coalesce('"' || hours || '"', 'null') || ',"delivery":' || CAST(delivery AS STRING) || ',"takeaway":' || CAST(takeaway AS STRING) || ',"scrape_method":' || coalesce('"' || scrape_method || '"', 'null') || '}' AS data FROM canonical WHERE website_url IS NOT NULL""")
def _(spark, sf):
    return review.website_provenance(T(spark, sf, "canonical"), "pizza", AS_OF).select("entity_type", "place_id", "source_id", "source_url", "retrieved_at", "data")


# ---- quality -------------------------------------------------------------------------------------------------------
_KNOWN = "lower(concat_ws(' ', nullif(name, ''), nullif(website_url, ''), nullif(osm_tags, ''), nullif(scrape_notes, '')))"
_STYLE_LIST = ", ".join(f"'{s}'" for s in rules.STYLES)


def q_style_evidence(style: str, known: str) -> str:
    return f"coalesce({style} IS NULL OR {style} IN ('', 'Other', 'Unknown') OR " + " OR ".join(f"({style} = '{k}' AND {q_any(known, v)})" for k, v in rules.STYLE_EVIDENCE.items()) + ", false)"


def q_price_evidence(price: str, *sources: str) -> str:
    key = "|".join(rules.PRICE_KEYS)
    found = " OR ".join(f"list_contains(regexp_extract_all(coalesce({s}, ''), '(?i)\"(?:{key})\"\\s*:\\s*\"\\s*(\\$+)\\s*\"', 1), {price})" for s in sources)
    return f"coalesce({price} IS NULL OR {price} = '' OR {found}, false)"


# places with chain names, faulty values and thin evidence
_RATED_COLUMNS = {
    "id": "id", "state": "state", "name": "CASE WHEN id % 12 = 0 THEN 'Jet''s Pizza' WHEN id % 12 = 1 THEN 'Cosy Corner' WHEN id % 12 = 2 THEN 'Sbarro' ELSE name END", "website_url": "website_url", "osm_tags": "osm_tags", "scrape_notes": "scrape_notes",
    "style": "CASE WHEN id % 50 = 0 THEN '' ELSE style END", "price_range": "CASE WHEN id % 45 = 0 THEN 'cheap' ELSE price_range END", "style_confidence": "CASE WHEN id % 40 = 0 THEN 'sure' ELSE style_confidence END",
}
_RATED = X.sql("canonical") + f", rated AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _RATED_COLUMNS.items())} FROM canonical) "


def rated(spark, sf):
    return T(spark, sf, "canonical").selectExpr(*(f"{e} AS {c}" for c, e in _RATED_COLUMNS.items()))


_CHAIN = lambda t: q_first(_PLAIN("name"), t)
_ALL_CHAINS = [*dict.fromkeys([*rules.CHAIN_STYLES, *rules.CHAIN_PRICES])]


@query("A7_classification_qa", _RATED + f""", k AS (SELECT *, {_KNOWN} AS known, CASE WHEN {q_any(_PLAIN('name'), _ALL_CHAINS)} THEN coalesce({_CHAIN(rules.CHAIN_STYLES)}, {_CHAIN(rules.STYLE_WORDS)}) END AS cs, {_CHAIN(rules.CHAIN_PRICES)} AS cp, coalesce(style, '') <> '' AS hs, coalesce(style_confidence, '') <> '' AS hc, coalesce(price_range, '') <> '' AS hp FROM rated),
  f AS (SELECT *, coalesce(style NOT IN ({_STYLE_LIST}), false) OR coalesce(price_range NOT IN ('$', '$$', '$$$', '$$$$'), false) OR coalesce(style_confidence NOT IN ('confirmed', 'inferred'), false) AS bad, coalesce(hs AND cs <> '' AND style <> cs, false) OR coalesce(hp AND cp <> '' AND price_range <> cp, false) AS mismatch,
   hs AND style_confidence = 'confirmed' AND NOT {q_style_evidence('style', 'known')} AS thin, hs AND NOT {q_any('known', rules.PIZZA_SIGNALS)} AS low FROM k)
  SELECT coalesce(state, '(null)') AS state, count(*) AS inspected, {_FILTER('hs', 'with_style')}, {_FILTER('hp', 'with_price')}, {_FILTER('bad', 'invalid_value')}, {_FILTER('NOT hs AND hc', 'confidence_without_style')}, {_FILTER('hs AND NOT hc', 'style_without_confidence')}, {_FILTER('mismatch', 'chain_mismatch')}, {_FILTER('thin', 'confirmed_without_evidence')}, {_FILTER('low', 'low_pizza_signal')},
   {_FILTER('NOT hs AND NOT hc AND hp', 'price_only')}, {_FILTER('NOT hs AND NOT hc AND NOT hp', 'null_output')}, CASE WHEN count(*) FILTER (WHERE bad OR (NOT hs AND hc) OR (hs AND NOT hc) OR mismatch) > 0 THEN 'FAIL' WHEN count(*) FILTER (WHERE thin OR low) > 0 THEN 'WARN' ELSE 'OK' END AS verdict FROM f GROUP BY 1""")
def _(spark, sf):
    rows = rated(spark, sf).withColumn("state", F.coalesce("state", F.lit("(null)")))
    return governance.classification_qa(rows, ["state"])


_ANSWER = "CASE id % 5 WHEN 0 THEN 'Sure: {\"style\": \"Standard\", \"price_range\": \" $$ \", \"style_confidence\": \"confirmed\"} done' WHEN 1 THEN '{\"style\": \"Detroit\", \"price_range\": \"cheap\"}' WHEN 2 THEN 'no json' WHEN 3 THEN '{\"style\": \"odd\", \"price_range\": \"$\"}' WHEN 4 THEN '{\"style\": \"New York; Neapolitan\", \"price_range\": \"$\"}' END"
_STYLE_OF = "CASE id % 5 WHEN 0 THEN 'Standard Round' WHEN 1 THEN 'Detroit' WHEN 3 THEN 'Unknown' WHEN 4 THEN 'Neapolitan' END"
_PRICE_OF = "CASE id % 5 WHEN 0 THEN '$$' WHEN 3 THEN '$' WHEN 4 THEN '$' END"


@query("E9_E12_model_results", X.sql("canonical") + f", k AS (SELECT id, osm_tags, scrape_notes, {_KNOWN.replace('nullif(name, ' + chr(39) * 2 + '), ', '')} AS known, {_STYLE_OF} AS st, {_PRICE_OF} AS pr FROM canonical), g AS (SELECT id, CASE WHEN {q_style_evidence('st', 'known')} THEN st END AS style, CASE WHEN {q_price_evidence('pr', 'osm_tags', 'scrape_notes')} THEN pr END AS price FROM k) SELECT id, style, price, CASE WHEN style IS NULL THEN NULL WHEN id % 5 = 0 THEN 'confirmed' ELSE 'inferred' END AS confidence FROM g")
def _(spark, sf):
    known = rules.evidence_text(F.col("website_url"), F.col("osm_tags"), F.col("scrape_notes"))
    style, price, confidence = governance.model_result(F.expr(_ANSWER), known, [F.col("osm_tags"), F.col("scrape_notes")])
    return T(spark, sf, "canonical").select("id", style.alias("style"), price.alias("price"), confidence.alias("confidence"))


@query("E18_repaired_confidence", X.sql("canonical") + f"SELECT id, style, 'inferred' AS style_confidence FROM canonical WHERE last_enriched_at >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR AND google_place_id LIKE 'osm:%' AND style_confidence IS NULL AND style IN ({_STYLE_LIST})")
def _(spark, sf):
    return governance.repaired_confidence(T(spark, sf, "canonical"), AS_OF, 48).select("id", "style", "style_confidence")


@query("F9_classifier_candidates", X.sql("canonical", "evidence") + "SELECT id FROM canonical c WHERE trim(coalesce(google_place_id, '')) <> '' AND (style IS NULL OR price_range IS NULL) AND (coalesce(scrape_method IN ('fetch', 'browser'), false) OR osm_tags IS NOT NULL OR EXISTS (SELECT 1 FROM evidence e WHERE e.entity_type = 'pizza' AND e.place_id = c.id AND e.match_confidence >= 0.9))")
def _(spark, sf):
    c, e = T(spark, sf, "canonical", "evidence")
    return governance.classifier_candidates(c, e).select("id")


_TARGET = "CASE review_kind WHEN 'ambiguous' THEN CASE source WHEN 'osm' THEN 'place_sources' WHEN 'wikidata' THEN 'source_review_queue' ELSE 'users' END ELSE CASE WHEN id % 2 = 0 THEN 'pizza_places' ELSE 'taco_places' END END"


@query("F14_sync_targets", X.sql("queue") + f"SELECT entity, target, CASE WHEN target IN ('place_sources', 'source_review_queue') THEN 'local_only' WHEN target NOT IN ('pizza_places', 'taco_places') THEN 'unsupported' WHEN entity IS NOT NULL AND target <> entity || '_places' THEN 'wrong_entity' END AS refusal, count(*) AS n FROM (SELECT CASE WHEN status <> 'rejected' THEN entity_type END AS entity, {_TARGET} AS target FROM queue) GROUP BY 1, 2, 3")
def _(spark, sf):
    rows = T(spark, sf, "queue").select(F.when(F.col("status") != "rejected", F.col("entity_type")).alias("entity"), F.expr(_TARGET).alias("target"))
    return rows.groupBy("entity", "target", governance.sync_target(F.col("target"), F.col("entity")).alias("refusal")).agg(F.count("*").alias("n"))


# ---- queue and sources ---------------------------------------------------------------------------------------------
_PERMANENT = "coalesce(regexp_matches(last_error, '^HTTP (403|404|410|520|521|523|525|526|530)$') OR starts_with(last_error, 'Non-HTML content:') OR regexp_matches(last_error, '(?i)(getaddrinfo|dns).*ENOTFOUND') OR regexp_matches(last_error, '(?i)\\bENOTFOUND\\b'), false)"


@query("F11_errors", X.sql("jobs") + f"SELECT last_error, count(*) AS n, {_PERMANENT} AS permanent, coalesce(regexp_matches(last_error, '^HTTP 5[0-9][0-9]$') OR last_error IN ('fetch failed', 'This operation was aborted'), false) AS retryable FROM jobs GROUP BY 1")
def _(spark, sf):
    rows = T(spark, sf, "jobs").groupBy("last_error").agg(F.count("*").alias("n"))
    return rows.withColumns({"permanent": J.permanent_error(F.col("last_error")), "retryable": J.retryable_error(F.col("last_error"))})


@query("T12_unclaimable", X.sql("jobs") + "SELECT id, 'failed' AS status FROM jobs WHERE job_type = 'scrape' AND status = 'pending' AND attempts >= max_attempts")
def _(spark, sf):
    return J.unclaimable(T(spark, sf, "jobs")).select("id", "status")


_REQUEUE = " OR ".join(f"lower(last_error) LIKE '{x}'" for x in J.REQUEUE_LIKE)
_NEVER = " OR ".join(f"lower(last_error) LIKE '{x}'" for x in J.REQUEUE_NOT_LIKE)


@query("T12_requeue", X.sql("jobs") + f"SELECT id, 'pending' AS status, CAST(0 AS INT) AS attempts, 'requeued now (was: ' || left(last_error, 120) || ')' AS last_error FROM jobs WHERE job_type = 'scrape' AND status = 'failed' AND ({_REQUEUE}) AND NOT ({_NEVER}) AND (SELECT count(*) FROM jobs WHERE job_type = 'scrape' AND status = 'pending') <= 1000000 ORDER BY id LIMIT 100")
def _(spark, sf):
    return J.requeued(T(spark, sf, "jobs"), "now", 100, 1_000_000).select("id", "status", "attempts", "last_error")


_FULL = 400


@query("T12_requeue_full_queue", X.sql("jobs") + f"SELECT place_type, (SELECT count(*) FROM jobs j WHERE j.place_type = p.place_type AND job_type = 'scrape' AND status = 'pending') AS waiting, CASE WHEN (SELECT count(*) FROM jobs j WHERE j.place_type = p.place_type AND job_type = 'scrape' AND status = 'pending') <= {_FULL} THEN least(100, (SELECT count(*) FROM jobs j WHERE j.place_type = p.place_type AND job_type = 'scrape' AND status = 'failed' AND ({_REQUEUE}) AND NOT ({_NEVER}))) ELSE 0 END AS requeued FROM (SELECT DISTINCT place_type FROM jobs) p")
def _(spark, sf):
    # the queue of one kind of place is over its bound, that of the other is not
    out = None
    for kind in ("pizza", "taco"):
        jobs = T(spark, sf, "jobs").where(F.col("place_type") == kind)
        waiting = jobs.agg(F.count_if((F.col("job_type") == "scrape") & (F.col("status") == "pending")).alias("waiting"))
        one = J.requeued(jobs, "now", 100, _FULL).agg(F.count("*").alias("requeued")).crossJoin(F.broadcast(waiting)).select(F.lit(kind).alias("place_type"), "waiting", "requeued")  # one row
        out = one if out is None else out.unionByName(one)
    return out


_LAST = "arg_max(status, (created_at, id)) AS status, arg_max(attempts, (created_at, id)) AS retries"


@query("J10_A9_backlog", X.sql("canonical", "evidence", "jobs") + f", b AS (SELECT c.state, j.status, j.retries FROM canonical c LEFT JOIN (SELECT place_id, {_LAST} FROM jobs WHERE job_type = 'classify' GROUP BY 1) j ON c.id = j.place_id WHERE {SQL['F9_classifier_candidates'].split('FROM canonical c WHERE ')[1]}), s AS (SELECT coalesce(state, '(null)') AS state, count(*) AS candidates, count(*) FILTER (WHERE status IS NULL) AS missing_job, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'processing') AS processing, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'completed' AND retries < 1) AS retryable_partial, count(*) FILTER (WHERE status = 'completed' AND retries >= 1) AS exhausted_partial, count(*) FILTER (WHERE status NOT IN ('pending', 'processing', 'failed', 'completed')) AS other FROM b GROUP BY 1) SELECT *, CASE WHEN missing_job > 0 THEN 'unfed' WHEN pending + processing > 0 THEN 'queued' WHEN retryable_partial > 0 THEN 'partial_retry_pending' WHEN exhausted_partial + failed > 0 THEN 'manual_review' ELSE 'clear' END AS backlog FROM s")
def _(spark, sf):
    c, e, jobs = T(spark, sf, "canonical", "evidence", "jobs")
    last = jobs.where("job_type = 'classify'").groupBy(F.col("place_id").alias("id")).agg(F.max(F.struct("created_at", F.col("id").alias("job"), "status", F.col("attempts").alias("retries"))).alias("m")).select("id", "m.status", "m.retries")
    s = J.backlog(governance.classifier_candidates(c, e).withColumn("state", F.coalesce("state", F.lit("(null)"))), last, ["state"])
    state = J.backlog_state(F.col("missing_job"), F.col("pending"), F.col("processing"), F.col("retryable_partial"), F.col("exhausted_partial") + F.col("failed"))
    return s.withColumn("backlog", state)


@query("A9_eta", X.sql("jobs") + "SELECT place_type, pending, completed, round(CASE WHEN pending <= 0 THEN 0 WHEN completed > 0 THEN pending * 24e0 / completed END, 4) AS hours FROM (SELECT place_type, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'completed') AS completed FROM jobs GROUP BY 1)")
def _(spark, sf):
    rows = T(spark, sf, "jobs").groupBy("place_type").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "completed").alias("completed"))
    return rows.withColumn("hours", F.round(J.backlog_hours(F.col("pending"), F.col("completed"), 24), 4))


@query("F7_due", X.sql("jobs") + f"SELECT id, status <> 'completed' OR epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(created_at) >= CASE WHEN place_type = 'taco' AND attempts = 1 THEN 1 ELSE 3648 END * 3600000::BIGINT AS due FROM jobs")
def _(spark, sf):
    success = F.when(F.col("status") == "completed", F.col("created_at"))
    hours = J.cadence(F.when(F.col("place_type") == "taco", "fsq_os_places").otherwise("osm"), F.col("attempts") == 1, F.lit(0), F.lit(3648))
    return T(spark, sf, "jobs").select("id", J.due(success, hours, F.lit(AS_OF).cast("timestamp")).alias("due"))


@query("F10_scrape_candidates", X.sql("canonical") + "SELECT id, google_place_id, state FROM canonical WHERE website_url IS NOT NULL AND (scrape_method IS NULL OR scrape_method NOT IN ('fetch', 'browser'))")
def _(spark, sf):
    rows = T(spark, sf, "canonical").where("website_url is not null and (scrape_method is null or scrape_method not in ('fetch', 'browser'))")
    return rows.orderBy((F.col("state") == "MI").desc(), "id").select("id", "google_place_id", "state")


@query("A10_osm_summary", X.sql("jobs") + f", t AS (SELECT place_type, CASE status WHEN 'completed' THEN 'success' WHEN 'failed' THEN 'failed' WHEN 'pending' THEN 'partial' END AS status, CASE WHEN attempts <> 2 THEN created_at END AS completed_at FROM jobs), s AS (SELECT place_type, count(*) AS tiles, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'success' AND (completed_at IS NULL OR epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(completed_at) >= 3648 * 3600000::BIGINT)) AS stale FROM t GROUP BY 1) SELECT *, greatest(tiles - success - partial - failed, 0) AS unprocessed, failed + partial AS retryable, greatest(tiles - success - partial - failed, 0) + failed + partial + stale AS refresh_queue FROM s")
def _(spark, sf):
    status = F.when(F.col("status") == "completed", "success").when(F.col("status") == "failed", "failed").when(F.col("status") == "pending", "partial")
    rows = T(spark, sf, "jobs").select("place_type", status.alias("status"), F.when(F.col("attempts") != 2, F.col("created_at")).alias("completed_at"))
    return governance.osm_summary(rows, ["place_type"], AS_OF, 3648)


@query("O4_review_order", X.sql("queue") + "SELECT id, review_kind, nearest_name_score, nearest_distance_m FROM queue ORDER BY CASE WHEN review_kind = 'ambiguous' THEN 0 ELSE 1 END, nearest_name_score DESC NULLS LAST, nearest_distance_m ASC NULLS LAST, id")
def _(spark, sf):
    order = [F.when(F.col("review_kind") == "ambiguous", 0).otherwise(1), F.desc_nulls_last("nearest_name_score"), F.asc_nulls_last("nearest_distance_m"), F.col("id")]
    return T(spark, sf, "queue").orderBy(*order).select("id", "review_kind", "nearest_name_score", "nearest_distance_m")


@query("O13_region_choice", X.sql("canonical") + "SELECT region, backlog, CAST(row_number() OVER (ORDER BY backlog DESC, region) AS BIGINT) AS turn FROM (SELECT coalesce(upper(state), '') AS region, count(*) FILTER (WHERE style IS NULL) AS backlog FROM canonical GROUP BY 1)")
def _(spark, sf):
    rows = T(spark, sf, "canonical").groupBy(F.coalesce(F.upper("state"), F.lit("")).alias("region")).agg(F.count_if(F.col("style").isNull()).alias("backlog"))
    ranked = running(rows.withColumn("k", -F.col("backlog")), ["k", "region"])
    return ranked.select("region", "backlog", F.col("number").alias("turn"))


@query("A16_A17_ids", X.sql("queue") + ", d AS (SELECT source, source_id, max(id) AS last_id FROM queue GROUP BY 1, 2) SELECT source, source_id, last_id, (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY source, source_id) AS new_id FROM d")
def _(spark, sf):
    d = T(spark, sf, "queue").groupBy("source", "source_id").agg(F.max("id").alias("last_id"))
    top = X.raw(spark, sf, "part").agg(F.max("p_partkey").alias("top"))
    return running(d, ["source", "source_id"]).crossJoin(F.broadcast(top)).select("source", "source_id", "last_id", (F.col("top") + F.col("number")).alias("new_id"))


_SPIDERS = "(SELECT s_name AS spider, s_acctbal > 0 AS import_enabled, CASE WHEN s_suppkey % 2 = 0 THEN 'a' ELSE 'b' END AS grp FROM supplier)"


def spiders(spark, sf):
    return X.raw(spark, sf, "supplier").select(F.col("s_name").alias("spider"), (F.col("s_acctbal") > 0).alias("import_enabled"), F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b").alias("group"), "s_suppkey")


@query("S10_preflight", f"SELECT spider, n AS features, bad AS warnings, CASE WHEN n IS NULL THEN 'missing' WHEN n = 0 THEN 'empty' WHEN bad > 0 THEN 'warning' ELSE 'ok' END AS preflight FROM {_SPIDERS} s LEFT JOIN (SELECT s_name, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS bad FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) l ON s.spider = l.s_name WHERE import_enabled")
def _(spark, sf):
    rows = X.raw(spark, sf, "lineitem").join(X.raw(spark, sf, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    stats = rows.groupBy(F.col("s_name").alias("spider")).agg(F.count("*").alias("features"), F.count_if(F.col("l_returnflag") == "R").alias("warnings"))
    return snapshots.preflight(spiders(spark, sf), stats)


@query("S10_round_robin", f"SELECT spider, turn FROM (SELECT spider, (row_number() OVER (ORDER BY spider) - 1 - 5 + 1000 * count(*) OVER ()) % count(*) OVER () AS turn FROM {_SPIDERS} WHERE import_enabled AND grp = 'a') WHERE turn < 12")
def _(spark, sf):
    return snapshots.spiders(spiders(spark, sf), 5, 12, "a").select("spider", "turn")


@query("S11_missing_ids", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_quantity > 10)")
def _(spark, sf):
    asked = X.raw(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return asked.join(X.raw(spark, sf, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("id")), "id", "left_anti")


_ENCODED = """'{"canonical_place_id":"' || canonical_place_id || '","name":"' || name || '","phone":' || coalesce('"' || phone || '"', 'null') || '}'"""


@query("S12_O1_snapshot_page", X.sql("canonical") + f"SELECT cursor, CASE WHEN so_far <= 20000 AND bytes <= 60 THEN payload END AS payload, bytes AS payload_bytes, CAST(so_far AS BIGINT) AS bytes_so_far FROM (SELECT *, sum(bytes + 1) OVER (ORDER BY cursor ROWS UNBOUNDED PRECEDING) AS so_far FROM (SELECT canonical_place_id AS cursor, CASE WHEN strlen(canonical_place_id) + strlen(name) + strlen(coalesce(phone, '')) <= 60 THEN {_ENCODED} END AS payload, CAST(coalesce(CASE WHEN strlen(canonical_place_id) + strlen(name) + strlen(coalesce(phone, '')) <= 60 THEN strlen({_ENCODED}) END, 61) AS INT) AS bytes FROM canonical WHERE canonical_place_id > '12' ORDER BY 1 LIMIT 400))")
def _(spark, sf):
    return snapshots.snapshot_page(T(spark, sf, "canonical"), "canonical_place_id", ["canonical_place_id", "name", "phone"], "12", 400, 60, 20_000)


@query("S12_O1_running_bytes", X.sql("canonical") + "SELECT canonical_place_id, CAST(sum(strlen(name) + 1) OVER (ORDER BY canonical_place_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes_so_far FROM canonical")
def _(spark, sf):
    return running(T(spark, sf, "canonical"), ["canonical_place_id"], {"bytes_so_far": F.octet_length("name") + 1}).select("canonical_place_id", "bytes_so_far")


@query("S12_A12_bad_cursors", X.sql("evidence") + "SELECT source_id AS cursor, count(*) AS n FROM evidence GROUP BY 1 HAVING count(*) > 1 OR source_id IS NULL OR source_id = '' OR strlen(source_id) > 4096")
def _(spark, sf):
    return snapshots.bad_cursors(T(spark, sf, "evidence"), "source_id")


_JSON = "CASE event_id % 6 WHEN 0 THEN '[1, 2, {}]' WHEN 1 THEN 'null' WHEN 2 THEN '{\"rows\": [1, 2], \"a\": []}' WHEN 3 THEN '{\"features\": {}}' WHEN 4 THEN '7' END"


@query("S14_record_counts", "SELECT event_id, CAST(CASE event_id % 6 WHEN 0 THEN 3 WHEN 1 THEN 0 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 ELSE 0 END AS INT) AS records FROM events")
def _(spark, sf):
    return X.raw(spark, sf, "events").select("event_id", snapshots.record_count(F.expr(_JSON)).alias("records"))


@query("S16_tile_status", X.sql("evidence") + "SELECT place_id AS tile, max(evidence_id) AS release, count(*) AS n, CASE WHEN count(*) > 12 THEN 'partial' ELSE 'success' END AS status FROM evidence GROUP BY 1")
def _(spark, sf):
    return snapshots.tile_status(T(spark, sf, "evidence").select(F.col("place_id").alias("tile"), F.col("evidence_id").alias("release")), 12)


@query("S17_schedule", X.sql("jobs") + f"SELECT id, status FROM jobs WHERE status IN ('failed', 'pending') AND NOT (attempts > 0 AND epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_at) < least(360e0, 15e0 * pow(2e0, greatest(attempts - 1, 0))) * 60000000e0) ORDER BY CASE status WHEN 'failed' THEN 0 ELSE 1 END, created_at, id")
def _(spark, sf):
    return J.scheduled(T(spark, sf, "jobs"), AS_OF).select("id", "status")


@query("W12_csv_lines", X.sql("queue") + """SELECT 'id,source_name,address' AS line UNION ALL SELECT CAST(id AS STRING) || ',' || coalesce(source_name, '') || ',' || CASE WHEN address IS NULL THEN '' ELSE '"' || address || '"' END FROM queue""")
def _(spark, sf):
    return snapshots.csv_lines(T(spark, sf, "queue"), ["id", "source_name", "address"])


@query("S15_S18_subtiles", _BOX + "SELECT count(*) * 16 AS subtiles, CAST(sum(m) AS BIGINT) AS places FROM t JOIN c USING (i, j)")
def _(spark, sf):
    boxes = tiles.covering(T(spark, sf, "canonical"), 0.1).where("n > 0")
    return tiles.split_boxes(boxes, 4).agg(F.count("*").alias("subtiles"), F.sum(F.when((F.col("row") == 0) & (F.col("col") == 0), F.col("n"))).alias("places"))


_META = ", ".join(f"('{k}', '{a}', '{b}')" for k, (a, b) in feeds.ATTRIBUTION.items())


@query("N28_attribution", X.sql("evidence", "candidate") + f"SELECT s.source, coalesce(m.license, 'source-specific') AS license, coalesce(m.attribution, s.source) AS attribution FROM (SELECT source FROM evidence UNION SELECT source FROM candidate UNION SELECT 'p' || c_mktsegment FROM customer) s LEFT JOIN (VALUES {_META}) m(source, license, attribution) ON s.source = m.source")
def _(spark, sf):
    e, c = T(spark, sf, "evidence", "candidate")
    sources = e.select("source").unionByName(c.select("source")).unionByName(X.raw(spark, sf, "customer").select(F.concat(F.lit("p"), "c_mktsegment").alias("source"))).distinct()
    a, b = feeds.source_metadata(F.col("source"))
    return sources.select("source", a.alias("license"), b.alias("attribution"))


@query("N26_public_states", "SELECT r_regionkey, CASE WHEN length(trim(r_name)) <= 10 THEN trim(r_name) ELSE 'ME' END AS state FROM region")
def _(spark, sf):
    return X.raw(spark, sf, "region").select("r_regionkey", governance.public_state(F.col("r_name"), {"middle east": "ME"}).alias("state"))


_RAW = """'{"id":' || coalesce('"' || sid || '"', 'null') || ',"name":' || coalesce('"' || name || '"', 'null') || '}'"""
_NUMBER = lambda x: f"regexp_replace(CAST({x} AS STRING), '\\.0$', '')"


@query("N4_envelopes", X.sql("candidate") + f""", r AS (SELECT CASE WHEN c_custkey % 4 <> 0 THEN source_id END AS sid, c_custkey, name, lat, lng, region FROM candidate), e AS (SELECT *, coalesce(sid, 'fallback-v1:sha256:' || sha256('{{"address":"","country":"us","lat":' || {_NUMBER('lat')} || ',"lng":' || {_NUMBER('lng')} || ',"locality":"","name":"' || {q_norm('name')} || '","postcode":"","region":"' || {q_norm('region')} || '"}}')) AS external_id, {_RAW} AS raw FROM r),
  k AS (SELECT *, 'srk_' || sha256('{{"externalId":"' || external_id || '","profile":"places","sourceNamespace":"registry"}}') AS source_record_key FROM e) SELECT c_custkey, external_id, source_record_key, 'obs_' || sha256('{{"payload":' || raw || ',"sourceRecordKey":"' || source_record_key || '","sourceRevision":null}}') AS observation_id FROM k""")
def _(spark, sf):
    rows = T(spark, sf, "candidate").withColumn("sid", F.when(F.col("c_custkey") % 4 != 0, F.col("source_id")))
    none = F.lit(None).cast("string")
    rows = rows.select("c_custkey", F.expr(_RAW).alias("raw"), F.col("sid").alias("source_id"), "name", "lat", "lng", "region", none.alias("address"), none.alias("locality"), none.alias("postcode"), F.lit("US").alias("country"))
    return feeds.envelopes(rows, "places", "registry").select("c_custkey", "external_id", "source_record_key", "observation_id")


@query("S9_wikidata_seeds", X.sql("canonical") + ", q AS (SELECT id, name, brand_wikidata AS qid FROM canonical UNION ALL SELECT id, name, json_extract_string(osm_tags, '$.\"brand:wikidata\"') FROM canonical UNION ALL SELECT id, name, json_extract_string(osm_tags, '$.\"operator:wikidata\"') FROM canonical) SELECT qid, id, name, 'entity ' || qid AS label FROM (SELECT qid, min(id) AS id, arg_min(name, id) AS name FROM q WHERE regexp_matches(qid, '^Q[0-9]+$') GROUP BY 1) WHERE qid <> 'Q3'")
def _(spark, sf):
    c = T(spark, sf, "canonical")
    entities = spark.createDataFrame([(f"Q{k}", f"entity Q{k}") for k in range(10) if k != 3], "qid string, label string")
    return feeds.wikidata_seeds(c, F.broadcast(entities))


@query("A8_stale_jobs", X.sql("jobs") + f"SELECT id, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_at)) / 60000000e0, 1) AS minutes_processing FROM jobs WHERE job_type = 'classify' AND status = 'processing' AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 200000 MINUTE")
def _(spark, sf):
    return J.stale_jobs(T(spark, sf, "jobs").withColumnRenamed("created_at", "started_at"), AS_OF, 200_000).select("id", "minutes_processing")


@query("A8_stale_workers", X.sql("workers") + f", w AS (SELECT worker_id, max(last_heartbeat) AS last_heartbeat, arg_max(current_job_id, (last_heartbeat, current_job_id)) AS current_job_id, arg_max(status, (last_heartbeat, current_job_id)) AS status FROM workers GROUP BY 1) SELECT worker_id, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_heartbeat)) / 60000000e0, 1) AS minutes_since_heartbeat FROM w WHERE last_heartbeat < TIMESTAMP '{AS_OF}' - INTERVAL 60 MINUTE AND (status <> 'idle' OR current_job_id % 2 = 0)")
def _(spark, sf):
    w = J.latest_workers(T(spark, sf, "workers")).withColumn("current_job_id", F.when(F.col("current_job_id") % 2 == 0, F.col("current_job_id")))
    return J.stale_workers(w, AS_OF, 60).select("worker_id", "minutes_since_heartbeat")


@query("T2_runnable", X.sql("jobs") + "SELECT job_type, count(*) AS n FROM jobs WHERE job_type <> 'scrape' GROUP BY 1")
def _(spark, sf):
    control = spark.createDataFrame([("pause_scrape", "true"), ("pause_classify", "false"), ("pauseXmenu_parse", "true")], "key string, value string")
    return J.runnable(T(spark, sf, "jobs"), control).groupBy("job_type").agg(F.count("*").alias("n"))


_PROMOTED = SQL["E16_J11_W6_promotions"]


@query("W6_filled_places", _PROMOTED[: _PROMOTED.rindex("  SELECT field")] + ", pr AS (" + _PROMOTED[_PROMOTED.rindex("  SELECT field") :] + "), n AS (SELECT place_id, max(value) FILTER (WHERE field = 'website_url') AS w, max(value) FILTER (WHERE field = 'phone') AS t FROM pr GROUP BY 1) SELECT c.id, coalesce(nullif(c.website_url, ''), w) AS website_url, coalesce(nullif(c.phone, ''), t) AS phone FROM canonical c JOIN n ON n.place_id = c.id WHERE (w IS NOT NULL AND coalesce(c.website_url, '') = '') OR (t IS NOT NULL AND coalesce(c.phone, '') = '') ORDER BY c.id LIMIT 50")
def _(spark, sf):
    e, p = T(spark, sf, "evidence", "canonical")
    return review.filled_places(p, review.promotions(e, p, "1999-06-01 00:00:00"), 50).select("id", "website_url", "phone")


@query("J16_known_identities", X.sql("queue", "canonical", "evidence") + "SELECT DISTINCT source || ':' || source_id AS identity FROM evidence e WHERE entity_type = 'pizza' AND EXISTS (SELECT 1 FROM queue q WHERE q.source = e.source AND CASE WHEN q.source = 'osm' THEN regexp_replace(trim(q.source_id), '^osm:', '') ELSE trim(q.source_id) END = e.source_id AND trim(q.source_id) <> '' AND q.id % 5 <> 4) UNION SELECT 'legacy:' || google_place_id FROM canonical WHERE google_place_id IN (SELECT 'osm:node/' || CAST(id AS STRING) FROM queue WHERE id % 5 <> 4)")
def _(spark, sf):
    q, p, e = T(spark, sf, "queue", "canonical", "evidence")
    rows = q.withColumn("google_place_id", F.when(F.col("id") % 5 != 4, F.concat(F.lit("osm:node/"), F.col("id").cast("string"))))
    return review.known_identities(rows, e.withColumnRenamed("source_id", "external_id"), p)


@query("A18_readiness", _PAYLOAD + "SELECT *, rows - would_update - missing - held_back AS unchanged, CAST(ceil(would_update / 500e0) AS BIGINT) AS batches FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE verdict LIKE 'ok%' AND len(changed) > 0) AS would_update, count(*) FILTER (WHERE verdict = 'missing') AS missing, count(*) FILTER (WHERE verdict NOT LIKE 'ok%' AND verdict <> 'missing') AS held_back, CAST(sum(CASE WHEN verdict LIKE 'ok%' AND len(changed) > 0 THEN len(changed) ELSE 0 END) AS BIGINT) AS changed_fields FROM v)")
def _(spark, sf):
    return publish.readiness(payloads(spark, sf))


@query("W9_command_versions", X.sql("permits") + "SELECT object_id, sha256('[1,2,' || CAST(object_id % 3 AS STRING) || ',\"' || sha256(address) || '\"]') AS version FROM permits")
def _(spark, sf):
    rows = T(spark, sf, "permits")
    return rows.select("object_id", publish.command_version(F.lit(1), F.lit(2), F.col("object_id") % 3, F.sha2("address", 256)).alias("version"))


_SYNCED = "style IS NOT NULL OR price_range IS NOT NULL OR style_confidence IS NOT NULL OR lifecycle_status IS NOT NULL"


@query("W8_sync_batches", X.sql("canonical") + f"SELECT * FROM (SELECT 'next' AS mode, id FROM canonical WHERE id > 30 AND ({_SYNCED}) ORDER BY id LIMIT 40) UNION ALL SELECT * FROM (SELECT 'ids', id FROM canonical WHERE id IN (7, 9, 1000000) AND ({_SYNCED})) UNION ALL SELECT * FROM (SELECT 'checkpoint', id FROM canonical WHERE last_enriched_at IS NOT NULL AND ({_SYNCED}) AND (last_enriched_at, id) > (TIMESTAMP '2024-04-01 00:00:00', 50) AND last_enriched_at >= TIMESTAMP '2024-03-01 00:00:00' AND (style IS NOT NULL OR price_range IS NOT NULL OR style_confidence IS NOT NULL) ORDER BY last_enriched_at, id LIMIT 60)")
def _(spark, sf):
    c = T(spark, sf, "canonical")
    one = publish.sync_select(c, after_id=30, batch=40).select(F.lit("next").alias("mode"), "id")
    two = publish.sync_select(c, ids=[7, 9, 7, -1, 1_000_000]).select(F.lit("ids").alias("mode"), "id")
    three = publish.sync_select(c, checkpoint=("2024-04-01 00:00:00", 50), changed_since="2024-03-01 00:00:00", only_classified=True, batch=60).select(F.lit("checkpoint").alias("mode"), "id")
    return one.unionByName(two).unionByName(three)


@query("S6_F5_tile_page", X.sql("candidate") + """SELECT source_id AS id, name, primary_category, '{"primary":"' || primary_category || '"' || CASE WHEN h IS NOT NULL THEN ',"hierarchy":["' || h || '"]' ELSE '' END || CASE WHEN a IS NOT NULL THEN ',"alternates":["' || a || '"]' ELSE '' END || '}' AS taxonomy, lat, lng, region FROM (SELECT source_id, name, lat, lng, region, 'food' AS primary_category, CASE c_custkey % 4 WHEN 0 THEN 'pizza' WHEN 1 THEN 'bar' END AS h, CASE WHEN c_custkey % 5 = 0 THEN 'pizza' WHEN c_custkey % 5 = 1 THEN 'x' END AS a, is_closed, c_custkey FROM candidate)
  WHERE (coalesce(h = 'pizza', false) OR coalesce(a = 'pizza', false)) AND c_custkey % 6 <> 5 AND lng BETWEEN -84e0 AND -83.9e0 AND lat BETWEEN 42e0 AND 42.5e0 AND NOT is_closed AND source_id > 'fsq-1' ORDER BY 1 LIMIT 100""")
def _(spark, sf):
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    tax = F.struct(F.lit("food").alias("primary"), F.when(k % 4 < 2, F.array(F.when(k % 4 == 0, "pizza").otherwise("bar"))).alias("hierarchy"), F.when(k % 5 < 2, F.array(F.when(k % 5 == 0, "pizza").otherwise("x"))).alias("alternates"))
    address = F.array(F.struct(none.alias("freeform"), none.alias("locality"), F.col("region"), none.alias("postcode"), F.when(k % 6 == 5, "CA").otherwise("US").alias("country")))
    rows = T(spark, sf, "candidate").select(
        F.col("source_id").alias("id"), F.struct(F.col("name").alias("primary")).alias("names"), F.lit(0.5).alias("confidence"), none.alias("basic_category"), tax.alias("taxonomy"), address.alias("addresses"),
        F.array("website").alias("websites"), F.array("phone").alias("phones"), F.array(none).alias("sources"), F.struct(F.col("lng").alias("xmin"), F.col("lat").alias("ymin")).alias("bbox"), F.when(F.col("is_closed"), "permanently_closed").alias("operating_status"),
    )
    page = tiles.tile_page(rows, (42.0, -84.0, 42.5, -83.9), ["pizza"], 100, "fsq-1")
    return page.select("id", "name", "primary_category", "taxonomy", "lat", "lng", "region")

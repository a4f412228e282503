"""Queries of resumed scans, deliveries, paged sources, row contracts, publication and scheduling, with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from placeforge.operators import constraints, delivery, governance
from placeforge.operators import jobs as J
from placeforge.operators import matching as M
from placeforge.plans import fixtures as X
from placeforge.plans.queries import AS_OF, Q_CATEGORIES, Q_ROUTE, T, query
from placeforge.sources import artifacts, feeds, paged, positions, tiles

# ---- resumed scans and deliveries ----------------------------------------------------------------------------------
_FEEDS = ("benchmark", "conversations", "documents")
_AT, _ROWS, _LIMIT, _BYTES = positions.Position(1, 40), 5000, 300, 250_000
_WANTED = "contains(text, 'e') AND length(text) % 2 = 0"


@query("S4_S5_resumed_page", "WITH r AS (" + " UNION ALL ".join(f"SELECT '{t}' AS feed, {k} AS f, row_number() OVER () - 1 AS row, text FROM {t}" for k, t in enumerate(_FEEDS)) + f"""),
  base AS (SELECT count(*) FILTER (WHERE f < {_AT.file}) + {_AT.row} AS base, count(*) AS total, count(*) FILTER (WHERE f = 0) AS n0, count(*) FILTER (WHERE f = 1) AS n1 FROM r),
  o AS (SELECT r.*, row_number() OVER (ORDER BY f, row) - 1 - base AS ordinal FROM r, base), m AS (SELECT * FROM o WHERE f BETWEEN {_AT.file} AND {_AT.file + 1} AND ordinal BETWEEN 0 AND {_ROWS - 1} AND {_WANTED} ORDER BY ordinal LIMIT {_LIMIT}),
  b AS (SELECT *, sum(strlen(text)) OVER (ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS so_far FROM m), kept AS (SELECT * FROM b WHERE so_far <= {_BYTES}),
  e AS (SELECT base + CASE WHEN (SELECT count(*) FROM kept) < (SELECT count(*) FROM m) OR (SELECT count(*) FROM m) = {_LIMIT} THEN (SELECT max(ordinal) + 1 FROM kept) ELSE least({_ROWS}, total - base) END AS stop, total, n0, n1 FROM base)
  SELECT feed, row, strlen(text) AS bytes, CAST(so_far AS BIGINT) AS bytes_so_far, CASE WHEN stop = total THEN 0 WHEN stop < n0 + n1 THEN 1 ELSE 2 END AS next_file, CASE WHEN stop = total THEN 0 WHEN stop < n0 + n1 THEN stop - n0 ELSE stop - n0 - n1 END AS next_row, stop = total AS complete FROM kept, e""")
def _(spark, sf):
    rows = positions.located(spark, [f"{sf}/{t}.parquet" for t in _FEEDS], "text string")
    size = F.octet_length("text")
    page = positions.scan_page(rows, positions.pinned(rows), _AT, F.contains("text", F.lit("e")) & (F.length("text") % 2 == 0), size, 2, _ROWS, _LIMIT, _BYTES)
    to = page.next
    return page.rows.select(F.regexp_extract("file", r"(\w+)\.parquet", 1).alias("feed"), "row", size.cast("long").alias("bytes"), F.col("bytes_so_far").cast("long").alias("bytes_so_far"), F.lit(to.file).alias("next_file"), F.lit(to.row).cast("long").alias("next_row"), F.lit(page.complete).alias("complete"))


_HEX = lambda k: f"sum(CAST('0x' || substr(bound, {k}, 7) AS BIGINT))"


@query("T3_T4_delivery_pages", f"""WITH l AS (SELECT row_number() OVER (ORDER BY event_id) AS number, sha256('{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}}') AS line FROM events),
  h AS (SELECT *, CAST(floor((number - 1) / 1000) AS BIGINT) AS page, sha256(number || ':' || line) AS bound FROM l),
  p AS (SELECT page, count(*) AS n, sha256(string_agg(line, '' ORDER BY number)) AS page_id, {_HEX(1)} AS a, {_HEX(8)} AS b FROM h GROUP BY 1),
  s AS (SELECT page, n, page_id, sum(n) OVER w AS stop, sum(a) OVER w AS a, sum(b) OVER w AS b, max(page) OVER () AS top FROM p WINDOW w AS (ORDER BY page ROWS UNBOUNDED PRECEDING))
  SELECT page, CAST(stop - n AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end", page_id, sha256(CAST(stop AS BIGINT) || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT)) AS prefix, page = top AS last FROM s""")
def _(spark, sf):
    return delivery.delivery_pages(X.raw(spark, sf, "events").select("event_id", "user_id", "event_type"), ["event_id"], 1000)


# ---- paged sources and files ---------------------------------------------------------------------------------------
# a source whose answer holds missing, negative and repeated ids
_ASKED = "(SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_orderkey WHEN o_orderkey % 83 = 0 THEN CAST(floor(o_orderkey / 166e0) AS BIGINT) ELSE o_orderkey END AS id FROM orders)"
_JUDGED = f"WITH d AS (SELECT id, count(*) AS copies FROM {_ASKED} GROUP BY 1), j AS (SELECT *, CASE WHEN id IS NULL THEN 'missing' WHEN id < 0 THEN 'negative' WHEN copies > 1 THEN 'duplicate' END AS refused FROM d), s AS (SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 250) AS BIGINT) AS page FROM j WHERE refused IS NULL) "


def asked_ids(spark, sf):
    k = F.col("o_orderkey")
    one = F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, -k).when(k % 83 == 0, F.floor(k / 166.0)).otherwise(k)
    return paged.discovered(X.raw(spark, sf, "orders").select(one.alias("id")), "id", most=1 << 40)


@query("S11_refused_ids", _JUDGED + "SELECT id, copies, refused FROM j WHERE refused IS NOT NULL")
def _(spark, sf):
    return asked_ids(spark, sf).where("refused is not null").select("id", "copies", "refused")


@query("S11_id_pages", _JUDGED + ", r AS (SELECT l_orderkey AS id, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey % 2 AS x FROM lineitem WHERE l_quantity > 10) GROUP BY 1) SELECT page, count(*) AS requested, min(s.id) AS first_id, max(s.id) AS last_id, count(r.n) AS returned, count(*) FILTER (WHERE r.n IS NULL) AS missing, count(*) FILTER (WHERE r.n > 1) AS repeated FROM s LEFT JOIN r ON s.id = r.id GROUP BY 1")
def _(spark, sf):
    asked = asked_ids(spark, sf).where("refused is null").select("id", "page")
    returned = X.raw(spark, sf, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 2).alias("x")).distinct().select("id")
    return paged.page_report(asked, returned)


@query("S13_table_files")
def _(spark, sf):
    rows = artifacts.file_snapshots(spark, sf, "*.parquet", 1 << 26)
    return rows.select(F.regexp_extract("file", r"([^/]+\.parquet.*)$", 1).alias("file"), "bytes", "digest", "outcome")


# ---- row contracts -------------------------------------------------------------------------------------------------
def _q_text(path: str, most: int, required: bool = False, more: str = "") -> str:
    missing = "'missing'" if required else "NULL"
    return f"struct_pack(path := '{path}', problem := CASE WHEN {path} IS NULL THEN {missing} WHEN trim({path}) = '' THEN 'blank' WHEN trim({path}) <> {path} THEN 'untrimmed' WHEN strlen({path}) > {most} THEN 'too_long' {more} END)"


def _q_number(path: str, least: float, most: float, required: bool) -> str:
    return f"struct_pack(path := '{path}', problem := CASE WHEN {path} IS NULL THEN {chr(39) + 'missing' + chr(39) if required else 'NULL'} WHEN {path} < {least} OR {path} > {most} THEN 'out_of_range' END)"


_RELEASE_FLAGS = "CASE c_custkey % 9 WHEN 0 THEN ['dup', 'Doesn''t exist'] WHEN 1 THEN [' closed'] WHEN 2 THEN NULL ELSE [] END"
_RELEASE = X.sql("candidate") + f", rel AS (SELECT source_id AS fsq_place_id, name, lat AS latitude, CASE WHEN c_custkey % 50 = 0 THEN 200e0 ELSE lng END AS longitude, region, phone AS tel, website, {Q_CATEGORIES} AS labels, date_closed, {_RELEASE_FLAGS} AS flags FROM candidate)"


def release_rows(spark, sf):
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    words = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    flags = F.when(k % 9 == 0, words("dup", "Doesn't exist")).when(k % 9 == 1, words(" closed")).when(k % 9 != 2, words())
    labels = F.filter(F.transform(F.split(F.col("category_text"), "[|;,]"), lambda x: F.trim(x)), lambda x: x != "")
    return T(spark, sf, "candidate").select(
        F.col("source_id").alias("fsq_place_id"), "name", F.col("lat").alias("latitude"), F.when(k % 50 == 0, 200.0).otherwise(F.col("lng")).alias("longitude"), none.alias("address"), none.alias("locality"), "region", none.alias("postcode"), none.alias("country"),
        F.col("phone").alias("tel"), "website", words().alias("fsq_category_ids"), labels.alias("fsq_category_labels"), "date_closed", flags.alias("unresolved_flags"), F.lit("x").alias("extra"),
    )


@query("V2_release_violations", _RELEASE + f""", v AS (SELECT fsq_place_id, unnest([{_q_text('fsq_place_id', 256, True)}, {_q_text('name', 1024, True)}, {_q_number('latitude', -90, 90, True)}, {_q_number('longitude', -180, 180, True)}, {_q_text('region', 256)}, {_q_text('tel', 128)}, {_q_text('website', 2048)},
  struct_pack(path := 'date_closed', problem := CASE WHEN date_closed IS NOT NULL AND NOT regexp_matches(date_closed, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'malformed' END), struct_pack(path := 'unresolved_flags', problem := CASE WHEN flags IS NULL THEN 'missing' END),
  struct_pack(path := 'unresolved_flags[0]', problem := CASE WHEN trim(flags[1]) <> flags[1] THEN 'untrimmed' END), struct_pack(path := 'unresolved_flags[1]', problem := CASE WHEN regexp_replace(lower(flags[2]), '[^a-z]+', '', 'g') = 'doesntexist' THEN 'forbidden' END)]) AS v FROM rel)
  SELECT fsq_place_id, v.path AS path, v.problem AS problem FROM v WHERE v.problem IS NOT NULL""")
def _(spark, sf):
    return constraints.violation_rows(release_rows(spark, sf), "fsq_place_id", constraints.RELEASE_V1)


@query("V2_permit_violations", X.sql("permits") + f""", v AS (SELECT object_id, unnest([{_q_text('record_id', 256, True)}, {_q_text('address', 2048, True)}, {_q_text('permit_type', 128)}, {_q_text('use_group', 1000, False, "WHEN use_group NOT IN ('B', 'M', 'R-2', 'F-1') THEN 'not_allowed'")},
  {_q_text('cost', 1000, False, "WHEN NOT regexp_matches(cost, '^-?[0-9]+([.][0-9]+)?$') THEN 'malformed'")}, {_q_text('num_units', 1000, False, "WHEN NOT regexp_matches(num_units, '^[0-9]+$') THEN 'malformed'")}, {_q_number('latitude', -90, 90, False)}]) AS v FROM permits)
  SELECT object_id, v.path AS path, v.problem AS problem FROM v WHERE v.problem IS NOT NULL""")
def _(spark, sf):
    return constraints.violation_rows(T(spark, sf, "permits"), "object_id", constraints.PERMIT_V1)


# after the projection's trims only missing names, far coordinates, dates and flags' own blanks are left to refuse
_PROJECTED = "CASE WHEN coalesce(list_contains(flags, 'Doesn''t exist'), false) THEN 'excluded' WHEN trim(coalesce(name, '')) = '' OR longitude > 180 OR coalesce(NOT regexp_matches(nullif(trim(date_closed), ''), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), false) OR coalesce(list_contains(flags, ' closed'), false) THEN 'rejected' ELSE 'projected' END"


@query("N16_projection_report", _RELEASE + f" SELECT count(*) AS input, count(*) FILTER (WHERE o = 'projected') AS projected, count(*) FILTER (WHERE o = 'excluded') AS excluded, count(*) FILTER (WHERE o = 'rejected') AS rejected FROM (SELECT {_PROJECTED} AS o FROM rel)")
def _(spark, sf):
    rows, seen = governance.projection(release_rows(spark, sf))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[k] for k in ("input", "projected", "excluded", "rejected"))], "input long, projected long, excluded long, rejected long")


@query("N16_projected_rows", _RELEASE + f" SELECT fsq_place_id, name, region, date_closed FROM (SELECT *, {_PROJECTED} AS o, nullif(trim(region), '') AS region_, nullif(trim(date_closed), '') AS closed_ FROM rel) WHERE o = 'projected'".replace("name, region, date_closed FROM", "trim(name) AS name, region_ AS region, closed_ AS date_closed FROM"))
def _(spark, sf):
    return governance.projection(release_rows(spark, sf))[0].select("fsq_place_id", "name", "region", "date_closed")


@query("F4_prepared", X.sql("candidate") + f", r AS (SELECT *, {Q_ROUTE} AS route FROM (SELECT *, {Q_CATEGORIES} AS categories FROM candidate)) SELECT count(*) AS input, count(*) FILTER (WHERE route <> 'excluded_unusable') AS usable, count(*) FILTER (WHERE route NOT IN ('excluded_unusable', 'excluded_out_of_scope')) AS in_scope, count(*) FILTER (WHERE route IN ('ready_for_match', 'closed_evidence_candidate')) AS eligible FROM r")
def _(spark, sf):
    rows = M.route(T(spark, sf, "candidate").withColumn("categories", F.filter(F.transform(F.split("category_text", "[|;,]"), lambda x: F.trim(x)), lambda x: x != "")))
    route = F.col("route")
    steps = [("usable", route != "excluded_unusable"), ("in_scope", route != "excluded_out_of_scope"), ("eligible", route != "filtered_non_pizza")]
    kept, seen = governance.prepared(rows, steps, most=1 << 40)
    kept.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[k] for k in ("input", "usable", "in_scope", "eligible"))], "input long, usable long, in_scope long, eligible long")


@query("N3_fsq_payload", X.sql("candidate") + f", n AS (SELECT *, {Q_CATEGORIES} AS categories, nullif(trim(coalesce(website, '')), '') AS site FROM candidate), c AS (SELECT * REPLACE (CASE WHEN trim(coalesce(date_closed, '')) = '' OR lower(trim(date_closed)) IN ('null', 'none', 'unknown', 'n/a', 'not available') THEN false ELSE coalesce(try_cast(trim(date_closed) AS TIMESTAMP) <= TIMESTAMP '{AS_OF}', true) END AS is_closed, site AS source_url, site AS website) FROM n) "
  f"SELECT 'fsq_os_places' AS source, 'Foursquare OS Places' AS source_label, source_id, nullif(name, '') AS name, lat, lng, CAST(NULL AS STRING) AS address, CAST(NULL AS STRING) AS locality, nullif(region, '') AS region, CAST(NULL AS STRING) AS postcode, 'US' AS country, website, phone, source_url, 0e0 AS confidence, is_closed, array_to_string(categories, '+') AS categories, CAST(NULL AS STRING) AS spider, {Q_ROUTE} AS route FROM c")  # fmt: skip
def _(spark, sf):
    names = (("fsq_place_id", "source_id"), ("Name", "name"), ("latitude", "lat"), ("longitude", "lng"), ("region", "region"), ("tel", "phone"), ("website", "website"), ("date_closed", "date_closed"), ("categories", "category_text"))
    raw = F.create_map(*(x for k, v in names for x in (F.lit(k), F.col(v).cast("string"))), F.lit("country"), F.lit("US"))
    return feeds.candidate_payloads(T(spark, sf, "candidate").select(raw.alias("fields")), AS_OF).withColumn("categories", F.array_join("categories", "+"))


# ---- publication ---------------------------------------------------------------------------------------------------
def _strict_publisher(rows: pd.DataFrame) -> None:
    """Refuses a batch with a latitude that is missing or no latitude, as a database would."""
    if not rows["latitude"].abs().le(90).all():
        raise governance.InvalidInput("22023")


@query("W10_receipts", X.sql("permits") + "SELECT object_id, CASE WHEN coalesce(abs(latitude) <= 90, false) THEN 'applied' ELSE 'rejected' END AS status, CASE WHEN NOT coalesce(abs(latitude) <= 90, false) THEN 'database_input_invalid' END AS reason FROM permits")
def _(spark, sf):
    return governance.published(T(spark, sf, "permits").select("object_id", "latitude"), "object_id", _strict_publisher).select("object_id", "status", "reason")


@query("J9_positions", X.sql("sync_local", "sync_public") + ", a AS (SELECT row_number() OVER (ORDER BY id) AS number, style, lifecycle_status, name FROM sync_local), b AS (SELECT row_number() OVER (ORDER BY id) AS number, style, lifecycle_status, name FROM sync_public WHERE id <> 7), j AS (SELECT number, a.number IS NULL AS no_a, b.number IS NULL AS no_b, array_to_string(list_filter([CASE WHEN a.style IS DISTINCT FROM b.style THEN 'style' END, CASE WHEN a.lifecycle_status IS DISTINCT FROM b.lifecycle_status THEN 'lifecycle_status' END, CASE WHEN a.name IS DISTINCT FROM b.name THEN 'name' END], lambda x: x IS NOT NULL), ',') AS d FROM a FULL JOIN b USING (number)) SELECT number, CASE WHEN no_b THEN 'expected_only' WHEN no_a THEN 'actual_only' ELSE 'both' END AS side, CASE WHEN no_a OR no_b THEN '' ELSE d END AS differs FROM j WHERE no_a OR no_b OR d <> ''")
def _(spark, sf):
    # one row is gone on the second side, so all behind it stand one place earlier
    a, b = T(spark, sf, "sync_local", "sync_public")
    return M.positional_differences(a, b.where("id <> 7"), ["id"], ["style", "lifecycle_status", "name"]).withColumn("differs", F.array_join("differs", ","))


_MAP = {"website": "website_url", "contact:phone": "phone", "menu_url": "menu_url", "email": "email", "hours": "hours", "name": "name", "address": "address", "state": "state", "style": "style", "price_range": "price_range", "rating": "CAST(rating AS STRING)", "notes": "notes", "status": "status", "lifecycle_status": "lifecycle_status", "brand_wikidata": "brand_wikidata", "unknown": "'x'"}
_FIELD = {"website": "website_url", "contact:phone": "phone"}
_DISPOSED = {a: (b, c) for a, b, c in governance.DISPOSITIONS}
_ACTION = {"auto_fill_if_blank": "fill", "evidence_only": "evidence", "manual_review_only": "review", "blocked": "blocked"}


@query("F12_field_dispositions", X.sql("canonical") + ", f AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, '{_DISPOSED[f][0]}' AS grp, '{_DISPOSED[f][1]}' AS disposition, '{_ACTION[_DISPOSED[f][1]]}' AS action, {e} AS v FROM canonical" for k, e in _MAP.items() if (f := _FIELD.get(k, k)) in _DISPOSED) + ") SELECT field, grp, disposition, action, count(*) AS n, count(DISTINCT trim(v)) AS n_values FROM f WHERE trim(coalesce(v, '')) <> '' GROUP BY 1, 2, 3, 4")
def _(spark, sf):
    fields = F.create_map(*(x for k, e in _MAP.items() for x in (F.lit(k), F.expr(e).cast("string"))))
    found = governance.field_dispositions(T(spark, sf, "canonical"), "id", fields)
    return found.groupBy("field", "grp", "disposition", "action").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


@query("N27_report_names", X.sql("queue") + "SELECT id, CASE WHEN source = 'all_the_places' AND report_file = 'pizza_hut_us-review.json' THEN CASE WHEN contains(lower(coalesce(source_name, '')), 'express') THEN 'Pizza Hut Express' ELSE 'Pizza Hut' END WHEN source = 'all_the_places' AND report_file = 'dominos_pizza_us-review.json' THEN 'Domino''s Pizza' ELSE nullif(source_name, '') END AS name FROM queue")
def _(spark, sf):
    return T(spark, sf, "queue").select("id", governance.report_name(F.col("source"), F.col("report_file"), F.col("source_name")).alias("name"))


_GROUP = "CASE coalesce(upper(state), '') WHEN 'MI' THEN 'michigan' WHEN 'NY' THEN 'major_us' WHEN 'OH' THEN 'major_us' ELSE 'rest_of_world' END"


@query("N25_groups", X.sql("canonical") + f"SELECT {_GROUP} AS region_group, count(*) AS n, min(id) AS first_id FROM canonical GROUP BY 1")
def _(spark, sf):
    group = tiles.region_group(tiles.region_priority(F.col("state"), F.lit(None).cast("string")))
    return T(spark, sf, "canonical").groupBy(group.alias("region_group")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


# ---- queue and schedule --------------------------------------------------------------------------------------------
_DATA = "CASE id % 4 WHEN 0 THEN '{\"a\":\"1\",\"partial_reprocess_count\":\"1\"}' WHEN 1 THEN '{\"a\":\"1\",\"b\":\"2\"}' WHEN 2 THEN 'broken' END"
_RECENT = f"CASE WHEN attempts <> 2 THEN created_at END >= TIMESTAMP '{AS_OF}' - INTERVAL 3600 HOUR"


def jobs_with_data(spark, sf):
    return T(spark, sf, "jobs").withColumns({"data": F.expr(_DATA), "completed_at": F.when(F.col("attempts") != 2, F.col("created_at"))})


@query("A8_window_health", X.sql("jobs") + "SELECT place_type, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("pending", "processing", "completed", "failed")) + ", " + ", ".join(f"count(*) FILTER (WHERE status = '{s}' AND coalesce({_RECENT}, false)) AS recent_{s}" for s in ("completed", "failed")) + " FROM jobs WHERE job_type = 'classify' GROUP BY 1")
def _(spark, sf):
    return J.window_health(jobs_with_data(spark, sf), AS_OF, 3600)


@query("T1_complete", X.sql("jobs") + f"SELECT id, 'completed' AS status, CASE WHEN id % 3 = 0 THEN {_DATA} ELSE CASE id % 4 WHEN 0 THEN '{{\"a\":\"1\",\"b\":\"new\",\"partial_reprocess_count\":\"1\"}}' WHEN 1 THEN '{{\"a\":\"1\",\"b\":\"new\"}}' ELSE '{{\"b\":\"new\"}}' END END AS data FROM jobs WHERE status = 'processing'")
def _(spark, sf):
    output = F.when(F.col("id") % 3 != 0, '{"b":"new"}')
    return J.completed(jobs_with_data(spark, sf), output, AS_OF).select("id", "status", "data")


@query("T1_retry", X.sql("jobs") + "SELECT id, 'pending' AS status, CAST(greatest(attempts - 1, 0) AS INT) AS attempts FROM jobs WHERE status = 'processing'")
def _(spark, sf):
    return J.retried(T(spark, sf, "jobs")).select("id", "status", "attempts")


@query("T1_reopen", X.sql("jobs") + "SELECT id, 'pending' AS status, 'partial' AS last_error, CASE id % 4 WHEN 1 THEN '{\"a\":\"1\",\"b\":\"2\",\"partial_reprocess_count\":\"1\"}' ELSE '{\"partial_reprocess_count\":\"1\"}' END AS data FROM jobs WHERE status = 'completed' AND id % 4 <> 0")
def _(spark, sf):
    return J.reopened(jobs_with_data(spark, sf), "partial").select("id", "status", "last_error", "data")


@query("T1_add", X.sql("jobs", "canonical") + ", n AS (SELECT id + 1000000 AS id, 'scrape' AS job_type, id AS place_id FROM canonical UNION ALL SELECT id + 2000000, CASE WHEN id % 2 = 0 THEN 'classify' ELSE 'scrape' END, id FROM canonical) SELECT job_type, place_id, min(id) AS id, 'pending' AS status FROM n WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.job_type = n.job_type AND j.place_id = n.place_id) GROUP BY 1, 2")
def _(spark, sf):
    jobs, places = T(spark, sf, "jobs", "canonical")
    one = places.selectExpr("id + 1000000 AS id", "'scrape' AS job_type", "id AS place_id")
    two = places.selectExpr("id + 2000000 AS id", "CASE WHEN id % 2 = 0 THEN 'classify' ELSE 'scrape' END AS job_type", "id AS place_id")
    return J.added(jobs, one.unionByName(two), ["job_type", "place_id"]).select("job_type", "place_id", "id", "status")


_STATE = "CAST(max(attempts) AS BIGINT) AS failures, 3 AS threshold, 4 AS regions, CAST(count(*) % 4 AS INT) AS region_index, count(*) % 5 = 0 AS pending_rotation"
_BACK = "count(*) FILTER (WHERE status = 'failed' AND attempts = 3) AS backlog"


@query("T7_region_choice", X.sql("jobs") + f", s AS (SELECT coalesce(worker_id, 'none') AS source, {_STATE.replace('max(attempts)', 'max(CASE WHEN id % 4 = 0 THEN attempts ELSE 0 END) + count(*) % 4')} FROM jobs GROUP BY 1), b AS (SELECT coalesce(worker_id, 'none') AS source, CAST(id % 4 AS BIGINT) AS region, {_BACK} FROM jobs GROUP BY 1, 2), t AS (SELECT source, arg_min(region, (-backlog, region)) AS region FROM b WHERE backlog > 0 GROUP BY 1) SELECT s.source, CASE WHEN pending_rotation OR failures >= threshold THEN CAST((region_index + CASE WHEN failures >= threshold THEN 1 ELSE 0 END) % regions AS BIGINT) ELSE coalesce(t.region, CAST(region_index AS BIGINT)) END AS region, CASE WHEN pending_rotation OR failures >= threshold THEN 'rotated' WHEN t.region IS NOT NULL THEN 'backlog' ELSE 'stored' END AS reason FROM s LEFT JOIN t ON s.source = t.source")
def _(spark, sf):
    jobs = T(spark, sf, "jobs").withColumn("source", F.coalesce("worker_id", F.lit("none")))
    n = F.count("*")
    failures = F.max(F.when(F.col("id") % 4 == 0, F.col("attempts")).otherwise(0)) + n % 4
    state = jobs.groupBy("source").agg(failures.alias("failures"), F.lit(3).alias("threshold"), F.lit(4).alias("regions"), (n % 4).cast("int").alias("region_index"), (n % 5 == 0).alias("pending_rotation"))
    back = jobs.groupBy("source", (F.col("id") % 4).alias("region")).agg(F.count_if((F.col("status") == "failed") & (F.col("attempts") == 3)).alias("backlog"))
    return governance.chosen_regions(state, back)


_TILES = "SELECT id AS tile, last_error, id AS seed, 40e0 + CAST(floor(id / 100e0) % 10 AS DOUBLE) AS south, -90e0 + CAST(id % 100 AS DOUBLE) * 0.5e0 AS west FROM jobs"
_LATE = "CASE WHEN depth = 0 THEN coalesce(last_error LIKE 'Timeout%', false) ELSE seed % 3 = 0 END"


@query("S17_tile_split", X.sql("jobs").replace("WITH", "WITH RECURSIVE", 1) + f""", t AS (SELECT tile, last_error, seed, south, west, south + 1 AS north, west + 0.5e0 AS east FROM ({_TILES})),
  q AS (SELECT tile, last_error, seed, south, west, north, east, 0 AS depth, '' AS path FROM t UNION ALL SELECT tile, last_error, seed * 4 + k, CASE WHEN k >= 2 THEN (south + north) / 2 ELSE south END, CASE WHEN k % 2 = 1 THEN (west + east) / 2 ELSE west END, CASE WHEN k >= 2 THEN north ELSE (south + north) / 2 END, CASE WHEN k % 2 = 1 THEN east ELSE (west + east) / 2 END, depth + 1, path || k FROM q, range(4) r(k) WHERE depth < 3 AND {_LATE}),
  j AS (SELECT *, {_LATE} AS late FROM q), f AS (SELECT tile, path FROM j WHERE depth = 3 AND late), bad AS (SELECT DISTINCT tile, substr(path, 1, k) AS path FROM f, range(3) r(k))
  SELECT j.tile, j.path, j.depth, south, west, north, east, CASE WHEN depth = 3 AND late THEN 'failed' WHEN late AND bad.path IS NOT NULL THEN 'partial' ELSE 'success' END AS status, depth < 3 AND late AS is_split FROM j LEFT JOIN bad ON j.tile = bad.tile AND j.path = bad.path""")
def _(spark, sf):
    rows = T(spark, sf, "jobs").selectExpr("id AS tile", "last_error", "id AS seed", "40e0 + CAST(floor(id / 100e0) % 10 AS DOUBLE) AS south", "-90e0 + CAST(id % 100 AS DOUBLE) * 0.5e0 AS west")
    return tiles.run_tiles(rows.withColumns({"north": F.col("south") + 1, "east": F.col("west") + 0.5}), F.expr(_LATE), floor=3)

"""Place-domain tables as projections of the generic test tables; the same expressions serve Spark and the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-06-01 00:00:00"

# name -> (source relation in SQL, columns); the SQL is common to both engines
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "canonical": (
        "part",
        {
            "id": "p_partkey",
            "canonical_place_id": "CAST(p_partkey AS STRING)",
            "name": "p_name || ' ' || p_brand || ' Pizza'",
            "address": "CAST(p_partkey % 900 + 100 AS STRING) || ' Main Street, Detroit'",
            "state": "CASE p_partkey % 5 WHEN 0 THEN 'MI' WHEN 1 THEN 'NY' WHEN 2 THEN 'OH' WHEN 3 THEN 'mi' END",
            "google_place_id": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'osm:node/' || CAST(p_partkey AS STRING) END",
            "website_url": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE 'https://shop.example/s/' || CAST(p_partkey AS STRING) END",
            "phone": "CASE WHEN p_partkey % 29 = 0 THEN '' ELSE '555' || lpad(CAST(p_partkey % 997 AS STRING), 4, '0') END",
            "lat": "42e0 + (p_partkey % 40) * 0.02e0 + (p_partkey % 3) * 0.0001e0",
            "lng": "-84e0 + floor(p_partkey / 40e0) * 0.02e0",
            "lifecycle_status": "CASE WHEN p_partkey % 31 = 0 THEN 'closed' END",
            "style": "CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN 'Detroit' WHEN p_size % 4 = 2 THEN 'New York' ELSE 'Odd' END",
            "price_range": "CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN '$' ELSE '$$' END",
            "style_confidence": "CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 2 = 0 THEN 'inferred' ELSE 'confirmed' END",
            "brand_wikidata": "CASE WHEN p_partkey % 37 = 0 THEN 'Q' || CAST(p_partkey % 10 AS STRING) ELSE 'bad' END",
            "status": "CASE WHEN p_partkey % 6 = 0 THEN 'visited' WHEN p_partkey % 6 = 1 THEN 'unvisited' END",
            "rating": "CASE WHEN p_partkey % 9 = 0 THEN 4 END",
            "notes": "CASE WHEN p_partkey % 8 = 0 THEN ' ' WHEN p_partkey % 8 = 1 THEN 'good' END",
            "osm_tags": "CASE p_partkey % 4 WHEN 1 THEN '{\"cuisine\":\"pizza\",\"brand:wikidata\":\"Q' || CAST(p_partkey % 10 AS STRING) || '\"}' WHEN 2 THEN '{\"price_range\":\" $$ \",\"name\":\"detroit\"}' END",
            "scrape_notes": "CASE p_partkey % 5 WHEN 1 THEN '{\"a\":{\"priceRange\":\"$\"},\"t\":\"brooklyn slices\"}' WHEN 2 THEN 'coal fired $ pies' END",
            "scrape_method": "CASE p_partkey % 7 WHEN 0 THEN 'fetch' WHEN 1 THEN 'browser' WHEN 2 THEN 'none' END",
            "last_enriched_at": "CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN CAST('2024-05-31 12:00:00' AS TIMESTAMP) ELSE CAST('2024-04-01 00:00:00' AS TIMESTAMP) END",
            "menu_url": "CASE WHEN p_partkey % 4 = 0 THEN 'https://shop.example/menu' END",
            "email": "CASE WHEN p_partkey % 10 = 0 THEN 'a@shop.example' END",
            "hours": "CASE WHEN p_partkey % 5 = 0 THEN '10-22' END",
            "delivery": "p_partkey % 2 = 0",
            "takeaway": "p_partkey % 3 = 0",
        },
    ),
    "candidate": (
        "(SELECT * FROM customer CROSS JOIN (SELECT count(*) AS n FROM part)) JOIN part ON p_partkey = (c_custkey * 7) % n",
        {
            "source_id": "'fsq-' || CAST(c_custkey AS STRING)",
            "source": "CASE WHEN c_custkey % 3 = 0 THEN 'osm' WHEN c_custkey % 3 = 1 THEN 'fsq_os_places' ELSE 'all_the_places' END",
            "c_custkey": "c_custkey",
            "base": "p_partkey",
            "name": "CASE WHEN c_custkey % 11 = 10 THEN NULL WHEN c_custkey % 5 = 0 THEN p_name || ' ' || p_brand || ' Pizza' WHEN c_custkey % 5 = 1 THEN p_name || ' ' || p_brand || ' Pizza Express' WHEN c_custkey % 5 = 2 THEN 'The ' || p_name || ' ' || p_brand || ' House Kitchen' WHEN c_custkey % 5 = 3 THEN 'Zephyr Slice' ELSE 'Mama ' || p_name || ' ' || p_brand || ' Pizza' END",
            "lat": "42e0 + (p_partkey % 40) * 0.02e0 + (p_partkey % 3) * 0.0001e0 + (c_custkey % 7) * 0.00018e0",
            "lng": "-84e0 + floor(p_partkey / 40e0) * 0.02e0 + (c_custkey % 2) * 0.00005e0",
            "region": "CASE c_nationkey % 4 WHEN 0 THEN 'MI' WHEN 1 THEN 'ny' WHEN 2 THEN '' END",
            "phone": "CASE WHEN c_custkey % 13 = 0 THEN '1 (555) ' || lpad(CAST(p_partkey % 997 AS STRING), 4, '0') WHEN c_custkey % 13 = 1 THEN '555' || lpad(CAST(p_partkey % 997 AS STRING), 4, '0') ELSE '12' END",
            "website": "CASE WHEN c_custkey % 17 = 0 THEN ' HTTPS://www.Shop.example/s/' || CAST(p_partkey AS STRING) || '/' WHEN c_custkey % 17 = 1 THEN 'http://home.example/' END",
            "source_url": "CASE WHEN c_custkey % 19 = 1 THEN 'http://src.example/pizza|x' END",
            "category_text": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Food; Flatbread | Deli' WHEN 'MACHINERY' THEN 'Kitchen, ,Bar' ELSE '' END",
            "is_closed": "c_custkey % 19 = 0",
            "date_closed": "CASE c_custkey % 6 WHEN 0 THEN '2023-02-03' WHEN 1 THEN 'Unknown' WHEN 2 THEN '2031-01-01' WHEN 3 THEN ' ' WHEN 4 THEN 'soon' END",
        },
    ),
    "accepted": (
        "customer",
        {
            "source_id": "'a' || CAST(c_custkey AS STRING)",
            "lat": "42e0 + floor(c_custkey / 4e0) * 0.003e0 + CASE c_custkey % 4 WHEN 0 THEN 0e0 WHEN 1 THEN 0.000004e0 WHEN 2 THEN 0.0001e0 ELSE 0.001e0 END",
            "lng": "-84e0",
        },
    ),
    "queue": (
        "(SELECT * FROM customer CROSS JOIN (SELECT count(*) AS n FROM part)) JOIN part ON p_partkey = (c_custkey * 7) % n",
        {
            "id": "c_custkey",
            "entity_type": "CASE WHEN c_custkey % 10 = 9 THEN 'taco' ELSE 'pizza' END",
            "review_kind": "CASE WHEN c_custkey % 4 = 0 THEN 'ambiguous' ELSE 'likely_new' END",
            "source": "CASE WHEN c_custkey % 3 = 0 THEN 'osm' WHEN c_custkey % 3 = 1 THEN 'wikidata' ELSE 'all_the_places' END",
            "source_id": "CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'osm:node/' || CAST(p_partkey AS STRING) WHEN c_custkey % 3 = 1 THEN 'Q' || CAST(c_custkey % 10 AS STRING) ELSE 's' || CAST(c_custkey AS STRING) END",
            "source_name": "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN 'Pizza Hut' ELSE p_name || ' ' || p_brand || ' Pizza' END",
            "address": "CASE WHEN c_custkey % 2 = 0 THEN CAST(p_partkey % 900 + 100 AS STRING) || ' Main Street, Detroit' END",
            "phone": "CASE WHEN c_custkey % 3 = 2 THEN '(313) 555' || lpad(CAST(p_partkey % 997 AS STRING), 4, '0') ELSE '' END",
            "website": "CASE WHEN c_custkey % 2 = 0 THEN 'https://www.shop.example/s/' || CAST(p_partkey AS STRING) || '/' END",
            "lat": "CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE 42e0 + (p_partkey % 40) * 0.02e0 END",
            "lng": "-84e0 + floor(p_partkey / 40e0) * 0.02e0 + (c_custkey % 7) * 0.0001e0",
            "nearest_place_id": "p_partkey",
            "nearest_place_name": "CASE WHEN c_custkey % 8 = 1 THEN 'Pizza Hut Express' WHEN c_custkey % 8 = 2 THEN 'Domino''s' ELSE p_name || ' ' || p_brand || ' Pizza' END",
            "nearest_distance_m": "CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE (c_custkey % 40) * 5e0 END",
            "nearest_name_score": "(c_custkey % 21) / 20e0",
            "report_file": "CASE WHEN c_custkey % 8 = 1 THEN 'pizza_hut_us-review.json' WHEN c_custkey % 8 = 2 THEN 'dominos_pizza_us-review.json' ELSE 'other.json' END",
            "status": "CASE c_custkey % 5 WHEN 0 THEN 'linked' WHEN 1 THEN 'accepted' WHEN 2 THEN 'rejected' ELSE 'pending' END",
            "decision": "CASE WHEN c_custkey % 5 = 0 THEN 'imported_new' END",
            "canonical_place_id": "CASE WHEN c_custkey % 5 = 0 THEN p_partkey + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END END",
        },
    ),
    "evidence": (
        "orders",
        {
            "evidence_id": "o_orderkey",
            "entity_type": "'pizza'",
            "place_id": "o_custkey",
            "source": "CASE WHEN o_orderkey % 4 = 0 THEN 'osm' WHEN o_orderkey % 4 = 1 THEN 'fsq_os_places' WHEN o_orderkey % 4 = 2 THEN 'overture_places' ELSE 'wikidata' END",
            "source_id": "'s' || CAST(o_orderkey % 5000 AS STRING)",
            "website": "CASE WHEN o_orderkey % 3 = 0 THEN 'http://site' || CAST(o_custkey AS STRING) || '.example' WHEN o_orderkey % 3 = 1 THEN 'localhost' END",
            "phone": "CASE WHEN o_orderkey % 5 = 0 THEN '313-555-' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') WHEN o_orderkey % 5 = 1 THEN '12' END",
            "match_method": "CASE WHEN o_orderkey % 6 = 5 THEN 'weak_spatial_name' WHEN o_orderkey % 6 = 4 THEN 'reviewed_new_import' ELSE 'strong_spatial_name' END",
            "data": "CASE WHEN o_orderkey % 12 = 4 THEN '{\"review\":{\"queue_id\":\"' || CAST(o_orderkey % 1500 AS STRING) || '\"},\"imported_place\":{\"id\":' || CAST(o_custkey AS STRING) || ',\"name\":\"x\"}}' WHEN o_orderkey % 12 = 10 THEN '{\"review\":{\"queue_id\":\"\"}}' END",
            "match_confidence": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 0.8e0 + (o_orderkey % 20) / 100e0 END",
            "retrieved_at": "CAST(o_orderdate AS TIMESTAMP)",
        },
    ),
    "jobs": (
        "events",
        {
            "id": "event_id",
            "job_type": "CASE WHEN event_id % 3 = 0 THEN 'scrape' WHEN event_id % 3 = 1 THEN 'classify' ELSE 'menu_parse' END",
            "place_id": "event_id % 3000",
            "place_type": "CASE WHEN event_id % 5 = 0 THEN 'taco' ELSE 'pizza' END",
            "priority": "CASE event_id % 6 WHEN 0 THEN 100 WHEN 1 THEN 95 WHEN 2 THEN 80 WHEN 3 THEN 60 WHEN 4 THEN 50 ELSE 30 END",
            "status": "CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'processing' END",
            "worker_id": "CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'w' || CAST(user_id % 40 AS STRING) END",
            "attempts": "CAST(event_id % 4 AS INT)",
            "max_attempts": "3",
            "last_error": "CASE event_id % 14 WHEN 0 THEN 'HTTP 404' WHEN 1 THEN 'Timeout of 30s' WHEN 2 THEN 'HTTP 520' WHEN 3 THEN 'HTTP 503' WHEN 4 THEN 'fetch failed' WHEN 5 THEN 'Non-HTML content: image/png' WHEN 6 THEN 'getaddrinfo ENOTFOUND x.example' WHEN 7 THEN 'HTTP 401' WHEN 8 THEN 'Cached error: HTTP 403' WHEN 9 THEN 'read ECONNRESET' END",
            "created_at": "CAST(ts AS TIMESTAMP)",
        },
    ),
    "workers": (
        "events",
        {"worker_id": "'w' || CAST(user_id % 40 AS STRING)", "status": "CASE WHEN user_id % 2 = 0 THEN 'working' ELSE 'idle' END", "current_job_id": "event_id", "last_heartbeat": "CAST(ts AS TIMESTAMP)"},
    ),
    "permits": (
        "(SELECT * FROM part CROSS JOIN (SELECT count(*) AS n FROM supplier)) JOIN supplier ON s_suppkey = p_partkey % n",
        {
            "object_id": "p_partkey",
            "record_id": "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE 'BLD' || CAST(p_partkey % 700 AS STRING) END",
            "address": "CAST(p_partkey AS STRING) || ' West Grand Boulevard, Unit #' || CAST(p_size AS STRING)",
            "permit_type": "CASE p_partkey % 9 WHEN 0 THEN 'New' WHEN 1 THEN 'Demolition' WHEN 2 THEN 'Addition' WHEN 3 THEN 'Alteration' WHEN 4 THEN 'Electrical' WHEN 5 THEN NULL WHEN 6 THEN 'New Building' WHEN 7 THEN 'Remodel' ELSE 'Other' END",
            "proposed_use_type": "CASE p_size % 8 WHEN 0 THEN 'Single Family Dwelling' WHEN 1 THEN 'Barber Shop' WHEN 2 THEN 'Retail Store' WHEN 3 THEN 'Office' WHEN 4 THEN 'Warehouse' WHEN 5 THEN 'Unknown' WHEN 6 THEN NULL ELSE 'Plaza' END",
            "use_group": "CASE s_suppkey % 6 WHEN 0 THEN 'R-2' WHEN 1 THEN 'B' WHEN 2 THEN 'M' WHEN 3 THEN 'F-1' WHEN 4 THEN 'X' END",
            "cost": "CASE WHEN p_partkey % 8 = 0 THEN '50000 trailing' WHEN p_partkey % 8 = 1 THEN 'n/a' WHEN p_partkey % 8 = 2 THEN NULL ELSE CAST(CAST(floor(p_retailprice * (p_partkey % 700)) AS BIGINT) AS STRING) END",
            "num_units": "CASE WHEN p_partkey % 6 = 0 THEN '6 units' WHEN p_partkey % 6 = 1 THEN NULL ELSE CAST(p_size AS STRING) END",
            "issued": "p_partkey % 3 = 0",
            "latitude": "CASE WHEN p_partkey % 61 = 0 THEN 95e0 ELSE 42e0 END",
        },
    ),
    "plan_cases": (
        "supplier",
        {
            "plannumber": "CASE WHEN s_suppkey % 33 = 0 THEN NULL ELSE 'SP' || CAST(s_suppkey AS STRING) END",
            "address": "CAST(s_suppkey AS STRING) || ' S Main Street, Ann Arbor'",
            "type": "CASE s_suppkey % 8 WHEN 0 THEN 'Site Plan' WHEN 1 THEN 'Rezoning' WHEN 2 THEN 'Design Review' WHEN 3 THEN 'Annexation' WHEN 4 THEN 'AAPS' WHEN 5 THEN 'ZBA' WHEN 6 THEN NULL ELSE 'Land Division' END",
            "class": "CASE s_nationkey % 6 WHEN 0 THEN 'Residential PUD' WHEN 1 THEN 'Cafe' WHEN 2 THEN 'Commercial C1' WHEN 3 THEN 'Office Development' WHEN 4 THEN NULL ELSE 'School' END",
            "status": "CASE s_suppkey % 5 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Withdrawn' WHEN 2 THEN 'Fees Paid' WHEN 3 THEN NULL ELSE 'Open' END",
            "completeyear": "CASE WHEN s_suppkey % 4 = 0 THEN 2020 END",
        },
    ),
    "sync_local": (
        "part",
        {
            "id": "p_partkey",
            "name": "p_name",
            "state": "CASE p_partkey % 3 WHEN 0 THEN 'MI' WHEN 1 THEN ' mi' ELSE '' END",
            "google_place_id": "CASE WHEN p_partkey % 27 = 0 THEN NULL ELSE 'g' || CAST(p_partkey AS STRING) END",
            "lat": "42e0 + (p_partkey % 100) * 0.01e0",
            "lng": "-84e0",
            "style": "CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'Detroit' END",
            "price_range": "CASE WHEN p_size % 4 = 0 THEN NULL ELSE '$' END",
            "phone": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE ' 555' || CAST(p_size AS STRING) END",
            "lifecycle_status": "CASE WHEN p_size % 9 = 0 THEN 'closed' END",
            "last_enriched_at": "CAST('2024-05-01 00:00:00' AS TIMESTAMP)",
        },
    ),
    "sync_public": (
        "part",
        {
            "id": "p_partkey",
            "name": "CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END",
            "state": "'MI'",
            "google_place_id": "CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 35 = 1 THEN 'other' ELSE 'g' || CAST(p_partkey AS STRING) END",
            "lat": "42e0 + (p_partkey % 100) * 0.01e0 + (p_partkey % 8) * 0.0001e0",
            "lng": "-84e0",
            "style": "CASE WHEN p_size % 2 = 0 THEN 'Detroit' END",
            "price_range": "CASE WHEN p_size % 7 = 0 THEN '$$' ELSE '$' END",
            "phone": "'555' || CAST(p_size AS STRING)",
            "lifecycle_status": "CASE WHEN p_size % 6 = 0 THEN 'closed' END",
            "qa_status": "CASE WHEN p_size % 11 = 0 THEN NULL ELSE 'reviewed' END",
        },
    ),
}


def sql(*names: str) -> str:
    """WITH clauses that define the named tables for the oracle."""
    parts = [f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in TABLES[n][1].items())} FROM {TABLES[n][0]})" for n in names]
    return "WITH " + ", ".join(parts) + " "


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A place-domain table over the parquet files of `sf_dir`. The join with part is sorted: by the size of the one column read, Spark would broadcast millions of keys."""
    source, columns = TABLES[name]
    read = lambda t: raw(spark, sf_dir, t)
    if source in ("part", "orders", "events", "supplier", "customer"):
        base = read(source)
    elif "customer" in source:
        base = read("customer").crossJoin(F.broadcast(read("part").agg(F.count("*").alias("n"))))  # one row
        base = base.withColumn("_base", F.expr("(c_custkey * 7) % n")).join(read("part").hint("merge"), F.col("_base") == F.col("p_partkey"))
    else:
        base = read("part").crossJoin(F.broadcast(read("supplier").agg(F.count("*").alias("n"))))  # one row
        base = base.withColumn("_base", F.expr("p_partkey % n")).join(read("supplier"), F.col("_base") == F.col("s_suppkey"))
    return base.selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))

"""Boundary values of the place engine, its file readers, contracts and streams."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from placeforge.functions import geo, identity, text
from placeforge.operators import constraints, delivery, governance, jobs, matching, pages, publish, review, rules
from placeforge.operators.order import running
from placeforge.plans import contracts, queries, source_queries, workflow_queries  # noqa: F401  (the last two register their queries)
from placeforge.sources import artifacts, feeds, paged, positions, snapshots, tiles
from placeforge.streaming import cycles, state
from placeforge.streaming import pages as pages_source


def values(spark, column, *inputs):
    rows = spark.createDataFrame([(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)], "i int, " + ", ".join(f"{c} string" for c in "abcd"[: len(inputs[0]) if isinstance(inputs[0], tuple) else 1]))
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


@pytest.fixture(autouse=True)
def columns(spark):
    global A, B
    A, B = F.col("a"), F.col("b")


def test_names_and_identifiers(spark):
    pairs = [("Café & Pizza", "Cafe and Pizza"), ("Little Caesars", "Little Caesars Express"), ("Pizza", "Pizza"), ("Pizza", "Pizzeria"), ("foo foo", "foo bar"), ("foo bar", "foo foo"), (None, "x")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").withColumns({"a": text.normalized(A), "b": text.normalized(B)})
    assert [r[0] for r in rows.orderBy("i").select(text.name_score(A, B)).collect()] == [1, 0.85, 1, 0, 1, 0.5, 0]
    assert values(spark, text.phone_key(A), "+1 (313) 555-0199", "555-0199", "123456", None) == ["3135550199", "5550199", "", ""]
    assert values(spark, text.url_key(A), "HTTPS://WWW.Example.com/store/", None) == ["example.com/store", ""]


def test_numbers_dates_and_addresses(spark):
    assert values(spark, text.finite_number(A), None, "", " 12 ", "12d", "0x10", "Infinity", "-1.5e2", "x") == [0, 0, 12, None, 16, None, -150, None]
    closed = text.closed_date(A, F.lit("2024-06-01").cast("timestamp"))
    assert values(spark, closed, None, " ", "Unknown", "2023-01-01", "2030-01-01", "soon") == [False, False, False, True, False, True]
    assert values(spark, text.address_hash(A), "123 Main Street, Detroit", "") == ["8iesdn", "0"]
    assert values(spark, text.number_prefix(A), "50000 trailing", "n/a", "2.5 x") == [50000, None, 2.5]
    assert values(spark, text.number_prefix(A, True), "6 units", "x") == [6, None]
    assert values(spark, F.array_join(text.flat_strings(A), "+"), "a; b|c,,d", '["x, y", "z"]', None, "[bad") == ["a+b+c+d", "x+y+z", "", "[bad"]


def test_websites(spark):
    got = values(spark, text.canonical_website(A), "Example.com", "'https://u:p@Ex.com:443/a?utm_source=x&b=1#f'", "mailto:a@b.c", "", "http://ex.com:80/x?fbclid=1")
    assert got == ["https://example.com/", "https://ex.com/a?b=1", None, None, "http://ex.com/x"]


def test_method_thresholds(spark):
    cases = [(25, 0.99, False, "exact_name_nearby"), (25.1, 0.99, False, "strong_spatial_name"), (75, 0.99, False, "strong_spatial_name"), (75.1, 0.99, False, "weak_spatial_name"), (50, 0.6, False, "strong_spatial_name"), (50.1, 0.6, False, "weak_spatial_name"), (100, 0.35, False, "weak_spatial_name"), (100.1, 1.0, True, "no_match"), (100, 0.34, False, "no_match"), (25, 0.0, False, "spatial_only_review"), (25.1, 0.0, False, "no_match"), (100, 0.01, True, "exact_identifier_nearby"), (100, 0.0, True, "spatial_only_review")]
    rows = spark.createDataFrame([(float(d), float(s), e, m) for d, s, e, m in cases], "d double, s double, e boolean, m string")
    assert all(r[0] == r.m for r in rows.select(matching.match_method(F.col("d"), F.col("s"), F.col("e")), "m").collect())


def brute_match(candidate, places):
    import math

    def metres(a, b, c, d):
        r = math.radians
        v = math.sin(r(c - a) / 2) ** 2 + math.cos(r(a)) * math.cos(r(c)) * math.sin(r(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(min(1, math.sqrt(v)))

    near = sorted((metres(candidate[1], candidate[2], p[1], p[2]), p[0]) for p in places)
    return [(p, round(d, 3)) for d, p in near if d <= 100][:10]


def test_grid_join_equals_all_pairs(spark):
    import random

    r = random.Random(1)
    places = [(f"p{k:03}", 42 + r.random() * 0.04, -83 + r.random() * 0.04) for k in range(400)]
    own = [(f"c{k}", 42 + r.random() * 0.04, -83 + r.random() * 0.04) for k in range(120)]
    left = spark.createDataFrame([(i, "Pizza", a, b, None, None) for i, a, b in own], "source_id string, name string, lat double, lng double, website string, phone string")
    right = spark.createDataFrame([(i, "Pizza", None, None, None, a, b) for i, a, b in places], "canonical_place_id string, name string, google_place_id string, website_url string, phone string, lat double, lng double")
    got = {}
    for x in matching.evaluated(left, matching.prefetch(right, left)).collect():
        got.setdefault(x.source_id, []).append((x.canonical_place_id, round(x.distance_m, 3)))
    for c in own:
        assert sorted(got.get(c[0], [])) == sorted(brute_match(c, places))


def test_nearest_ten_are_cut_before_scoring(spark):
    near = [(f"p{k}", f"Other {k}", None, None, None, 42.0 + k * 1e-6, -83.0) for k in range(10)]
    right = spark.createDataFrame(near + [("z", "Joe", None, None, "3135550199", 42.0005, -83.0)], "canonical_place_id string, name string, google_place_id string, website_url string, phone string, lat double, lng double")
    left = spark.createDataFrame([("c", "Joe", 42.0, -83.0, None, "313-555-0199")], "source_id string, name string, lat double, lng double, website string, phone string")
    assert all(r.canonical_place_id != "z" for r in matching.evaluated(left, right).collect())


def test_a_default_point_keeps_its_first_ten(spark):
    kind = "canonical_place_id string, name string, google_place_id string, website_url string, phone string, lat double, lng double"
    right = spark.createDataFrame([(f"p{k:04}", "X", None, None, None, 42.0, -83.0) for k in range(3000)] + [("a", "X", None, None, None, 42.0001, -83.0)], kind)
    left = spark.createDataFrame([(f"c{k}", "X", 42.0, -83.0, None, None) for k in range(5)], "source_id string, name string, lat double, lng double, website string, phone string")
    got = {}
    for r in matching.evaluated(left, right).collect():
        got.setdefault(r.source_id, set()).add(r.canonical_place_id)
    assert got == {f"c{k}": {f"p{i:04}" for i in range(10)} for k in range(5)}


def test_routes(spark):
    rows = [(None, 42.0, -83.0, "MI", False), ("Pizza", 0.0, 0.0, "MI", False), ("Bank", 42.0, -83.0, None, False), ("Pizza", 42.0, -83.0, "XX", True), ("Pizza", 43.0, -75.0, "", False), ("Pizza", 43.0, -75.0, "VT", False), ("Pizza", None, None, None, False)]
    frame = spark.createDataFrame([(*r, [], None, None) for r in rows], "name string, lat double, lng double, region string, is_closed boolean, categories array<string>, website string, source_url string")
    got = [r.route for r in matching.route(frame.coalesce(1)).collect()]
    assert got == ["excluded_unusable", "excluded_out_of_scope", "filtered_non_pizza", "closed_evidence_candidate", "ready_for_match", "excluded_out_of_scope", "excluded_unusable"]


def test_rules(spark):
    style, confidence, source = rules.style_from_name(A, B)
    both = F.concat_ws("/", style, confidence, source)
    assert values(spark, both, ("ST. Louis  Pizza", None), ("Joe's Brooklyn", None), ("Plain", "1 Detroit Ave"), ("Plain", None)) == ["St. Louis/high/chain_map", "New York/medium/keyword", "Detroit/low/address_keyword", ""]
    assert values(spark, rules.normalized_style(A), "Standard, Detroit", "x", " ", None) == ["Detroit", "Unknown", None, None]
    assert values(spark, rules.detroit_category(A, B), ("Barber", None), ("x", "M"), ("x", "R-1"), ("plaza", None)) == ["FOOD", "RETAIL", "HOUSING", "OTHER"]
    assert values(spark, rules.has_words(A, ("carne asada",)), "a carne-asada b", "carne asadas") == [True, False]


def test_upserts_and_ledger(spark):
    old = spark.createDataFrame([(1, "a", "pending"), (2, "b", "linked")], "id int, v string, status string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    got = {r.id: (r.v, r.status) for r in review.upsert_pending(old, new, ["id"]).collect()}
    assert got == {1: ("x", "pending"), 2: ("b", "linked"), 3: ("z", "pending")}
    commands = spark.createDataFrame([("s", 1, "A"), ("s", 2, "B"), ("s", 3, "A"), ("s", 4, "A"), ("t", 5, "A")], "source_id string, object_id int, version string")
    ledger = spark.createDataFrame([("s", "A")], "source_id string, version string")
    assert {r.object_id: r.changed for r in publish.ledger_changes(commands, ledger).collect()} == {1: False, 2: True, 3: True, 4: False, 5: True}


def test_feeds(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,lat\n1,"Joe ""P"", x\ny",42\n,,\n2,Al\n')
    rows = [r.fields for r in feeds.read_feed(spark, f"{tmp_path}/a.csv").collect()]
    assert rows == [{"id": "1", "name": 'Joe "P", x\ny', "lat": "42"}, {"id": "2", "name": "Al", "lat": ""}]
    (tmp_path / "b.jsonl").write_text('{"ID": 1, "Title": "Pizza", "Latitude": "42", "lon": -83}\n\n{"id": 2}\n')
    got = feeds.normalize_feed(feeds.read_feed(spark, f"{tmp_path}/b.jsonl"), "fsq_os_places", "2024-06-01").orderBy("source_id").collect()
    assert [(r.source_id, r.name, r.lat, r.lng) for r in got] == [("1", "Pizza", 42.0, -83.0), ("2", None, 0.0, 0.0)]
    feature = {"type": "Feature", "id": "f1", "properties": {"name": "P", "lat": 1.5}, "geometry": {"type": "Point", "coordinates": [-83, 42]}}
    for name, document in (("c.geojson", {"type": "FeatureCollection", "features": [feature]}), ("d.json", [feature]), ("e.json", {"places": [{"id": "f1"}]}), ("f.json", feature)):
        (tmp_path / name).write_text(json.dumps(document))
        fields = feeds.read_feed(spark, f"{tmp_path}/{name}").collect()[0].fields
        assert fields["id"] == "f1" and (name == "e.json" or (fields["latitude"], fields["longitude"], fields["name"]) == ("1.5", "-83", "P"))
    (tmp_path / "g.json").write_text("{}")
    with pytest.raises(Exception, match="JSON input"):
        feeds.read_feed(spark, f"{tmp_path}/g.json").collect()


def test_identity_golden():
    assert identity.digest({"é": 1, "z": 2, "a": 3}) == "sha256:fa7ddcf43923b2711f2f592f210e5ab9e4a54a3b2df09830d93f402391a33e4e"
    assert identity.canonical_json({"b": [1.0, None], "a": "x"}) == '{"a":"x","b":[1,null]}'
    with pytest.raises(ValueError):
        identity.canonical_json(float("nan"))


def test_identity_columns_equal_the_python_digest(spark):
    got = values(spark, identity.source_record_key("p", "n", A), 'a"b', "é\n")
    assert got == ["srk_" + identity.digest({"profile": "p", "sourceNamespace": "n", "externalId": x})[7:] for x in ('a"b', "é\n")]


def test_tiles(spark):
    got = sorted((r.south, r.west, r.north, r.east) for r in tiles.grid(spark, (0.0, 0.0, 1.0, 0.5), 0.4).collect())
    assert got == [(0.0, 0.0, 0.4, 0.4), (0.0, 0.4, 0.4, 0.5), (0.4, 0.0, 0.8, 0.4), (0.4, 0.4, 0.8, 0.5), (0.8, 0.0, 1.0, 0.4), (0.8, 0.4, 1.0, 0.5)]
    assert values(spark, tiles.region_priority(A, B), ("mi", None), ("NY", None), ("VT", None), ("ON", None), ("x", "MX"), ("FR", None), ("BRA", None), (None, "CA")) == [100, 95, 80, 60, 55, 50, 40, 30]


def test_pages(spark):
    html = '<body>Open 9am - 5 PM. Call (313) 555-0199. Detroit slices $8 and $9.50 <a href="/m">Our Menu</a><script type="application/ld+json">{"hasMenuItem": [{"name": "A", "price": 3}, {"name": "a", "price": 3}]}</script></body>'
    r = pages.page_facts(spark.createDataFrame([(1, "http://x.example/p", html), (2, None, None)], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert (r[0].phone, r[0].has_hours, r[0].price_hint, r[0].menu_url, r[0].style_hints, r[0].n_jsonld) == ("3135550199", True, "$", "http://x.example/m", ["detroit"], 1)
    assert r[1].excerpt == "" and r[1].price_hint is None
    menu = pages.menu_of(json.dumps({"jsonld": [json.loads(r[0].jsonld[0])]}), "http://x.example")
    assert menu == {"menu_urls": [], "items": [{"name": "A", "price": "3"}], "confidence": "high"}
    assert pages.menu_of("free text", None) is None


def test_contracts(spark):
    one = spark.range(3)
    stages = [contracts.Stage("a", lambda s, i: {"out": one}), contracts.Stage("b", lambda s, i: {"out": i["x"].where("id > 0")}, {"x": "a.out"}, sink=True)]
    events = []
    assert contracts.run(spark, stages, events)[("b", "out")].count() == 2 and events == ["a", "b"]
    assert contracts.issues([contracts.Stage("a", None, {"x": "b.out"}), contracts.Stage("a", None, sink=True)])
    assert contracts.same_rows(one, spark.range(3)) and not contracts.same_rows(one, spark.range(4))
    ask = {"effect": "public.write", "stage": "s", "uri": "db://x/t", "operation": "upsert", "records": 5}
    grant = {**{k: ask[k] for k in ("effect", "stage", "uri")}, "operations": ["upsert"], "max_records": 5, "verification": "post_read"}
    contracts.authorize("apply", ask, ("public.write",), [grant])
    for mode, change, declared in (("plan", {}, ("public.write",)), ("apply", {"records": 6}, ("public.write",)), ("apply", {}, ()), ("preview", {}, ("public.write",)), ("apply", {"uri": "db://u@x/t"}, ("public.write",))):
        with pytest.raises(contracts.EffectDenied):
            contracts.authorize(mode, ask | change, declared, [grant])
    assert contracts.admit({"cpu": 4}, {"cpu": 3}, {"cpu": 1}) == (True, []) and contracts.admit({"cpu": 4}, {"cpu": 4}, {"cpu": 1}) == (False, ["cpu"])
    with pytest.raises(ValueError, match="repeated"):
        contracts.strict_json('{"a":1,"a":2}')


def test_artifacts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    digest, path = artifacts.write_artifact(rows, str(tmp_path))
    assert artifacts.write_artifact(rows.repartition(3), str(tmp_path))[0] == digest
    assert artifacts.read_artifact(spark, str(tmp_path), digest).count() == 3
    rows.limit(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError):
        artifacts.read_artifact(spark, str(tmp_path), digest)


def test_job_stream(spark, tmp_path):
    spark.createDataFrame([(1, "add", None, 1), (1, "claim", None, 2), (1, "fail", "x", 3), (1, "claim", None, 4), (1, "complete", None, 5), (2, "add", None, 1), (2, "complete", None, 2), (3, "claim", None, 1)], "job_id long, event string, error string, t long").selectExpr("job_id", "event", "error", "timestamp_seconds(t) AS ts").write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(state.EVENTS).parquet(f"{tmp_path}/events")
    query = state.job_states(stream).writeStream.format("memory").queryName("job_states").outputMode("update").option("checkpointLocation", f"{tmp_path}/ck").start()
    query.processAllAvailable()
    query.stop()
    assert {r.job_id: (r.status, r.attempts) for r in spark.table("job_states").collect()} == {1: ("completed", 2), 2: ("pending", 0), 3: ("", 0)}
    seen = []
    page = state.deliver_pages(spark.readStream.schema(state.EVENTS).parquet(f"{tmp_path}/events"), lambda rows, number: seen.append((number, rows.count())), f"{tmp_path}/ck2")
    page.awaitTermination()
    assert seen == [(0, 8)]


def test_jobs_and_scalars(spark):
    assert values(spark, jobs.permanent_error(A), "HTTP 404", "HTTP 530", "HTTP 401", "HTTP 4040", "Non-HTML content: image/png", "getaddrinfo ENOTFOUND x", "timeout", None) == [True, True, False, False, True, True, False, False]
    assert values(spark, jobs.retryable_error(A), "HTTP 503", "HTTP 530", "fetch failed", "fetch failed twice", "HTTP 404", None) == [True, True, True, False, False, False]
    row = spark.createDataFrame([(2202.0, 16.0)], "c double, d double")
    assert row.select(jobs.backlog_hours(F.col("c"), F.col("d"), 1)).first()[0] == 137.625
    assert abs(row.select(geo.haversine(F.lit(42.0), F.lit(-83.0), F.lit(42.001), F.lit(-83.0))).first()[0] - 111.19) < 0.01


def test_prefetch_keeps_places_where_they_are(spark):
    import random

    r = random.Random(2)
    spots = [(f"p{k % 280}", 41.9 + r.random() * 2.2, -84.1 + r.random() * 2.2) for k in range(300)]  # some ids stand at two points
    places = spark.createDataFrame(spots, "canonical_place_id string, lat double, lng double")
    own = spark.createDataFrame([(42.2, -83.9), (42.999, -83.0005), (43.0005, -82.5)], "lat double, lng double")
    boxes = matching.prefetch_boxes(own).collect()
    got = matching.prefetch(places, own)
    hit = lambda p: any(abs(p[1] // 1 - b.ty) <= 1 and abs(p[2] // 1 - b.tx) <= 1 and b.s <= p[1] <= b.n and b.w <= p[2] <= b.e for b in boxes)
    spots_in = [(b.s + 1e-5, b.w + 1e-5) for b in boxes]
    assert matching.prefetch(spark.createDataFrame([("x", *x) for x in spots_in] + [("x", 10.0, 10.0)], places.schema), own).count() == len(spots_in)
    assert sorted(map(tuple, got.collect())) == sorted(p for p in spots if hit(p))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and plan.count("Join") == 1  # places are read once and meet the tiles only


def test_grid_joins_never_broadcast_a_whole_table(spark, tmp_path):
    # 200,000 places of equal text: a file of a few kB that Spark's size check takes for a small table
    spark.range(200_000).selectExpr("'p' as canonical_place_id", "repeat('x', 200) as name", "'' as website_url", "'' as phone", "42e0 as lat", "cast(id div 1000 as double) as lng").write.parquet(str(tmp_path / "places"))
    places = spark.read.parquet(str(tmp_path / "places"))
    own = spark.createDataFrame([("c", "x", 42.0, 7.0, "", "")], "source_id string, name string, lat double, lng double, website string, phone string")
    sides = places.selectExpr("canonical_place_id as source_id", "lat", "lng")
    for frame in (matching.evaluated(own, places), matching.nearby_places(own, places.selectExpr("*", "'' as lifecycle_status")), matching.nearest_sibling(sides), matching.same_coordinates(own, sides)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert matching.evaluated(own, places).count() == 10


def test_address_hash_of_all_signs_in_one_pass(spark):
    def plain(t):
        raw, h = t.encode("utf-16-be"), 0
        for i in range(0, len(raw), 2):
            h = (h * 31 + raw[i] * 256 + raw[i + 1]) & 0xFFFFFFFF
        h, out = (1 << 32) - h if h >= 1 << 31 else h, ""
        while h:
            h, k = divmod(h, 36)
            out = "0123456789abcdefghijklmnopqrstuvwxyz"[k] + out
        return out or "0"

    rows = spark.createDataFrame([(x,) for x in ("12 Main Street", "", None, "\U0001f600 x", "\U0010ffff a\U00010000b", "\u6f22\u5b57 9", "y" * 5000)], "a string").select(text.short_address(A).alias("s"), text.address_hash(A).alias("h"))
    assert all(r.h == plain(r.s) for r in rows.collect())
    made = rows.select("h")._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("regexp_replace(") == 2 + len(text.STREET_WORDS)  # the address is made once, not for each letter


def test_numbering_searches_its_bounds(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 50 <> 0 THEN CAST(id * 7919 % 3001 AS STRING) END AS a", "id AS b")
    out = running(rows, ["a", "b"])
    want = sorted(((r.a or "", r.b) for r in rows.collect()))
    assert [(r.a or "", r.b) for r in out.orderBy("number").collect()] == want
    assert "filter(array" not in out._jdf.queryExecution().analyzed().toString()  # not every bound is compared with every row


def test_delivery_reads_its_rows_for_numbers_only(spark):
    rows = spark.range(50).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    made = delivery.delivery_pages(rows, ["k"], 4)
    assert "Range (" not in made._jdf.queryExecution().analyzed().toString()  # the pages are numbered without their rows
    assert sorted((r.start, r.end) for r in made.collect()) == [(k, min(k + 4, 50)) for k in range(0, 50, 4)]


def test_prompt_reads_json_once(spark):
    rows = spark.createDataFrame([("""{"jsonld":[{"name":"A"}],"text_excerpt":"x","price_hint":"$"}""",)], "a string").select(governance.pruned_notes(A).alias("x"))
    assert json.loads(rows.first().x) == {"jsonld": [{"name": "A"}], "price_hint": "$"}
    assert rows._jdf.queryExecution().analyzed().toString().lower().count("try_parse_json") <= 1 and rows._jdf.queryExecution().analyzed().toString().count("style_hints string") <= 1


@pytest.fixture
def small_tables(spark, tmp_path):
    def write(name, rows, kinds):
        spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("part", [(k, "n", "b", "t", 1, 9.0) for k in (0, 600_001)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    write("customer", [(k, "c", 1, 1.0, "x") for k in (2, 3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("supplier", [(k, f"s{k}", 1, 5.0) for k in range(3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    write("lineitem", [(0, 3.0, "R", 1), (0, 3.0, "N", 1), (1, 3.0, "N", 1), (1, 50.0, "N", 7)], "l_suppkey long, l_quantity double, l_returnflag string, l_linenumber int")
    return str(tmp_path)


def test_preflight_counts_every_line(spark, small_tables):
    got = {r.spider: r.preflight for r in queries.QUERIES["S10_preflight"](spark, small_tables).collect()}
    assert got == {"s0": "warning", "s1": "ok", "s2": "missing"}


def test_preflight_warns_of_any_returned_line(spark, tmp_path):
    spark.createDataFrame([(k, f"s{k}", a) for k, a in ((0, 5.0), (1, 5.0), (2, 5.0), (3, -1.0))], "s_suppkey long, s_name string, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = [(0, "R"), (0, "N"), (0, "A"), (0, None), (1, "N"), (1, "A"), (3, "R")]  # one of four came back
    spark.createDataFrame(lines, "l_suppkey long, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.spider: r for r in queries.QUERIES["S10_preflight"](spark, str(tmp_path)).collect()}
    assert {k: r.preflight for k, r in got.items()} == {"s0": "warning", "s1": "ok", "s2": "missing"}
    assert {k: (r.features, r.warnings) for k, r in got.items()} == {"s0": (4, 1), "s1": (2, 0), "s2": (None, None)}


def test_longitudes_of_large_tables_go_round(spark, tmp_path):
    spark.range(700_000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(99_003, 1, "x")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))  # its place stands 346 degrees east of the first
    assert [tuple(r) for r in queries.QUERIES["N16_V2_host_projection"](spark, str(tmp_path)).collect()] == [("projected", 1)]


def test_folding_of_every_sign(spark):
    import re
    import unicodedata

    def plain(t):
        low = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not "\u0300" <= c <= "\u036f")
        return re.sub("[^a-z0-9]+", " ", low.replace("&", " and ")).strip(" ")

    texts = ["".join(text.SEVERAL), " ".join(text.SEVERAL), "Caf\u00e9 \u00bd & \ufb03 \u33a5 \U0001f100 x\u2026", "\u6f22\u5b57" * 3000 + "\u00bc", "plain & simple", "", None]
    want = [plain(x or "") for x in texts]
    got = values(spark, text.normalized(A), *texts)
    assert [g for x, g in zip(texts[2:], got[2:], strict=True)] == want[2:]
    for c in text.SEVERAL:
        assert all(x in want[1] for x in plain(c).split())
    made = spark.createDataFrame([("x",)], "a string").select(text.normalized(A))._jdf.queryExecution().analyzed().toString()
    assert "\ufb03" not in made  # no class of all such signs is tried at each letter


def test_pages_are_parsed_in_slices(spark):
    import pyarrow as pa

    seen = []
    rows = [(k, "http://x.example/", f"<p>{k}</p><a href='/m'>Menu</a>") for k in range(200)] + [(None, None, None)]
    class Caught:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            seen.extend(run(iter([pa.RecordBatch.from_pylist([dict(zip(("page_id", "url", "html"), r, strict=True)) for r in rows])])))

    pages.parsed_pages(Caught())
    assert max(b.num_rows for b in seen) <= pages.SLICE and [x["body"] for b in seen for x in b.to_pylist()] == [*(f"{k}Menu" for k in range(200)), ""]


def test_running_numbers_and_sums(spark):
    rows = [(k * 37 % 101, k) for k in range(300)] + [(None, 5), (None, 7)]
    got = running(spark.createDataFrame(rows, "a int, b int"), ["a", "b"], {"total": F.col("b")}, parts=7).orderBy("number").collect()
    want = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    assert [(r.a, r.b) for r in got] == want and [r.number for r in got] == list(range(1, 303))
    assert [r.total for r in got] == [sum(b for _, b in want[: k + 1]) for k in range(302)]
    assert running(spark.createDataFrame([], "a string"), ["a"]).count() == 0
    same = running(spark.range(2000).selectExpr("1 AS a", "id % 3 AS b"), ["a"], parts=16)
    assert sorted(r.number for r in same.collect()) == list(range(1, 2001))  # one frequent key is cut too


def test_evidence_rules(spark):
    known = rules.evidence_text(B)
    assert values(spark, rules.has_style_evidence(A, known), ("Detroit", "A DETROIT pie"), ("Detroit", "pizza"), ("Other", None), (None, "x"), ("Odd", "odd")) == [True, False, True, True, False]
    assert values(spark, rules.has_taco_evidence(A, known), ("Al Pastor", "tacos al-pastor!"), ("Al Pastor", "pastoral"), ("Pollo", "chicken"), ("Odd", "odd")) == [True, False, True, False]
    cases = [("$$", '{"a": {"PriceRange": " $$ "}}'), ("$", '{"price_range": "$$"}'), ("$", "menu $ 9"), ("$", '[{"price:range":"$"}]'), (None, None), ("cheap", '{"price_range":"cheap"}')]
    assert values(spark, rules.has_price_evidence(A, B), *cases) == [True, False, False, True, True, False]
    assert values(spark, rules.taco_types(A, F.lit(""))[2], "Wahoo's Fish Taco", "BARTACO", "Taco Bell", "x") == ["$$$", "$$", "$", None]
    answer = governance.model_result(A, known, [B], "taco")
    assert values(spark, answer[0], ('{"style": "Al Pastor, Birria, Odd"}', "al pastor"), ('{"style": "Birria"}', "x"), ("no", None)) == ["Al Pastor", None, None]


def test_snapshot_pages_fail_and_never_cut(spark):
    rows = spark.createDataFrame([(f"k{n}", "x" * n) for n in range(6)], "id string, v string")
    page = snapshots.snapshot_page(rows, "id", ["id", "v"], "k0", 4, 20, 1000).orderBy("cursor").collect()
    assert [r.cursor for r in page] == ["k1", "k2", "k3", "k4"] and [r.payload is None for r in page] == [False, False, True, True]
    assert page[0].payload == '{"id":"k1","v":"x"}' and page[1].bytes_so_far == page[0].payload_bytes + page[1].payload_bytes + 2
    with pytest.raises(Exception, match="byte limits"):
        snapshots.whole_page(snapshots.snapshot_page(rows, "id", ["id", "v"], None, 6, 20, 1000)).collect()
    with pytest.raises(ValueError, match="limit"):
        snapshots.snapshot_page(rows, "id", ["id"], page_rows=5001)


def test_record_counts_and_reports(spark):
    assert values(spark, snapshots.record_count(A), "[]", "[1,2]", "null", None, '{"rows":[1]}', '{"rows":{}}', "3") == [0, 2, 0, 0, 1, 1, 1]
    with pytest.raises(Exception, match="several"):
        values(spark, snapshots.record_count(A), '{"rows":[1],"places":[]}')
    assert snapshots.markdown_table(["a", "b"], [{"a": "x|y", "b": None}]) == "| a | b |\n| --- | --- |\n| x\\|y |  |"
    assert snapshots.markdown_table(["a"], []) == "_none_"
    rows = spark.createDataFrame([('say "hi", you', None)], "a string, b int")
    assert [r.line for r in snapshots.csv_lines(rows, ["a", "b"]).collect()] == ["a,b", '"say ""hi"", you",']


def test_spiders_take_turns(spark):
    manifest = spark.createDataFrame([(f"s{k}", k != 2, "g") for k in range(6)], "spider string, import_enabled boolean, group string")
    assert sorted((r.turn, r.spider) for r in snapshots.spiders(manifest, 3, 3).collect()) == [(0, "s4"), (1, "s5"), (2, "s0")]


def test_deliveries_are_acknowledged_page_by_page(spark):
    rows = spark.createDataFrame([(n, f"r{n}") for n in range(1, 8)], "k long, id string")
    pages = delivery.delivery_pages(rows, ["k"], 4)
    state_ = {"offset": 0, "prefix": None, "complete": False, "pending": None}
    first = delivery.next_page(pages, state_)
    assert (first["pending"]["start"], first["pending"]["end"], first["pending"]["last"]) == (0, 4, False)
    assert delivery.next_page(pages, first) == first
    with pytest.raises(ValueError, match="acknowledgement"):
        delivery.acknowledged(first, "other")
    state_ = delivery.acknowledged(first, first["pending"]["page_id"])
    second = delivery.next_page(delivery.delivery_pages(rows.repartition(3), ["k"], 4), state_)
    assert second["pending"]["end"] == 7 and second["pending"]["last"]
    with pytest.raises(ValueError, match="changed"):
        delivery.next_page(delivery.delivery_pages(rows.withColumn("id", F.upper("id")), ["k"], 4), state_)
    assert delivery.next_page(pages, delivery.acknowledged(second, second["pending"]["page_id"]))["pending"] is None
    assert delivery.delivery_pages(rows.limit(0), ["k"], 4).count() == 0


def test_scans_resume_at_file_and_row(spark, tmp_path):
    for k, n in enumerate((5, 0, 7, 4)):
        spark.range(k * 100, k * 100 + n).selectExpr("id", "repeat('x', cast(id % 3 as int)) AS text").coalesce(1).write.parquet(f"{tmp_path}/feed/{k}")
    rows = positions.located(spark, [f"{tmp_path}/feed/{k}" for k in (0, 2, 3)], "id long, text string")
    files = positions.pinned(rows)
    digest = positions.files_digest(files)
    wanted, size = F.col("id") % 2 == 0, F.length("text")
    at, seen, scanned = positions.Position(), [], 0
    for _ in range(20):
        page = positions.scan_page(rows, files, at, wanted, size, most_files=2, most_rows=4, limit=2, most_bytes=3)
        seen += sorted(r.id for r in page.rows.collect())
        scanned, at = scanned + page.scanned, page.next
        if page.complete:
            break
    everything = [*range(5), *range(200, 207), *range(300, 304)]
    assert seen == [i for i in everything if i % 2 == 0] and scanned == len(everything) and at == positions.Position()
    page = positions.scan_page(rows, files, positions.Position(1, 3), F.lit(True), size, most_files=1, most_rows=100, limit=50)
    assert [r.id for r in page.rows.orderBy("ordinal").collect()] == [203, 204, 205, 206] and page.next == positions.Position(2, 0)
    assert {r.file.split("/")[-2] for r in page.rows.collect()} == {"2"}
    plan = page.rows._jdf.queryExecution().executedPlan()
    page.rows.collect()
    assert "_metadata" in str(plan) or "file_path" in str(plan)
    with pytest.raises(ValueError, match="larger"):
        positions.scan_page(rows, files, positions.Position(0, 2), F.lit(True), size, most_bytes=1)
    with pytest.raises(ValueError, match="outside"):
        positions.scan_page(rows, files, positions.Position(0, 6), F.lit(True), size)
    assert positions.files_digest(positions.pinned(rows.where("id <> 1"))) != digest


def test_a_page_is_read_again_after_a_kill(spark, tmp_path):
    spark.range(1100).selectExpr("id", "cast(id % 7 as string) AS v").repartition(3).write.parquet(f"{tmp_path}/feed")
    spark.dataSource.register(pages_source.PlacePages)
    seen, alive = [], [False]

    def sink(rows, batch):
        got = rows.orderBy("file", "row").collect()
        if got:
            seen.append((batch, {r.page_id for r in got}, [(r.file, r.row, r.id, r.v) for r in got]))
            if len(seen) == 2 and not alive[0]:
                alive[0] = True
                raise RuntimeError("killed between page and acknowledgement")

    def run():
        stream = spark.readStream.format("place_pages").option("path", f"{tmp_path}/feed").option("columns", "id long, v string").option("rows", 400).load()
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/ck").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    assert [s[0] for s in seen] == [0, 1, 1, 2] and seen[1] == seen[2] and all(len(s[1]) == 1 for s in seen)
    assert sorted(i for k, s in enumerate(seen) if k != 1 for _, _, i, _ in s[2]) == list(range(1100))


def test_cycles_over_two_days(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    steps = [
        [("a", "id", 1, None, "01 00:00"), ("a", "id", 2, None, "01 00:00"), ("a", "id", 3, None, "01 00:00"), ("a", "record", 1, "v1", "01 00:01"), ("a", "record", 2, "v1", "01 00:01"), ("a", "record", 1, "v1", "01 00:02"), ("a", "record", 9, "v1", "01 00:02"), ("a", "ack", None, None, "01 00:03")],
        [("a", "record", 3, "v1", "01 00:04"), ("a", "record", 2, "v1", "01 00:04"), ("a", "ack", None, None, "01 00:05"), ("a", "id", 1, None, "01 05:00")],
        [("b", "id", 1, None, "02 06:00")],
        [("a", "id", 1, None, "02 08:00"), ("a", "id", 2, None, "02 08:00"), ("a", "record", 1, "v2", "02 08:01"), ("a", "record", 2, "v1", "02 08:01"), ("a", "ack", None, None, "02 08:02")],
    ]
    query = None
    try:
        for k, rows in enumerate(steps):
            spark.createDataFrame(rows, "source string, kind string, object_id long, version string, t string").selectExpr("source", "kind", "object_id", "version", "cast('2024-01-' || t || ':00' AS timestamp) AS ts").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
            if query is None:
                stream = cycles.cycles(spark.readStream.schema(cycles.EVENTS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in"))
                query = stream.writeStream.format("memory").queryName("cycle_rows").option("checkpointLocation", f"{tmp_path}/ck").start()
            query.processAllAvailable()
    finally:
        if query:
            query.stop()
        spark.conf.set(provider, before)
    got = [(r.cycle, r.object_id, r.outcome, r.cursor) for r in spark.table("cycle_rows").collect() if r.source == "a"]
    assert got == [
        (1, 1, "pending", 0), (1, 2, "pending", 0), (1, 1, "replayed", 0), (1, 9, "late", 0), (1, 1, "published", 1), (1, 2, "published", 2),
        (1, 2, "late", 2), (1, 3, "pending", 2), (1, 3, "published", 3), (1, None, "complete", 3), (1, 1, "deferred", 3), (1, None, "due", 3),
        (2, 1, "pending", 0), (2, 2, "pending", 0), (2, 1, "published", 1), (2, 2, "unchanged", 2), (2, None, "complete", 2),
    ]


def test_violations_name_their_paths(spark):
    texts = "array<string>"
    kind = f"fsq_place_id string, name string, latitude double, longitude double, address string, locality string, region string, postcode string, country string, tel string, website string, fsq_category_ids {texts}, fsq_category_labels {texts}, date_closed string, unresolved_flags {texts}"
    good = ("p", "Café", 1.0, 2.0, None, None, None, None, None, None, None, [], ["a"], "2024-02-29", [])
    rows = [good, (" p", None, 91.0, float("nan"), "", *[None] * 4, "x" * 129, "é" * 1025, ["a", None, " "], ["é" * 257], "2023-02-29", ["ok", "Doesn't  Exist"]), (*good[:11], ["a"] * 129, None, "2024-01-02T03:04:05.678Z", None)]
    got = [[(v.path, v.problem) for v in r.v] for r in spark.createDataFrame(rows, kind).coalesce(1).select(constraints.violations(constraints.RELEASE_V1).alias("v")).collect()]
    assert got[0] == []
    assert got[1] == [
        ("fsq_place_id", "untrimmed"), ("name", "missing"), ("latitude", "out_of_range"), ("longitude", "not_finite"), ("address", "blank"), ("tel", "too_long"), ("website", "too_long"),
        ("fsq_category_ids[1]", "missing"), ("fsq_category_ids[2]", "blank"), ("fsq_category_labels[0]", "too_long"), ("date_closed", "malformed"), ("unresolved_flags[1]", "forbidden"),
    ]
    assert got[2] == [("fsq_category_ids", "too_many"), ("fsq_category_labels", "missing"), ("unresolved_flags", "missing")]


def test_projection_counts_in_the_same_pass_and_overflow_fails(spark):
    rows = spark.createDataFrame([("a", " A ", 1.0, 1.0, ["Private Venue"], 1), ("b", " B ", 1.0, 1.0, None, 2), ("c", " ", 1.0, 1.0, [], 3)], "fsq_place_id string, name string, latitude double, longitude double, unresolved_flags array<string>, extra int")
    kept, seen = governance.projection(rows)
    got = kept.collect()
    assert [(r.fsq_place_id, r.name, r.fsq_category_ids) for r in got] == [("b", "B", [])] and kept.columns == [r.path for r in constraints.RELEASE_V1]
    assert seen.get == {"input": 3, "projected": 1, "excluded": 1, "rejected": 1}
    kept, seen = governance.prepared(rows, [("named", F.trim("name") != ""), ("late", F.col("extra") > 1)], most=1)
    assert kept.count() == 1 and seen.get == {"input": 3, "named": 2, "late": 1}
    with pytest.raises(Exception, match="more than 1 rows"):
        governance.prepared(rows, [("named", F.trim("name") != "")], most=1)[0].collect()


def test_invalid_commands_are_found_by_halving(spark):
    def publish(rows):
        if (rows["v"] == 13).any():
            raise governance.InvalidInput("22023")

    got = governance.published(spark.range(300).selectExpr("id", "cast(id % 101 as int) AS v"), "id", publish, 128).orderBy("id").collect()
    assert [r.id for r in got if r.status == "rejected"] == [13, 114, 215] and all((r.reason is None) == (r.status == "applied") for r in got)
    assert {(r.batch, r.calls) for r in got} == {(0, 1 + 2 * (7 + 6)), (1, 15), (2, 1)}

    def down(rows):
        raise OSError("connection lost")

    with pytest.raises(Exception, match="connection lost"):
        governance.published(spark.range(3), "id", down).collect()


def records_of(ids):
    """A source that has lost the ids divisible by 7; used by the test below on the executors."""
    return [{"id": i, "v": f"v{i}", "secret": "x"} for i in ids if i % 7]


def test_ids_are_asked_page_by_page(spark):
    spark.dataSource.register(paged.IdPages)
    ask = lambda ids, fetch="tests.test_place:records_of": spark.read.format("id_pages").option("columns", "id long, v string").option("id", "id").option("ids", json.dumps(ids)).option("fetch", fetch).load()
    got = ask(list(range(600, 0, -1)))
    rows = got.collect()
    assert got.columns == ["id", "v", "page"] and sorted(r.id for r in rows) == [i for i in range(1, 601) if i % 7] and {r.page for r in rows} == {0, 1, 2} and got.rdd.getNumPartitions() == 3
    assert ask([]).count() == 0
    for ids in ([1, 1], [-1], [1.5], list(range(250_001))):
        with pytest.raises(Exception, match="invalid"):
            ask(ids).collect()
    found = paged.discovered(spark.createDataFrame([(i,) for i in [*range(300), 5, -2, None]], "k long"), "k")
    assert {(r.id, r.refused) for r in found.where("refused is not null").collect()} == {(5, "duplicate"), (-2, "negative"), (None, "missing")}
    report = paged.page_report(found.where("refused is null").select("id", "page"), spark.createDataFrame([(1,), (1,), (2,)], "id long")).orderBy("page").collect()
    assert [(r.requested, r.first_id, r.last_id, r.returned, r.missing, r.repeated) for r in report] == [(250, 0, 250, 2, 248, 1), (49, 251, 299, 0, 49, 0)]
    with pytest.raises(Exception, match="more than 2 ids"):
        paged.discovered(spark.range(3), "id", most=2).collect()


def test_file_snapshots_are_what_their_digests_say(spark, tmp_path):
    texts = {"a.json": '{"rows":[1,2]}', "b.json": "[1,2,3]"}
    for name, text_ in texts.items():
        (tmp_path / name).write_text(text_)
    digests = {n: hashlib.sha256(t.encode()).hexdigest() for n, t in texts.items()}
    got = artifacts.checked_snapshots(spark, str(tmp_path), digests).collect()
    assert {(r.name, r.records, r.value) for r in got} == {("a.json", 2, texts["a.json"]), ("b.json", 3, texts["b.json"])}
    for bad, why in (({"a.json": digests["a.json"]}, "not in the manifest"), (digests | {"b.json": "0"}, "not what its digest")):
        with pytest.raises(Exception, match=why):
            artifacts.checked_snapshots(spark, str(tmp_path), bad).collect()
    with pytest.raises(Exception, match="byte cap"):
        artifacts.checked_snapshots(spark, str(tmp_path), digests, most_bytes=10).collect()
    with pytest.raises(Exception, match="record cap"):
        artifacts.checked_snapshots(spark, str(tmp_path), digests, most_records=2).collect()
    assert {r.outcome for r in artifacts.file_snapshots(spark, str(tmp_path), most_bytes=10).collect()} == {"ok", "too_large"}


def test_table_files_have_their_digests(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    (tmp_path / "one.parquet").write_bytes(b"bytes")
    got = {r.file: (r.bytes, r.digest, r.outcome) for r in queries.QUERIES["S13_table_files"](spark, str(tmp_path)).collect()}
    assert got["one.parquet"] == (5, hashlib.sha256(b"bytes").hexdigest(), "ok") and len(got) == 2


def test_positions_of_equal_and_unlike_tables(spark):
    a = spark.createDataFrame([(k, None if k == 2 else "v") for k in range(5)], "k int, v string")
    assert matching.positional_differences(a, a.repartition(3), ["k"], ["k", "v"]).count() == 0
    b = a.where("k <> 3").withColumn("v", F.when(F.col("k") == 2, "x").otherwise(F.col("v")))
    got = [(r.number, r.side, r.differs) for r in matching.positional_differences(a, b, ["k"], ["k", "v"]).orderBy("number").collect()]
    assert got == [(3, "both", ["v"]), (4, "both", ["k"]), (5, "expected_only", [])]


def test_tiles_split_down_to_a_floor(spark):
    one = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 8.0, 0)], "tile int, south double, west double, north double, east double, seed long")
    got = {r.path: r for r in tiles.run_tiles(one, F.col("path").isin("", "3", "32"), floor=2).collect()}
    assert set(got) == {"", "0", "1", "2", "3", "30", "31", "32", "33"}
    assert {p for p, r in got.items() if r.is_split} == {"", "3"} and {p: got[p].status for p in ("", "3", "32", "33", "0")} == {"": "partial", "3": "partial", "32": "failed", "33": "success", "0": "success"}
    assert (got["32"].south, got["32"].west, got["32"].north, got["32"].east) == (3.0, 4.0, 4.0, 6.0) and (got["3"].south, got["3"].east) == (2.0, 8.0)
    whole = tiles.run_tiles(one, F.lit(False)).collect()
    assert [(r.path, r.status, r.is_split) for r in whole] == [("", "success", False)]


def test_field_actions_and_merged_data(spark):
    fields = F.from_json(A, "map<string,string>")
    row = spark.createDataFrame([('{"url":"Shop.example/a","website":" ","tel":"12","rating":"5","odd":"x","name":" N "}',)], "a string")
    got = {(r.field, r.value, r.action) for r in governance.field_dispositions(row, "a", fields).collect()}
    assert got == {("website_url", "https://shop.example/a", "fill"), ("phone", "12", "invalid"), ("rating", "5", "blocked"), ("name", "N", "review")}
    assert values(spark, jobs.merged_json(A, B), ('{"a":"1"}', '{"b":"2"}'), ("broken", '{"b":"2"}'), (None, '{"a":null}'), ('{"a":"1"}', '{"a":"3"}')) == ['{"a":"1","b":"2"}', '{"b":"2"}', '{"a":null}', '{"a":"3"}']
    answer = governance.model_result(A, rules.evidence_text(B), [B], "taco")
    assert values(spark, answer[0], ('{"style": "Al Pastor,  Birria , Odd"}', "al pastor birria")) == ["Al Pastor, Birria"]


def test_publication_gate():
    log, quality = [], iter([("FAIL", {"style_without_confidence": 2}), ("OK", {})])
    step = lambda name, ok=True: lambda *a: log.append((name, *a)) or ok
    out = governance.publication_gate(step("health"), lambda: next(quality), step("repair"), step("readiness"), step("capability"), step("write"), step("check"))
    assert out == {"published": True, "repairs": 1, "stopped_at": None}
    assert log == [("health",), ("repair",), ("readiness",), ("capability",), ("write", True), ("write", False), ("check",)]
    stopped = governance.publication_gate(step("h"), lambda: ("FAIL", {"invalid_value": 1, "style_without_confidence": 1}), step("r"), step("x"), step("c"), step("w"), step("k"))
    assert stopped == {"published": False, "repairs": 0, "stopped_at": "quality"}


def test_due_and_requeue(spark):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    assert values(spark, jobs.due(A.cast("timestamp"), F.lit(24), now), None, "2024-05-31 00:00:00", "2024-05-31 00:00:01") == [True, True, False]
    assert values(spark, jobs.cadence(A, B == "y", F.lit(0), F.lit(168)), ("fsq_os_places", "y"), ("fsq_os_places", "n"), ("osm", "y")) == [1, 168, 168]
    rows = spark.createDataFrame([(k, "scrape", "failed" if k < 4 else "pending", e, "w", 3, 3) for k, e in enumerate(["HTTP 503", "HTTP 404 timeout", "Request TIMEOUT", None, None])], "id int, job_type string, status string, last_error string, worker_id string, attempts int, max_attempts int")
    assert [(r.id, r.status, r.last_error) for r in jobs.requeued(rows, "t", 5, 1).collect()] == [(0, "pending", "requeued t (was: HTTP 503)"), (2, "pending", "requeued t (was: Request TIMEOUT)")]
    assert jobs.requeued(rows, "t", 5, 0).count() == 0 and [r.id for r in jobs.unclaimable(rows).collect()] == [4]


def test_auto_links_need_all_three_identifiers(spark):
    queue = [(k, "pizza", "ambiguous", "all_the_places", f"s{k}", "P", "1 Main", "313-555-0199" if k else "", "https://p.example/1", 1, "P", 10.0, 0.5, "x", "pending") for k in (0, 1, 2)]
    q = spark.createDataFrame(queue, "id int, entity_type string, review_kind string, source string, source_id string, source_name string, address string, phone string, website string, nearest_place_id int, nearest_place_name string, nearest_distance_m double, nearest_name_score double, report_file string, status string")
    p = spark.createDataFrame([(1, "1 Main", "3135550199", "http://www.p.example/1/", None, None, "P", None, None, None, None, None)], "id int, address string, phone string, website_url string, google_place_id string, lifecycle_status string, name string, brand_wikidata string, osm_tags string, status string, rating int, notes string")
    e = spark.createDataFrame([("pizza", "all_the_places", "s2", 9)], "entity_type string, source string, source_id string, place_id int")
    rows = review.auto_link(q, p, e, exact_identifiers=True)
    assert [(r.id, r.auto_link_reason) for r in rows.collect()] == [(1, "exact_identifiers")]
    state_, history, proof = review.linked(rows, "auto", "2024-06-01")
    assert state_.first().canonical_place_id == 1 and history.first().previous_status == "pending" and proof.first().place_id == 1
    assert review.auto_link(q, p, e).count() == 0


def test_reports_that_do_not_reconcile(spark):
    sound = {"candidate_rows": 5, "decision_rows": 5, "route_ready_for_match": 2, "route_closed_evidence_candidate": 1, "route_filtered_non_pizza": 1, "route_excluded_unusable": 1, "route_excluded_out_of_scope": 0, "active_candidates_compared": 2, "closed_candidates_compared": 1,
             "matched_existing_places": 1, "ambiguous_review_candidates": 0, "likely_new_unmatched_candidates": 1, "closed_signals_matched": 1, "closed_evidence_dropped": 0, "active_matches_with_source_id": 1, "canonical_rows_prefetched": 3, "canonical_snapshot_rows": 9, "grid_cells_built": 2, "canonical_prefetch_tiles": 1}
    broken = lambda **x: {r.violation for r in matching.report_violations(spark.createDataFrame([sound | x])).collect()}
    assert broken() == set()
    assert broken(decision_rows=4) == {"decisions"} and broken(grid_cells_built=4) == {"cells"} and broken(canonical_prefetch_tiles=0) == {"no_tiles"} and broken(likely_new_unmatched_candidates=2) == {"active_dispositions"}


def test_folding_equals_the_unicode_tables(spark):
    import re
    import unicodedata

    def plain(x):
        low = "".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not 0x300 <= ord(c) <= 0x36F)
        return re.sub("[^a-z0-9]+", " ", low.replace("&", " and ")).strip()

    texts = ["Crème Brûlée & Größe", "ﬁne ½ ㎏ Ⅳ ＡＢＣ１２", "Łódź ñandú Đà Nẵng", "éä ́x", "пицца 東京 5", "𝐁𝐨𝐥𝐝 ① ™ ª²", "", "plain"]
    texts += [f"a{chr(p)}b" for p in range(0x80, 0x3000, 7)] + [f"a{chr(p)}b" for p in range(0xF900, 0x1F200, 13) if not 0xD800 <= p <= 0xDFFF]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, a string").orderBy("i").select(text.normalized(A)).collect()
    wrong = [(t, r[0], plain(t)) for t, r in zip(texts, got, strict=True) if r[0] != plain(t)]
    assert not wrong, wrong[:5]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_page_facts_by_plain_expressions(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(400).collect()
    got = {r.page_id: r for r in pages.page_facts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for r in rows:
        source = r.html or ""
        blocks = re.findall(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script\s*>', source)
        body = re.sub(r"(?is)<!--.*?-->|<!doctype[^>]*>|<(script|style)\b[^>]*>.*?</\1\s*>", "", source)
        body = html.unescape(re.sub(r"(?s)</?[a-zA-Z][^>]*>", "", body))
        phone = re.search(r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", body)
        tel = re.search(r'href="tel:([^"]*)"', source)
        want_phone = re.sub(r"[^\d+]", "", phone[0]) if phone else re.sub(r"[^\d+]", "", tel[1]) if tel else None
        times = re.findall(r"(?i)\d{1,2}(?::\d{2})?\s*(?:am|pm)", body)
        prices = [float(p) for p in re.findall(r"\$(\d+(?:\.\d{2})?)", body) if 0 < float(p) < 100]
        mean = sum(prices) / len(prices) if prices else None
        band = None if mean is None else "$" if mean < 10 else "$$" if mean < 20 else "$$$" if mean < 35 else "$$$$"
        x, low = got[r.page_id], body.lower()
        assert x.phone == want_phone and x.price_hint == band, r.page_id
        assert x.has_hours == (bool(re.search("hours|schedule|open|close", low)) and len(times) >= 2), r.page_id
        assert x.excerpt == re.sub(r"[ \t\n\x0b\f\r]+", " ", body).strip(" ")[:6000], r.page_id
        assert x.style_hints == [t for t in pages.STYLE_HINTS if t in low] and x.protein_hints == [t for t in pages.PROTEIN_HINTS if t in low]
        assert x.n_jsonld == min(3, len(blocks))

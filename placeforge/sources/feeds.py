"""Feed readers and the normalisers of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.functions import identity, text
from placeforge.operators import matching

# fixed values: per source its label, license, attribution and the aliases of its fields
SOURCES = {
    "osm": {"label": "OpenStreetMap / Overpass", "license": "ODbL-1.0", "id": ("id", "osm_id"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("amenity", "cuisine", "shop", "category"), "website": ("website", "contact:website"), "phone": ("phone", "contact:phone"), "closed": ("operating_status",)},
    "fsq_os_places": {"label": "Foursquare OS Places", "license": "Apache-2.0", "id": ("fsq_place_id", "fsq_id", "id"), "lat": ("latitude", "lat"), "lng": ("longitude", "lng", "lon"), "category": ("fsq_category_labels", "category_labels", "categories", "category_name", "category", "fsq_category_ids"), "website": ("website",), "phone": ("tel", "phone"), "closed": ("date_closed",), "flags": ("unresolved_flags",)},
    "all_the_places": {"label": "All the Places", "license": "CC0-1.0", "id": ("id", "ref"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("amenity", "cuisine", "shop", "category", "categories"), "website": ("website", "contact:website"), "phone": ("phone", "contact:phone"), "closed": ("end_date",)},
    "overture_places": {"label": "Overture Places", "license": "see-release-and-record-sources", "id": ("id", "gers_id"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("primary_category", "basic_category", "taxonomy", "categories", "category"), "website": ("websites", "website"), "phone": ("phones", "phone"), "closed": ("operating_status",)},
    "wikidata": {"label": "Wikidata", "license": "CC0-1.0", "id": ("item", "qid", "id"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("instance_of", "cuisine", "category", "categories"), "website": ("official_website", "website"), "phone": ("phone",)},
    "government_open_data": {"label": "Government/open data", "license": "dataset-specific", "id": ("id", "license_id", "permit_id", "facility_id", "record_id"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("facility_type", "business_type", "description", "category"), "website": ("website",), "phone": ("phone",), "closed": ("status",)},
    "denue": {"label": "DENUE / INEGI", "license": "verify-before-import", "id": ("clee", "id", "record_id"), "lat": ("latitud", "lat", "latitude"), "lng": ("longitud", "lng", "lon", "longitude"), "category": ("nombre_act", "activity", "category"), "website": ("sitio_internet", "website"), "phone": ("telefono", "phone")},
    "official_website": {"label": "Official restaurant website", "license": "first-party-factual-evidence", "id": ("url", "website", "source_url", "id"), "lat": ("lat", "latitude"), "lng": ("lng", "lon", "longitude"), "category": ("category", "cuisine", "menu_tags"), "website": ("url", "website", "source_url"), "phone": ("phone",)},
}
# fixed values: aliases that all sources share, words and flags of closed places
SHARED = {
    "name": ("name", "label", "title", "business_name", "facility_name", "dba", "trade_name"), "address": ("address", "addr:full", "addr:street_address", "street_address", "address1", "location_address"),
    "locality": ("locality", "city", "addr:city", "municipality"), "region": ("region", "state", "addr:state", "province"), "postcode": ("postcode", "postal_code", "zip", "addr:postcode"), "country": ("country", "addr:country"),
}
CLOSED_WORDS = ("closed", "permanently closed", "permanently_closed", "inactive", "out of business", "disused", "abandoned", "demolished")
CLOSED_FLAGS = ("closed", "delete", "doesnt exist")


# fixed values: per source the license and attribution of evidence
ATTRIBUTION = {
    "all_the_places": ("CC0-1.0", "All the Places contributors"), "fsq_os_places": ("Apache-2.0", "Copyright Foursquare Labs, Inc."), "osm": ("ODbL-1.0", "OpenStreetMap contributors"),
    "overture_places": ("see-release-attribution", "Overture Maps Foundation and source contributors"), "wikidata": ("CC0-1.0", "Wikidata contributors"), "government_open_data": ("dataset-specific", "dataset-specific"),
    "denue": ("verify-before-import", "INEGI DENUE"), "official_website": ("first-party-factual-evidence", "official restaurant website"),
}


def source_metadata(source: Column) -> tuple[Column, Column]:
    """License and attribution of a source; unknown ones are source-specific and name themselves."""
    table = lambda k: F.create_map(*(F.lit(x) for s, v in ATTRIBUTION.items() for x in (s, v[k])))
    return F.coalesce(table(0)[source], F.lit("source-specific")), F.coalesce(table(1)[source], source)


def _fields(json: Column) -> Column:
    """A JSON object as a map of its values' texts."""
    return F.from_json(json, "map<string,string>")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Any feed file as rows of one map column `fields`.

    By ending: .jsonl and .ndjson, .csv (quotes doubled, fields may span lines,
    short rows padded with '', blank rows dropped), else one JSON document: an
    array, an object with rows, places or features, or GeoJSON. Line files are
    split over tasks; a JSON document is one value and is read as such.
    """
    low = path.lower()
    if low.endswith((".jsonl", ".ndjson")):
        return spark.read.text(path).where(F.trim("value") != "").select(_fields(F.col("value")).alias("fields"))
    if low.endswith(".csv"):
        rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False).csv(path)
        filled = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rows.columns]
        rows = rows.where(F.trim(F.concat(*filled)) != "")
        return rows.select(F.create_map(*(x for c, v in zip(rows.columns, filled, strict=True) for x in (F.lit(c), v))).alias("fields"))
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.from_json("v", "array<string>")
    wrapped = F.coalesce(*(F.from_json(F.get_json_object("v", f"$.{k}"), "array<string>") for k in ("rows", "places", "features")))
    single = F.when(F.get_json_object("v", "$.type") == "Feature", F.array("v"))
    items = F.when(F.col("v").startswith("["), listed).otherwise(F.coalesce(single, wrapped, F.raise_error(F.lit("JSON input must be an array, GeoJSON, or an object with rows, places or features")).cast("array<string>")))
    rows = whole.select(F.explode(items).alias("v"))
    return rows.select(F.when(F.get_json_object("v", "$.type") == "Feature", feature_fields(F.col("v"))).otherwise(_fields(F.col("v"))).alias("fields"))


def feature_fields(v: Column) -> Column:
    """S3: properties and id of a GeoJSON feature; property coordinates before those of a point."""
    props = F.coalesce(_fields(F.get_json_object(v, "$.properties")), F.create_map().cast("map<string,string>"))
    point = F.get_json_object(v, "$.geometry.type") == "Point"
    lng = F.coalesce(props["longitude"], props["lon"], props["lng"], F.when(point, F.get_json_object(v, "$.geometry.coordinates[0]")))
    lat = F.coalesce(props["latitude"], props["lat"], F.when(point, F.get_json_object(v, "$.geometry.coordinates[1]")))
    own = F.map_filter(props, lambda k, _: ~k.isin("longitude", "latitude", "id"))
    return F.map_concat(F.create_map(F.lit("id"), F.coalesce(F.get_json_object(v, "$.id"), props["id"]), F.lit("longitude"), lng, F.lit("latitude"), lat), own)


def normalize_feed(rows: DataFrame, source: str, as_of: str) -> DataFrame:
    """Rows of `fields` as candidates of the matcher."""
    config = SOURCES[source]
    m = F.col("m")
    pick = lambda names: text.first_alias(m, names)
    rows = rows.select(text.lower_keys(F.col("fields")).alias("m"))
    listed = F.flatten(F.array(*(text.flat_strings(F.when(F.map_contains_key(m, a.lower()), m[a.lower()])) for a in config["category"])))
    closed_text = text.normalized(pick(config.get("closed", ())))
    flags = F.transform(text.flat_strings(pick(config.get("flags", ()))), lambda f: F.trim(F.regexp_replace(F.lower(f), "[^a-z0-9]+", " ")))
    dated = text.closed_date(pick(config["closed"]), F.lit(as_of).cast("timestamp")) if source in ("all_the_places", "fsq_os_places") else F.lit(False)
    website = text.first_string(pick(config["website"]))
    return rows.select(
        F.lit(source).alias("source"), F.lit(config["label"]).alias("source_label"), F.lit(config["license"]).alias("license"),
        F.regexp_replace(pick(config["id"]), r"^https?://www\.wikidata\.org/entity/", "").alias("source_id"), *(pick(names).alias(field) for field, names in SHARED.items()),
        text.finite_number(pick(config["lat"])).alias("lat"), text.finite_number(pick(config["lng"])).alias("lng"), website.alias("website"), text.first_string(pick(config["phone"])).alias("phone"),
        F.coalesce(pick(("source_url", "@source_uri")), website).alias("source_url"), listed.alias("categories"),
        (dated | text.any_contains(closed_text, CLOSED_WORDS) | F.exists(flags, lambda f: f.isin(*CLOSED_FLAGS))).alias("is_closed"),
    )


# fixed values: the fields of a candidate's payload, in order
PAYLOAD = ("source", "source_label", "source_id", "name", "lat", "lng", "address", "locality", "region", "postcode", "country", "website", "phone", "source_url", "confidence", "is_closed", "categories", "spider", "route")


def candidate_payloads(rows: DataFrame, as_of: str) -> DataFrame:
    """Rows of `fields` (FSQ feeds) as the payload of 19 fields: the website is the source url, blank texts are null, no confidence or spider yet."""
    flat = normalize_feed(rows, "fsq_os_places", as_of)
    blank = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    texts = ("name", "address", "locality", "region", "postcode", "country")
    flat = flat.withColumns({"confidence": F.lit(0.0), "spider": F.lit(None).cast("string"), "source_url": F.col("website")}).select(*(blank(c) if c in texts else c for c in PAYLOAD[:-1]))
    return matching.route(flat).select(*PAYLOAD)


def osm_rows(elements: DataFrame) -> DataFrame:
    """Elements (type, id, lat, lon, center, tags) as feed rows; those without name or coordinates go."""
    t = F.col("tags")
    lat, lng = F.coalesce("lat", F.col("center.lat")), F.coalesce("lon", F.col("center.lon"))
    tag = lambda *names: F.coalesce(*(F.when(t[n] != "", t[n]) for n in names))
    status = F.when(tag("demolished:amenity").isNotNull(), "demolished").when(tag("abandoned:amenity").isNotNull(), "abandoned").when(tag("disused:amenity").isNotNull(), "disused")
    street = F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street"))
    rows = elements.select(
        F.concat(F.lit("osm:"), "type", F.lit("/"), "id").alias("id"), tag("name", "name:en").alias("name"), lat.alias("lat"), lng.alias("lng"),
        F.coalesce(tag("addr:full"), F.when(street != "", street)).alias("address"), tag("addr:city", "addr:town", "addr:village").alias("locality"), tag("addr:state").alias("region"),
        F.coalesce(tag("addr:country"), F.lit("US")).alias("country"), tag("website", "contact:website").alias("website"), tag("phone", "contact:phone").alias("phone"),
        F.concat_ws("; ", *(tag(n) for n in ("amenity", "disused:amenity", "abandoned:amenity", "demolished:amenity", "cuisine", "shop"))).alias("category"), status.alias("operating_status"),
    )
    return rows.where("name is not null and lat is not null and lng is not null")


def wikidata_seeds(places: DataFrame, entities: DataFrame) -> DataFrame:
    """The first place of each brand or operator id (columns, then tags) with the fetched entity; entities: qid, label."""
    tag = lambda k: F.get_json_object("osm_tags", f"$['{k}']")
    ids = F.array(F.col("brand_wikidata"), tag("brand:wikidata"), tag("operator:wikidata"))
    rows = places.select("id", "name", F.explode(ids).alias("qid")).where(F.col("qid").rlike("^Q[0-9]+$"))
    first = rows.groupBy("qid").agg(F.min(F.struct("id", "name")).alias("m")).select("qid", "m.*")
    return first.join(entities, "qid")


def envelopes(rows: DataFrame, profile: str, namespace: str) -> DataFrame:
    """Normalised rows (and raw, their canonical JSON) with external id, record key and observation id, in the order of the keys.

    Without a source id the digest of what identifies the place stands for it.
    """
    word = lambda c: identity.json_text(text.normalized(F.col(c)))
    number = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"\.0$", ""), F.lit("null"))
    place = identity.object_digest(name=word("name"), lat=number("lat"), lng=number("lng"), **{c: word(c) for c in ("address", "locality", "region", "postcode", "country")})
    external = F.coalesce("source_id", F.concat(F.lit("fallback-v1:sha256:"), place))
    out = rows.withColumn("external_id", external).withColumn("source_record_key", identity.source_record_key(profile, namespace, F.col("external_id")))
    return out.withColumn("observation_id", identity.observation_id(F.col("source_record_key"), F.col("raw"))).orderBy("source_record_key", "observation_id")

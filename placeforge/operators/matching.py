"""Routing and matching of source candidates to canonical places."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.functions import geo, text
from placeforge.operators.order import running

# fixed values: words of a pizza place, and the regions in scope (south, west, north, east; region codes)
PIZZA_TERMS = ("apizza", "flatbread", "italian restaurant", "pizza", "pizzeria", "slice", "wood fired", "wood-fired")
SCOPE = ((41.6, -90.5, 48.4, -82.1, ()), (40.4, -79.8, 45.1, -71.7, ("NY",)), (32.4, -124.5, 42.1, -114.1, ()), (25.8, -106.7, 36.6, -93.5, ()))
ACCEPTED = ("exact_identifier_nearby", "exact_name_nearby", "strong_spatial_name")
REVIEW = ("weak_spatial_name", "spatial_only_review")


@dataclass(frozen=True)
class Matching:
    max_distance_m: float = 100.0
    cell_degrees: float = 0.02
    tile_degrees: float = 1.0
    keep: int = 10
    prefetch_batch: int = 100


def in_scope(lat: Column, lng: Column, region: Column, scope=SCOPE) -> Column:
    """inside any box whose region codes (if any) hold the region; a blank region passes."""
    code = F.upper(F.trim(F.coalesce(region, F.lit(""))))
    out = F.lit(False)
    for south, west, north, east, codes in scope:
        ok = lat.between(south, north) & lng.between(west, east)
        out = out | (ok & ((code == "") | code.isin(*codes)) if codes else ok)
    return out


def has_term(name: Column, categories: Column, website: Column, source_url: Column, terms=PIZZA_TERMS) -> Column:
    """a term in the normalized name, categories and urls."""
    blank = F.lit("")
    joined = F.concat_ws(" ", F.coalesce(name, blank), F.array_join(categories, " "), F.coalesce(website, blank), F.coalesce(source_url, blank))
    return text.any_contains(text.normalized(joined), terms)


def route(candidates: DataFrame, scope=SCOPE) -> DataFrame:
    """adds `route`, the first of the five that fits."""
    c = F.col
    usable = F.coalesce(c("name") != "", F.lit(False)) & c("lat").isNotNull() & c("lng").isNotNull()
    pizza = has_term(c("name"), c("categories"), c("website"), c("source_url"))
    chosen = (
        F.when(~usable, "excluded_unusable")
        .when(~in_scope(c("lat"), c("lng"), c("region"), scope), "excluded_out_of_scope")
        .when(~pizza, "filtered_non_pizza")
        .when(c("is_closed"), "closed_evidence_candidate")
        .otherwise("ready_for_match")
    )
    return candidates.withColumn("route", chosen)


def match_method(distance: Column, score: Column, exact: Column) -> Column:
    """M4: ordered, inclusive thresholds."""
    near = distance <= 100
    return (
        F.when(exact & near & (score == 0), "spatial_only_review")
        .when(exact & near, "exact_identifier_nearby")
        .when((distance <= 25) & (score >= 0.99), "exact_name_nearby")
        .when((distance <= 75) & (score >= 0.99), "strong_spatial_name")
        .when((distance <= 50) & (score >= 0.6), "strong_spatial_name")
        .when(near & (score >= 0.35), "weak_spatial_name")
        .when(distance <= 25, "spatial_only_review")
        .otherwise("no_match")
    )


def prefetch_boxes(candidates: DataFrame, config: Matching = Matching()) -> DataFrame:
    """Per tile the padded box of its candidates; one row for each tile that holds any."""
    tiles = candidates.groupBy(geo.cell(F.col("lat"), config.tile_degrees).alias("ty"), geo.cell(F.col("lng"), config.tile_degrees).alias("tx")).agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lng").alias("w"), F.max("lng").alias("e"))
    pad = config.max_distance_m / geo.METERS_PER_DEGREE
    wide = F.lit(config.max_distance_m) / (F.lit(geo.METERS_PER_DEGREE) * F.greatest(F.cos(geo.radians((F.col("s") + F.col("n")) / 2.0)), F.lit(0.01)))
    return tiles.select("ty", "tx", (F.col("s") - pad).alias("s"), (F.col("n") + pad).alias("n"), (F.col("w") - wide).alias("w"), (F.col("e") + wide).alias("e"))


def prefetch(places: DataFrame, candidates: DataFrame, config: Matching = Matching()) -> DataFrame:
    """Places inside the box of their own or a neighbouring tile.

    Each tile is given the boxes of itself and its neighbours, nine at most, so
    a place meets one row and is neither spread nor joined again. The tiles go
    to every task: the earth has 64,800 of one degree.
    """
    steps = F.array(*(F.lit(k).cast("long") for k in (-1, 0, 1)))
    spread = prefetch_boxes(candidates, config).withColumn("_dy", F.explode(steps)).withColumn("_dx", F.explode(steps))
    around = spread.groupBy((F.col("ty") + F.col("_dy")).alias("_ty"), (F.col("tx") + F.col("_dx")).alias("_tx")).agg(F.collect_list(F.struct("s", "n", "w", "e")).alias("_boxes"))
    placed = places.withColumn("_ty", geo.cell(F.col("lat"), config.tile_degrees)).withColumn("_tx", geo.cell(F.col("lng"), config.tile_degrees))
    inside = F.exists("_boxes", lambda b: F.col("lat").between(b["s"], b["n"]) & F.col("lng").between(b["w"], b["e"]))
    return placed.join(F.broadcast(around), ["_ty", "_tx"]).where(inside).drop("_ty", "_tx", "_boxes")


def grid_pairs(left: DataFrame, right: DataFrame, reach_m: float, cell_degrees: float) -> DataFrame:
    """Pairs of a left row (lat, lng) and a right row (p_lat, p_lng) within `reach_m`, with distance_m.

    The left side takes the cells that its circle touches, so the join is an
    equi join on the cell that adaptive execution can split where one is crowded.
    It is sorted: by the size of a well-compressed file, Spark would broadcast
    all places through the driver.
    """
    spread = geo.touched(left, "lat", "lng", cell_degrees, reach_m)
    placed = right.withColumn("cy", geo.cell(F.col("p_lat"), cell_degrees)).withColumn("cx", geo.cell(F.col("p_lng"), cell_degrees))
    pairs = spread.join(placed.hint("merge"), ["cy", "cx"]).drop("cy", "cx")
    pairs = pairs.withColumn("distance_m", geo.haversine(F.col("lat"), F.col("lng"), F.col("p_lat"), F.col("p_lng")))
    return pairs.where(F.col("distance_m") <= reach_m)


def evaluated(candidates: DataFrame, places: DataFrame, config: Matching = Matching()) -> DataFrame:
    """The nearest `keep` places of each candidate, scored; `near` ranks by distance, `best` by worth."""
    right = places.select("canonical_place_id", F.col("name").alias("p_name"), F.col("website_url").alias("p_website"), F.col("phone").alias("p_phone"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    # of places at one point only the first `keep` can rank: a default point of a geocoder stays small, before and after the shuffle
    alike = Window.partitionBy("p_lat", "p_lng").orderBy("canonical_place_id")
    right = right.where("p_lat is not null and p_lng is not null").withColumn("alike", F.row_number().over(alike)).where(F.col("alike") <= config.keep).drop("alike")
    right = right.withColumn("p_norm", text.normalized(F.col("p_name")))
    left = candidates.select("source_id", "lat", "lng", "website", "phone", text.normalized(F.col("name")).alias("norm"))
    pairs = grid_pairs(left, right, config.max_distance_m, config.cell_degrees)
    near = Window.partitionBy("source_id").orderBy("distance_m", "canonical_place_id")
    pairs = pairs.withColumn("near", F.row_number().over(near)).where(F.col("near") <= config.keep)
    website, phone = text.identifier_match(F.col("website"), F.col("phone"), F.col("p_website"), F.col("p_phone"))
    pairs = pairs.withColumn("name_score", text.name_score(F.col("norm"), F.col("p_norm"))).withColumn("id_website", website).withColumn("id_phone", phone)
    pairs = pairs.withColumn("match_method", match_method(F.col("distance_m"), F.col("name_score"), website | phone))
    best = Window.partitionBy("source_id").orderBy((F.col("match_method") == "no_match").cast("int"), F.desc("name_score"), "distance_m", "canonical_place_id")
    return pairs.withColumn("best", F.row_number().over(best))


def decide(routed: DataFrame, pairs: DataFrame) -> DataFrame:
    """M6: a decision for every routed candidate with its best and nearest place."""
    fields = ["canonical_place_id", "p_name", "distance_m", "name_score", "id_website", "id_phone", "match_method"]
    own = F.struct(*fields)
    nearest = F.struct("canonical_place_id", "distance_m", "name_score")
    chosen = pairs.where("best = 1 or near = 1").groupBy("source_id").agg(F.max(F.when(F.col("best") == 1, own)).alias("b"), F.max(F.when(F.col("near") == 1, nearest)).alias("n"))
    chosen = chosen.select("source_id", *(F.col(f"b.{f}").alias(f"best_{f}") for f in fields), F.col("n.canonical_place_id").alias("nearest_place_id"), F.col("n.distance_m").alias("nearest_distance_m"), F.col("n.name_score").alias("nearest_name_score"))
    out = routed.join(chosen, "source_id", "left")
    method, stable = F.coalesce("best_match_method", F.lit("no_match")), F.coalesce(F.col("source_id") != "", F.lit(False))
    disposition = (
        F.when(~F.col("route").isin("ready_for_match", "closed_evidence_candidate"), "not_compared")
        .when((F.col("route") == "closed_evidence_candidate") & stable & method.isin(*ACCEPTED), "closed_evidence")
        .when(F.col("route") == "closed_evidence_candidate", "closed_evidence_dropped")
        .when(method == "no_match", "likely_new")
        .when(method.isin(*REVIEW), "ambiguous_review")
        .otherwise("matched_existing")
    )
    return out.withColumn("disposition", disposition).withColumn("stable_source_id_present", stable)


def match(candidates: DataFrame, places: DataFrame, config: Matching = Matching()) -> DataFrame:
    """The whole matcher: route, nearest places, decisions; the grid join needs no prefetch."""
    routed = route(candidates)
    matchable = routed.where(F.col("route").isin("ready_for_match", "closed_evidence_candidate"))
    return decide(routed, evaluated(matchable, places, config))


ROUTES = ("ready_for_match", "closed_evidence_candidate", "filtered_non_pizza", "excluded_unusable", "excluded_out_of_scope")


def match_report(decisions: DataFrame) -> DataFrame:
    """M7: one row of counters that the decisions give."""
    count = lambda cond, name: F.count_if(cond).alias(name)
    d, r = F.col("disposition"), F.col("route")
    return decisions.agg(
        F.count("*").alias("decision_rows"), *(count(r == x, f"route_{x}") for x in ROUTES), count(d == "matched_existing", "matched_existing_places"),
        count(d == "ambiguous_review", "ambiguous_review_candidates"), count(d == "likely_new", "likely_new_unmatched_candidates"), count(d == "closed_evidence", "closed_signals_matched"),
        count(d == "closed_evidence_dropped", "closed_evidence_dropped"), count((d == "matched_existing") & (r == "ready_for_match") & F.col("stable_source_id_present"), "active_matches_with_source_id"),
    )


def full_report(candidates: DataFrame, places: DataFrame, decisions: DataFrame, config: Matching = Matching()) -> DataFrame:
    """M7: the decisions' counters with those of the run: candidates, compared ones, snapshot and prefetched rows, tiles, queries and cells."""
    routed = candidates.agg(F.count("*").alias("candidate_rows"), F.count_if(F.col("route") == ROUTES[0]).alias("active_candidates_compared"), F.count_if(F.col("route") == ROUTES[1]).alias("closed_candidates_compared"))
    matchable = candidates.where(F.col("route").isin(*ROUTES[:2]))
    boxes = prefetch_boxes(matchable, config).agg(F.count("*").alias("canonical_prefetch_tiles"))
    fetched = prefetch(places, matchable, config)
    cells = fetched.agg(F.count("*").alias("canonical_rows_prefetched"), F.countDistinct(geo.cell(F.col("lat"), config.cell_degrees), geo.cell(F.col("lng"), config.cell_degrees)).alias("grid_cells_built"))
    out = match_report(decisions)
    for part in (routed, places.agg(F.count("*").alias("canonical_snapshot_rows")), boxes, cells):
        out = out.crossJoin(F.broadcast(part))  # each is one row
    return out.withColumn("canonical_prefetch_queries", F.ceil(F.col("canonical_prefetch_tiles") / config.prefetch_batch))


def report_violations(report: DataFrame) -> DataFrame:
    """Names of the identities that a full report breaks (none for a sound one)."""
    c = F.col
    routes = sum((c(f"route_{x}") for x in ROUTES), F.lit(0))
    matchable = c("active_candidates_compared") + c("closed_candidates_compared")
    rules = {
        "routes": routes != c("candidate_rows"), "active": c("active_candidates_compared") != c("route_ready_for_match"), "closed": c("closed_candidates_compared") != c("route_closed_evidence_candidate"),
        "decisions": c("decision_rows") != c("candidate_rows"), "active_dispositions": c("matched_existing_places") + c("ambiguous_review_candidates") + c("likely_new_unmatched_candidates") != c("active_candidates_compared"),
        "closed_dispositions": c("closed_signals_matched") + c("closed_evidence_dropped") != c("closed_candidates_compared"), "source_ids": c("active_matches_with_source_id") > c("matched_existing_places"),
        "prefetched": c("canonical_rows_prefetched") > c("canonical_snapshot_rows"), "cells": c("grid_cells_built") > c("canonical_rows_prefetched"), "tiles": c("canonical_prefetch_tiles") > matchable,
        "no_tiles": (c("canonical_prefetch_tiles") == 0) != (matchable == 0), "no_cells": (c("grid_cells_built") == 0) != (c("canonical_rows_prefetched") == 0),
    }
    broken = F.array_compact(F.array(*(F.when(cond, name) for name, cond in rules.items())))
    return report.select(F.explode(broken).alias("violation"))


def decision_violations(decisions: DataFrame) -> DataFrame:
    """Decisions whose route, disposition, method and places do not go together (none for sound ones)."""
    d, r, m = F.col("disposition"), F.col("route"), F.col("best_match_method")
    compared = r.isin(*ROUTES[:2])
    accepted, ambiguous = F.coalesce(m.isin(*ACCEPTED), F.lit(False)), F.coalesce(m.isin("weak_spatial_name", "spatial_only_review"), F.lit(False))
    best, nearest = F.col("best_canonical_place_id").isNotNull(), F.col("nearest_place_id").isNotNull()
    wrong = (
        ((d == "not_compared") & (compared | best | nearest)) | ((d != "not_compared") & ~compared) | ((d == "matched_existing") & ((r != ROUTES[0]) | ~accepted)) | ((d == "ambiguous_review") & ((r != ROUTES[0]) | ~ambiguous))
        | ((d == "likely_new") & ((r != ROUTES[0]) | (F.coalesce(m, F.lit("no_match")) != "no_match"))) | ((d == "closed_evidence") & ((r != ROUTES[1]) | ~accepted | ~F.col("stable_source_id_present")))
        | ((d == "closed_evidence_dropped") & ((r != ROUTES[1]) | (accepted & F.col("stable_source_id_present")))) | (best != nearest) | F.coalesce(F.col("nearest_distance_m") > F.col("best_distance_m"), F.lit(False))
    )
    return decisions.where(wrong)


def reconciled(candidates: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """How many candidates and decisions stand for each key, where that is not one each (none for a sound run)."""
    both = candidates.select(*keys, F.lit(1).alias("c"), F.lit(0).alias("d")).unionByName(decisions.select(*keys, F.lit(0).alias("c"), F.lit(1).alias("d")))
    return both.groupBy(*keys).agg(F.sum("c").alias("candidates"), F.sum("d").alias("decisions")).where("candidates <> 1 or decisions <> 1")


def positional_differences(expected: DataFrame, actual: DataFrame, order: list[str], columns: list[str], actual_order: list[str] | None = None) -> DataFrame:
    """Number, side and differs where the two tables are not the same row for row: rows that one side lacks, and columns whose values differ (nulls are equal).

    Rows are numbered by `order` on both sides (`actual_order`: if the second
    has another) and joined by the number; equal tables give no row.
    """
    a = running(expected.select(*dict.fromkeys([*order, *columns])), order).select("number", F.struct(*columns).alias("a"))
    b = running(actual.select(*dict.fromkeys([*(actual_order or order), *columns])), actual_order or order).select("number", F.struct(*columns).alias("b"))
    both = a.join(b, "number", "full")
    differs = F.array_compact(F.array(*(F.when(~F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")), c) for c in columns)))
    side = F.when(F.col("b").isNull(), "expected_only").when(F.col("a").isNull(), "actual_only").otherwise("both")
    out = both.select("number", side.alias("side"), F.when(side == "both", differs).otherwise(F.array().cast("array<string>")).alias("differs"))
    return out.where((F.col("side") != "both") | (F.size("differs") > 0))


def match_confidence(score: Column, distance: Column, method: Column) -> Column:
    """M8: three parts name and one part nearness, at least .9 with an identifier, within [.0001, 1]."""
    mixed = score * 0.75 + F.greatest(F.lit(0.0), F.lit(1.0) - distance / 100.0) * 0.25
    mixed = F.when(method == "exact_identifier_nearby", F.greatest(mixed, F.lit(0.9))).otherwise(mixed)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0001), mixed))


def nearby_places(rows: DataFrame, places: DataFrame, reach_m: float = 150.0, top: int = 3, skip=("closed", "replaced", "demolished")) -> DataFrame:
    """Up to `top` open places within `reach_m` of each row, distances rounded to centimetres."""
    right = places.where(~F.coalesce(F.col("lifecycle_status"), F.lit("")).isin(*skip)).select("canonical_place_id", F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    pairs = grid_pairs(rows.select("source_id", "lat", "lng"), right, reach_m, 0.002)
    order = Window.partitionBy("source_id").orderBy("distance_m", "canonical_place_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("source_id", "rank", "canonical_place_id", F.round("distance_m", 2).alias("distance_m"))


def nearest_sibling(rows: DataFrame, reach_m: float = 25.0) -> DataFrame:
    """Of the rows' other source ids the nearest within `reach_m`."""
    other = rows.select(F.col("source_id").alias("o_id"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    pairs = grid_pairs(rows.select("source_id", "lat", "lng"), other, reach_m, 0.0005).where("source_id <> o_id")
    return pairs.groupBy("source_id").agg(F.min(F.struct("distance_m", "o_id")).alias("m")).select("source_id", F.col("m.o_id").alias("sibling_id"), F.round("m.distance_m", 2).alias("distance_m"))


def same_coordinates(rows: DataFrame, others: DataFrame, delta: float = 1e-5) -> DataFrame:
    """Rows that have another row (other id) within `delta` degrees on both axes; the join is sorted as that of `grid_pairs`."""
    spread = geo.neighbours(rows.select("source_id", "lat", "lng"), "lat", "lng", delta, 1)
    placed = others.select(F.col("source_id").alias("o_id"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng")).withColumn("cy", geo.cell(F.col("p_lat"), delta)).withColumn("cx", geo.cell(F.col("p_lng"), delta))
    hit = spread.join(placed.hint("merge"), ["cy", "cx"]).where((F.abs(F.col("lat") - F.col("p_lat")) < delta) & (F.abs(F.col("lng") - F.col("p_lng")) < delta) & (F.col("source_id") != F.col("o_id")))
    return hit.groupBy("source_id").agg(F.countDistinct("o_id").alias("n_same"))

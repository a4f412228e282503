"""Tile grids, merges, and region priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: region codes by priority
MAJOR_STATES = ("NY", "CA", "TX", "FL", "IL", "PA", "OH", "GA", "NC", "NJ", "VA", "WA", "AZ", "MA", "TN", "IN", "MO", "MD", "WI", "CO", "MN", "SC", "AL", "LA", "KY", "OR", "OK", "CT", "UT", "NV")
STATES = ("AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC")
PROVINCES = ("ON", "QC", "BC", "AB", "MB", "SK", "NS", "NB", "NL", "PE", "NT", "YT", "NU")
EUROPE = ("GB", "DE", "FR", "IT", "ES", "NL", "BE", "AT", "CH", "PT", "IE", "DK", "SE", "NO", "FI", "PL", "CZ", "GR", "HU", "RO", "BG", "HR", "SK", "SI", "LT", "LV", "EE", "LU", "MT", "CY")
LATIN_AMERICA = ("MEX", "BRA", "ARG", "COL", "PER", "VEN", "CHL", "ECU", "GTM", "CUB", "DOM", "BOL", "HND", "SLV", "PRY", "NIC", "CRI", "PAN", "URY", "JAM", "TTO", "PRI")


def region_priority(state: Column, country: Column) -> Column:
    """100 for Michigan, then major states, other states, Canada, Mexico, Europe, Latin America, the rest."""
    s, c = F.upper(F.coalesce(state, F.lit(""))), F.coalesce(country, F.lit(""))
    return (
        F.when(s == "", 30).when(s == "MI", 100).when(s.isin(*MAJOR_STATES), 95).when(s.isin(*STATES), 80).when(s.isin(*PROVINCES) | (c == "CA"), 60)
        .when((c == "MX") | s.isin("MX", "MEX"), 55).when(s.isin(*EUROPE), 50).when(s.isin(*LATIN_AMERICA), 40).otherwise(30)
    )


# fixed values: names of the priority groups, from their priority on
GROUPS = ((100, "michigan"), (95, "major_us"), (80, "other_us"), (60, "canada"), (55, "mexico"), (50, "europe"), (40, "latin_america"))


def region_group(priority: Column) -> Column:
    """The name of a priority's group."""
    out = F.lit("rest_of_world")
    for least, name in reversed(GROUPS):
        out = F.when(priority >= least, name).otherwise(out)
    return out


def grid(spark: SparkSession, bbox: tuple[float, float, float, float], step: float) -> DataFrame:
    """Tiles of a box, clipped at its far sides, without slivers."""
    south, west, north, east = bbox
    axis = lambda a, b: F.explode(F.transform(F.sequence(F.lit(0), F.lit(max(0, int((b - a) / step + 1)))), lambda k: F.round(F.lit(a) + k * F.lit(step), 6)))
    rows = spark.range(1).select(axis(south, north).alias("south")).where(F.col("south") < north).select("south", axis(west, east).alias("west")).where(F.col("west") < east)
    return rows.select("south", "west", F.round(F.least(F.col("south") + step, F.lit(north)), 6).alias("north"), F.round(F.least(F.col("west") + step, F.lit(east)), 6).alias("east"))


def split_boxes(boxes: DataFrame, n: int) -> DataFrame:
    """Each box (south, west, north, east, and what else it holds) as n by n boxes with row and col from the south-west."""
    steps = lambda: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cut = lambda a, b, k: F.round(F.col(f"_box.{a}") + k * ((F.col(f"_box.{b}") - F.col(f"_box.{a}")) / n), 6)
    rows = boxes.withColumn("_box", F.struct("south", "west", "north", "east")).withColumn("row", steps()).withColumn("col", steps())
    sides = {"south": cut("south", "north", F.col("row")), "north": cut("south", "north", F.col("row") + 1), "west": cut("west", "east", F.col("col")), "east": cut("west", "east", F.col("col") + 1)}
    return rows.withColumns(sides).drop("_box")


def covering(places: DataFrame, step: float) -> DataFrame:
    """The grid of the box around all places, with how many stand in each tile (the far sides belong to the last tiles)."""
    spark = places.sparkSession
    box = places.agg(F.min("lat"), F.min("lng"), F.max("lat"), F.max("lng")).first()
    if box[0] is None:
        return spark.createDataFrame([], "south double, west double, north double, east double, n long")
    last = [max(0, -(-round((b - a) * 1e6) // round(step * 1e6)) - 1) for a, b in ((box[0], box[2]), (box[1], box[3]))]
    index = lambda c, a, k: F.least(F.floor(F.round((F.col(c) - F.lit(a)) / F.lit(step), 6)), F.lit(k))
    counts = places.where("lat is not null and lng is not null").groupBy(index("lat", box[0], last[0]).alias("i"), index("lng", box[1], last[1]).alias("j")).agg(F.count("*").alias("n"))
    tiled = grid(spark, tuple(box), step).withColumns({"i": F.floor(F.round((F.col("south") - F.lit(box[0])) / F.lit(step), 6)), "j": F.floor(F.round((F.col("west") - F.lit(box[1])) / F.lit(step), 6))})
    return tiled.join(counts, ["i", "j"], "left").select("south", "west", "north", "east", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def run_tiles(tiles: DataFrame, timed_out: Column, floor: int = 1) -> DataFrame:
    """Tiles with depth, path (quadrants, 0 to 3 from the south-west, row by row) and status: a tile that times out is split into four.

    tiles: tile, south, west, north, east and what `timed_out` reads; it may
    read depth and seed (the tile's own, then 4 * seed + quadrant) too. Each
    level of four is tried in turn down to `floor`, where a time-out is
    `failed`; others are `success`. A split tile is `success` if all below it
    are, else `partial`: its good parts count, and only the failed ones are
    tried again.
    """
    level = tiles.withColumns({"depth": F.lit(0), "path": F.lit("")})
    late = F.coalesce(timed_out, F.lit(False))
    leaves = []
    middle = lambda a, b: (F.col(a) + F.col(b)) / 2
    for depth in range(floor):
        judged = level.withColumn("_late", late)
        leaves.append(judged.where("not _late").drop("_late").withColumn("status", F.lit("success")))
        parts = judged.where("_late").drop("_late").withColumn("_q", F.explode(F.array(*map(F.lit, range(4)))))
        upper, right = F.col("_q") >= 2, F.col("_q") % 2 == 1
        level = parts.withColumns({
            "south": F.when(upper, middle("south", "north")).otherwise(F.col("south")), "north": F.when(upper, F.col("north")).otherwise(middle("south", "north")),
            "west": F.when(right, middle("west", "east")).otherwise(F.col("west")), "east": F.when(right, F.col("east")).otherwise(middle("west", "east")),
            "depth": F.lit(depth + 1), "path": F.concat("path", F.col("_q").cast("string")), "seed": F.col("seed") * 4 + F.col("_q"),
        }).drop("_q")
    leaves.append(level.withColumn("status", F.when(late, "failed").otherwise("success")))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    # a leaf counts for every tile above it; corners of a split tile are those of its leaves
    above = out.where("path <> ''").select("tile", "south", "west", "north", "east", "status", F.explode(F.transform(F.sequence(F.lit(0), F.length("path") - 1), lambda k: F.substring("path", 1, k))).alias("path"))
    split_ones = above.groupBy("tile", "path").agg(
        F.min("south").alias("south"), F.min("west").alias("west"), F.max("north").alias("north"), F.max("east").alias("east"), F.when(F.count_if(F.col("status") == "failed") > 0, "partial").otherwise("success").alias("status"),
    )
    columns = ["tile", "path", F.length("path").alias("depth"), "south", "west", "north", "east", "status"]
    return out.select(*columns, F.lit(False).alias("is_split")).unionByName(split_ones.select(*columns, F.lit(True).alias("is_split")))


def merge(rows: DataFrame, key: str, sequence: str) -> DataFrame:
    """Of all tiles the last row of each id."""
    last = Window.partitionBy(key).orderBy(F.desc(sequence))
    return rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def tile_page(rows: DataFrame, bbox: tuple[float, float, float, float], categories: list[str], limit: int, after: str | None = None, country: str = "US") -> DataFrame:
    """The next page of a tile by id: places of the country inside the box, not closed for good, whose taxonomy (or an alternate) is wanted.

    rows: id, names.primary, confidence, basic_category, taxonomy (primary,
    hierarchy, alternates), addresses, websites, phones, sources, bbox and
    operating_status; nested values come as JSON.
    """
    south, west, north, east = bbox
    wanted = F.array(*(F.lit(c) for c in categories))
    meets = lambda c: F.coalesce(F.arrays_overlap(F.col(c), wanted), F.lit(False))
    first = lambda f: F.try_element_at("addresses", F.lit(1))[f]
    inside = F.col("bbox.xmin").between(west, east) & F.col("bbox.ymin").between(south, north)
    kept = rows.where((meets("taxonomy.hierarchy") | meets("taxonomy.alternates")) & (first("country") == country) & inside & (F.coalesce("operating_status", F.lit("open")) != "permanently_closed"))
    kept = kept if after is None else kept.where(F.col("id") > after)
    return kept.orderBy("id").limit(limit).select(
        "id", F.col("names.primary").alias("name"), "confidence", "basic_category", F.col("taxonomy.primary").alias("primary_category"), F.to_json("taxonomy").alias("taxonomy"), "operating_status",
        F.col("bbox.xmin").alias("lng"), F.col("bbox.ymin").alias("lat"), first("freeform").alias("address"), *(first(f).alias(f) for f in ("locality", "region", "postcode", "country")),
        *(F.to_json(c).alias(n) for c, n in (("websites", "websites"), ("phones", "phones"), ("sources", "record_sources"))),
    )

"""Inference from fixed rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeforge.functions.text import any_contains, bound, literals

# fixed values: chains and their pizza style, first hit in this order
CHAIN_STYLES = {
    "st. louis pizza": "St. Louis", "st louis pizza": "St. Louis",
    "buddy's": "Detroit", "buddy's pizza": "Detroit", "shield's": "Detroit", "shields pizza": "Detroit", "jet's": "Detroit", "jets": "Detroit", "jets pizza": "Detroit",
    "loui's": "Detroit", "louis pizza": "Detroit", "cloverleaf": "Detroit", "michigan & trumbull": "Detroit", "supino": "Detroit", "via 313": "Detroit", "blue pan": "Detroit",
    "lou malnati's": "Chicago Deep Dish", "lou malnatis": "Chicago Deep Dish", "giordano's": "Chicago Deep Dish", "giordanos": "Chicago Deep Dish", "pequod's": "Chicago Deep Dish",
    "pequods": "Chicago Deep Dish", "gino's east": "Chicago Deep Dish", "ginos east": "Chicago Deep Dish", "chicago's pizza": "Chicago Deep Dish", "chicago pizza": "Chicago Deep Dish",
    "uno pizzeria": "Chicago Deep Dish", "due pizzeria": "Chicago Deep Dish",
    "little caesars": "Standard Round", "little caesar's": "Standard Round", "domino's": "Standard Round", "dominos": "Standard Round", "pizza hut": "Standard Round",
    "papa john's": "Standard Round", "papa johns": "Standard Round", "marco's": "Standard Round", "marcos pizza": "Standard Round", "hungry howie's": "Standard Round",
    "hungry howies": "Standard Round", "papa murphy's": "Standard Round", "papa murphys": "Standard Round", "papa romano's": "Standard Round", "papa romanos": "Standard Round",
    "b.c. pizza": "Standard Round", "bc pizza": "Standard Round", "best choice pizza": "Standard Round", "chuck e. cheese": "Standard Round", "chuck e cheese": "Standard Round",
    "cici's": "Standard Round", "cicis pizza": "Standard Round", "sbarro": "New York", "godfather's": "Standard Round", "godfathers pizza": "Standard Round",
    "fox's pizza": "Standard Round", "foxs pizza": "Standard Round", "round table": "Standard Round", "simple simon's": "Standard Round", "simple simons": "Standard Round",
    "simple simon's pizza": "Standard Round", "simple simons pizza": "Standard Round", "mountain mike's": "Standard Round", "pizza ranch": "Standard Round",
    "toppers pizza": "Standard Round", "donatos": "Standard Round", "mod pizza": "Standard Round", "blaze pizza": "Standard Round", "pieology": "Standard Round",
    "your pie": "Standard Round", "&pizza": "Standard Round", "larosa's": "Standard Round", "larosas": "Standard Round", "larosa's pizzeria": "Standard Round",
    "larosas pizzeria": "Standard Round", "sal's pizza": "Standard Round", "sals pizza": "Standard Round",
    "cottage inn": "Standard Round", "mancino's": "Standard Round", "mancinos": "Standard Round", "pizza house": "Standard Round", "backroom pizza": "Standard Round",
    "toarmina's": "Standard Round", "toarminas": "Standard Round",
}
# fixed values: words and their pizza style, first hit in this order
STYLE_WORDS = {
    "detroit": "Detroit", "detroit style": "Detroit", "detroit-style": "Detroit", "square pan": "Detroit",
    "new haven": "New Haven / Connecticut", "new haven style": "New Haven / Connecticut", "connecticut style": "New Haven / Connecticut", "apizza": "New Haven / Connecticut",
    "chicago tavern": "Chicago Tavern", "chicago thin": "Chicago Tavern", "chicago": "Chicago Deep Dish", "deep dish": "Chicago Deep Dish", "deep-dish": "Chicago Deep Dish",
    "stuffed pizza": "Chicago Deep Dish", "new york": "New York", "ny style": "New York", "ny-style": "New York", "brooklyn": "New York", "slice house": "New York",
    "slice shop": "New York", "neapolitan": "Neapolitan", "napoletana": "Neapolitan", "napoli": "Neapolitan", "wood fired": "Neapolitan", "wood-fired": "Neapolitan",
    "brick oven": "Neapolitan", "coal fired": "Neapolitan", "forno": "Neapolitan", "vera pizza": "Neapolitan", "margherita": "Neapolitan", "sicilian": "Sicilian",
    "sicily": "Sicilian", "grandma": "Grandma", "grandma style": "Grandma", "grandma pizza": "Grandma", "roman": "Roman", "al taglio": "Roman", "pizza al taglio": "Roman",
    "st. louis": "St. Louis", "st louis": "St. Louis", "st-louis": "St. Louis", "tavern": "Tavern", "tavern style": "Tavern", "party cut": "Tavern", "square cut": "Tavern",
}
# fixed values: chains and their price band, first hit in this order
CHAIN_PRICES = {
    "little caesars": "$", "little caesar's": "$", "domino's": "$", "dominos": "$", "hungry howie's": "$", "hungry howies": "$", "cici's": "$", "cicis pizza": "$", "papa murphy's": "$",
    "b.c. pizza": "$$", "bc pizza": "$$", "best choice pizza": "$$", "pizza hut": "$$", "papa john's": "$$", "papa johns": "$$", "fox's pizza": "$$", "foxs pizza": "$$",
    "pizza ranch": "$$", "round table": "$$", "round table pizza": "$$", "simple simon's": "$$", "simple simons": "$$", "simple simon's pizza": "$$", "simple simons pizza": "$$",
    "jet's": "$$", "jets": "$$", "jets pizza": "$$", "buddy's": "$$", "buddy's pizza": "$$", "blaze pizza": "$$", "mod pizza": "$$", "marco's": "$$", "marcos pizza": "$$",
    "cottage inn": "$$", "mancino's": "$$", "sbarro": "$$", "chuck e. cheese": "$$", "toppers pizza": "$$", "donatos": "$$", "pieology": "$$", "&pizza": "$$", "larosa's": "$$",
    "larosas": "$$", "larosa's pizzeria": "$$", "larosas pizzeria": "$$", "sal's pizza": "$$", "sals pizza": "$$", "shield's": "$$", "toarmina's": "$$",
    "lou malnati's": "$$$", "giordano's": "$$$", "uno pizzeria": "$$$",
}
# fixed values: brands by their knowledge-base id
BRAND_STYLES = {"Q15109854": "California", "Q7897209": "Chicago Deep Dish", "Q5652393": "Standard Round"}
# fixed values: category words and their style, first hit in this order
CATEGORY_STYLES = (
    (("detroit",), "Detroit"), (("new haven", "connecticut"), "New Haven / Connecticut"), (("chicago", "deep dish"), "Chicago Deep Dish"),
    (("neapolitan", "wood-fired"), "Neapolitan"), (("new york", "ny style"), "New York"), (("sicilian",), "Sicilian"), (("grandma",), "Grandma"),
)
# fixed values: words of municipal use types and groups, by category
DETROIT_USES = (
    ("HOUSING", ("single family", "two family", "multi-family", "multifamily", "residential", "dwelling", "apartment", "condo", "townhouse", "duplex", "triplex"), ("r-1", "r-2", "r-3", "r-4", "r1", "r2", "r3", "r4")),
    ("FOOD", ("restaurant", "food", "cafe", "coffee", "bar", "tavern", "bakery", "grocery", "kitchen", "catering", "brewery", "distillery"), ()),
    ("RETAIL", ("retail", "store", "shop", "mercantile", "sales", "showroom", "mall", "boutique"), ("m",)),
    ("OFFICE", ("office", "business", "professional", "corporate", "coworking"), ("b",)),
    ("INFRA", ("utility", "industrial", "warehouse", "factory", "assembly", "storage", "manufacturing", "distribution", "parking", "garage", "hospital", "school", "church", "religious", "government", "municipal"), ("f", "s", "h", "i")),
)
MINOR_WORK = ("mechanical", "electrical", "plumbing", "sign", "fence", "fire alarm", "sprinkler")


def plain_name(name: Column) -> Column:
    """Lower case with single spaces and straight quotes."""
    return F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(name, F.lit(""))), "‘’“”", "''\"\""), r"\s+", " "))


def first_hit(text: Column, table: dict[str, str]) -> Column:
    """(match, value) of the first key in order that stands in the text; null without one."""
    keys, values = literals(table), literals((x for pair in table.items() for x in pair), "map")
    hit = bound(text, lambda x: F.try_element_at(F.filter(keys, lambda k: F.contains(x, k)), F.lit(1)))
    return bound(hit, lambda h: F.when(h.isNotNull(), F.struct(h.alias("match"), values[h].alias("value"))))


def style_from_name(name: Column, address: Column) -> tuple[Column, Column, Column]:
    """Style, confidence and source: chain, then a word of the name, then one of the address."""
    n, a = plain_name(name), plain_name(address)
    chain, word, place = first_hit(n, CHAIN_STYLES), first_hit(n, STYLE_WORDS), first_hit(a, STYLE_WORDS)
    level = lambda x, y, z: F.when(chain.isNotNull(), x).when(word.isNotNull(), y).when(place.isNotNull(), z)
    return F.coalesce(chain, word, place)["value"], level("high", "medium", "low"), level("chain_map", "keyword", "address_keyword")


def style_from_brand(brand: Column) -> Column:
    """E2."""
    return F.create_map(*(F.lit(x) for pair in BRAND_STYLES.items() for x in pair))[F.trim(F.coalesce(brand, F.lit("")))]


def price_from_chain(name: Column) -> Column:
    """E3."""
    return first_hit(plain_name(name), CHAIN_PRICES)["value"]


def known_chain(name: Column) -> Column:
    """E4."""
    return any_contains(plain_name(name), dict.fromkeys([*CHAIN_STYLES, *CHAIN_PRICES]))


def style_from_categories(categories: Column) -> Column:
    """E5."""
    words = F.lower(F.array_join(categories, " "))
    out = F.lit(None).cast("string")
    for keys, style in reversed(CATEGORY_STYLES):
        out = F.when(any_contains(words, keys), style).otherwise(out)
    return out


def detroit_category(use: Column, group: Column) -> Column:
    """The first category whose words stand in the use type or the use group."""
    u, g = F.lower(F.coalesce(use, F.lit(""))), F.lower(F.coalesce(group, F.lit("")))
    out = F.lit("OTHER")
    for name, uses, groups in reversed(DETROIT_USES):
        out = F.when(any_contains(u, uses) | any_contains(g, groups), name).otherwise(out)
    return out


def ann_arbor_category(kind: Column, cls: Column) -> Column:
    """N21 for plan cases."""
    t, c = F.lower(F.coalesce(kind, F.lit(""))), F.lower(F.coalesce(cls, F.lit("")))
    site = F.when(any_contains(c, ("residential", "apartment", "housing", "condo")), "HOUSING").when(any_contains(c, ("restaurant", "food", "cafe", "bar")), "FOOD").when(any_contains(c, ("retail", "commercial", "store", "shop")), "RETAIL").when(any_contains(c, ("office", "business")), "OFFICE").otherwise("OTHER")
    zone = F.when(any_contains(c, ("residential", "pud", "r1", "r2")), "HOUSING").when(any_contains(c, ("commercial", "c1", "c2")), "RETAIL").otherwise("OTHER")
    return (
        F.when(any_contains(t, ("site plan",)), site)
        .when(any_contains(t, ("rezoning", "rezone")), zone)
        .when(any_contains(t, ("design review", "zoning board", "zba")), "OTHER")
        .when(any_contains(t, ("annexation", "land division")), "HOUSING")
        .when(any_contains(t, ("aaps", "street vacation")) | any_contains(c, ("aaps", "school")), "INFRA")
        .otherwise("OTHER")
    )


def detroit_scale(kind: Column, cost: Column, units: Column) -> Column:
    """By permit type, then by cost and units."""
    t, c, u = F.lower(F.coalesce(kind, F.lit(""))), F.coalesce(cost, F.lit(0.0)), F.coalesce(units, F.lit(0).cast("long"))
    return (
        F.when(any_contains(t, MINOR_WORK), "MINOR")
        .when((t == "new") | any_contains(t, ("new construction", "new building")), F.when((u >= 5) | (c >= 500000), "MAJOR").otherwise("MODERATE"))
        .when(any_contains(t, ("demo",)), F.when((u >= 5) | (c >= 100000), "MAJOR").otherwise("MODERATE"))
        .when(any_contains(t, ("addition",)), F.when((u >= 3) | (c >= 250000), "MAJOR").when(c >= 50000, "MODERATE").otherwise("MINOR"))
        .when(any_contains(t, ("alteration", "renovation", "remodel")), F.when(c < 25000, "MINOR").otherwise("MODERATE"))
        .when(c >= 500000, "MAJOR")
        .when(c >= 50000, "MODERATE")
        .when((c < 15000) & (c > 0), "MINOR")
        .otherwise("MODERATE")
    )


def ann_arbor_scale(kind: Column, cls: Column) -> Column:
    """N22 for plan cases."""
    t, c = F.lower(F.coalesce(kind, F.lit(""))), F.lower(F.coalesce(cls, F.lit("")))
    return (
        F.when(any_contains(t, ("rezoning", "rezone")), "MAJOR")
        .when(any_contains(t, ("site plan",)), F.when(any_contains(c, ("pud", "planned unit", "multi", "apartment", "mixed use", "development")), "MAJOR").otherwise("MODERATE"))
        .when(any_contains(t, ("design review", "annexation", "special use")), "MODERATE")
        .when(any_contains(t, ("land division", "lot split", "zoning board", "zba", "variance")), "MINOR")
        .otherwise("MODERATE")
    )


def price_band(average: Column) -> Column:
    """Bands of an average price."""
    return F.when(average < 10, "$").when(average < 20, "$$").when(average < 35, "$$$").when(average.isNotNull(), "$$$$")


# fixed values: taco chains with their types and price band, first hit in this order
TACO_CHAINS = {
    "taco bell": ("Ground Beef, Pollo", "$"), "del taco": ("Ground Beef, Pollo, Carne Asada", "$"), "taco cabana": ("Pollo, Carne Asada, Carnitas", "$"),
    "taco john's": ("Ground Beef, Pollo", "$"), "taco johns": ("Ground Beef, Pollo", "$"), "taco bueno": ("Ground Beef, Pollo", "$"), "taco casa": ("Ground Beef, Pollo", "$"),
    "taco mayo": ("Ground Beef, Pollo", "$"), "taco time": ("Ground Beef, Pollo", "$"), "jimboy's tacos": ("Ground Beef", "$"), "jimboys tacos": ("Ground Beef", "$"),
    "jack in the box": ("Ground Beef", "$"), "el pollo loco": ("Pollo, Carne Asada", "$"), "rubio's": ("Fish, Shrimp", "$$"), "rubios": ("Fish, Shrimp", "$$"),
    "rubio's coastal grill": ("Fish, Shrimp", "$$"), "chronic tacos": ("Carne Asada, Al Pastor, Carnitas", "$$"), "fuzzy's taco shop": ("Ground Beef, Pollo, Fish", "$$"),
    "fuzzys taco shop": ("Ground Beef, Pollo, Fish", "$$"), "torchy's tacos": ("Carne Asada, Pollo, Fish", "$$"), "torchys tacos": ("Carne Asada, Pollo, Fish", "$$"),
    "velvet taco": ("Carne Asada, Pollo", "$$"), "bartaco": ("Carne Asada, Pollo, Fish", "$$"), "tacodeli": ("Carne Asada, Pollo, Barbacoa", "$$"),
    "taco republic": ("Al Pastor, Carne Asada, Carnitas", "$$"), "taco palenque": ("Carne Asada, Al Pastor, Barbacoa", "$"), "taqueria arandas": ("Al Pastor, Carnitas, Carne Asada", "$"),
    "taqueria datapoint": ("Al Pastor, Carnitas", "$"), "king taco": ("Al Pastor, Carne Asada", "$"), "los tacos no.": ("Al Pastor, Carne Asada", "$"),
    "tacos el gordo": ("Al Pastor, Carne Asada, Lengua", "$"), "tacos gavilan": ("Carne Asada, Al Pastor", "$"), "birrieria": ("Birria", "$"), "la birria": ("Birria", "$"),
    "birria don boni": ("Birria", "$"), "birria landia": ("Birria", "$"), "mariscos": ("Shrimp, Fish", "$$"), "el torito mariscos": ("Shrimp, Fish", "$$"), "tacos de mariscos": ("Shrimp, Fish", "$$"),
}
# fixed values: words and their taco type, in this order
TACO_WORDS = {
    "birria": "Birria", "birrieria": "Birria", "quesabirria": "Birria", "pastor": "Al Pastor", "al pastor": "Al Pastor", "adobada": "Al Pastor", "asada": "Carne Asada",
    "carne asada": "Carne Asada", "carnitas": "Carnitas", "pollo": "Pollo", "chicken": "Pollo", "barbacoa": "Barbacoa", "lengua": "Lengua", "cabeza": "Cabeza", "chorizo": "Chorizo",
    "pescado": "Fish", "fish taco": "Fish", "baja": "Fish", "camarones": "Shrimp", "shrimp": "Shrimp", "mariscos": "Shrimp",
}
# fixed values: further taco chains and their price band, first hit in this order
TACO_PRICES = {
    "taco bell": "$", "del taco": "$", "taco bueno": "$", "taco john's": "$", "taco johns": "$", "taco cabana": "$", "taco casa": "$", "taco mayo": "$", "taco time": "$",
    "taco palenque": "$", "king taco": "$", "tacos el gordo": "$", "rubio's": "$$", "rubios": "$$", "chronic tacos": "$$", "fuzzy's taco shop": "$$", "fuzzys taco shop": "$$",
    "torchy's tacos": "$$", "torchys tacos": "$$", "velvet taco": "$$", "bartaco": "$$", "tacodeli": "$$", "wahoo's fish taco": "$$$", "wahoos fish taco": "$$$",
}
# fixed values: words that support a pizza style, that point to pizza at all, and that support a taco type
STYLE_EVIDENCE = {
    "Detroit": ("detroit",), "New Haven / Connecticut": ("new haven", "connecticut", "apizza"), "Chicago Deep Dish": ("chicago", "deep dish", "deep-dish", "stuffed"),
    "Chicago Tavern": ("chicago tavern", "chicago thin"), "New York": ("new york", "ny style", "ny-style", "brooklyn"),
    "Neapolitan": ("neapolitan", "wood fired", "wood-fired", "brick oven", "coal fired", "napoletana", "napoli"), "Sicilian": ("sicilian",), "Grandma": ("grandma",),
    "Roman": ("roman", "al taglio", "taglio"), "St. Louis": ("st. louis", "st louis", "st-louis"), "Tavern": ("tavern", "party cut", "thin crust", "square cut"), "California": ("california",),
    "Standard Round": ("pizza", "pizzeria", "pizzaria", "pizzer\u00eda", "pizzas", "domino", "pizza hut", "papa john", "little caesars", "sbarro"),
}
PIZZA_SIGNALS = ("pizza", "pizzeria", "pizzaria", "pizzer\u00eda", "pizzas", "pizz", "slice", "slices", "pie", 'cuisine":"pizza', "cuisine:pizza", "italian")
TACO_EVIDENCE = {
    "Al Pastor": ("al pastor", "pastor", "adobada"), "Carne Asada": ("carne asada", "asada"), "Carnitas": ("carnitas",), "Chorizo": ("chorizo",), "Pollo": ("pollo", "chicken"),
    "Barbacoa": ("barbacoa",), "Birria": ("birria", "birrieria", "quesabirria"), "Lengua": ("lengua",), "Fish": ("fish taco", "pescado"), "Shrimp": ("shrimp", "camarones"),
    "Ground Beef": ("ground beef",), "Cabeza": ("cabeza",), "Veggie": ("veggie", "vegetarian"),
}
PRICE_KEYS = ("price_hint", "pricerange", "price_range", "price:range")
# fixed values: styles from the most to the least specific, and other names of styles
STYLES = ("New Haven / Connecticut", "Neapolitan", "Detroit", "Sicilian", "Grandma", "Roman", "Chicago Deep Dish", "Chicago Tavern", "New York", "California", "St. Louis", "Tavern", "Standard Round", "Other", "Unknown")
STYLE_ALIASES = {"Traditional": "Standard Round", "Standard": "Standard Round", "Chicago": "Chicago Deep Dish", "Connecticut style": "New Haven / Connecticut", "New Haven": "New Haven / Connecticut"}


def taco_types(name: Column, address: Column) -> tuple[Column, Column, Column]:
    """Types (comma-joined), confidence and price: a chain, else all words of the name, else the address's first word."""
    n, a = plain_name(name), plain_name(address)
    chain = first_hit(n, {k: v[0] for k, v in TACO_CHAINS.items()})
    first = first_hit(n, {k: v[1] for k, v in TACO_CHAINS.items()})
    price = F.when(first.isNotNull(), first["value"]).otherwise(first_hit(n, TACO_PRICES)["value"])
    words = F.array_distinct(F.array_compact(F.array(*(F.when(F.contains(n, F.lit(k)), v) for k, v in TACO_WORDS.items()))))
    place = first_hit(a, TACO_WORDS)
    types = F.when(chain.isNotNull(), chain["value"]).when(F.size(words) > 0, F.array_join(words, ", ")).otherwise(place["value"])
    return types, F.when(chain.isNotNull(), "high").when(F.size(words) > 0, "medium").when(place.isNotNull(), "low"), price


def taco_types_from_categories(categories: Column) -> Column:
    """E5 for tacos: comma-joined types in a fixed order; null without one."""
    words = F.lower(F.array_join(categories, " "))
    sea = any_contains(words, ("seafood", "fish", "mariscos"))
    found = F.array_compact(F.array(
        F.when(any_contains(words, ("birria",)), "Birria"), F.when(sea, "Fish"), F.when(sea, "Shrimp"), F.when(any_contains(words, ("pastor",)), "Al Pastor"),
        F.when(any_contains(words, ("street taco",)), "Carne Asada"), F.when(any_contains(words, ("carnitas",)), "Carnitas"),
    ))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def normalized_style(value: Column) -> Column:
    """Parts split at `,;|` through the aliases; the most specific one, Unknown if none is known, null if blank."""
    rank = {s.lower(): k for k, s in enumerate(STYLES)} | {a.lower(): STYLES.index(s) for a, s in STYLE_ALIASES.items()}
    table = F.create_map(*(x for k, v in rank.items() for x in (F.lit(k), F.lit(v))))
    best = F.array_min(F.transform(F.split(value, "[,;|]"), lambda p: table[F.lower(F.trim(p))]))
    return F.when(F.trim(F.coalesce(value, F.lit(""))) == "", F.lit(None)).otherwise(F.coalesce(F.element_at(F.array(*map(F.lit, STYLES)), best + 1), F.lit("Unknown")))


def has_words(text: Column, terms) -> Column:
    """A term stands in the text with no letter before or behind it; signs in a term match any signs."""
    import re

    pattern = "|".join(re.sub(r"[^a-z]+", "[^a-z]+", t.lower()) for t in terms)
    return F.lower(text).rlike(rf"(^|[^a-z])({pattern})([^a-z]|$)")


def evidence_text(*parts: Column) -> Column:
    """What is known of a place as one lower-cased text, empty parts left out."""
    return F.lower(F.concat_ws(" ", *(F.when(p != "", p) for p in parts)))


def has_style_evidence(style: Column, known: Column) -> Column:
    """A style (or none) that the known text supports; Other and Unknown need no support."""
    out = style.isNull() | style.isin("", "Other", "Unknown")
    for name, terms in STYLE_EVIDENCE.items():
        out = out | ((style == name) & any_contains(known, terms))
    return F.coalesce(out, F.lit(False))


def has_pizza_signal(known: Column) -> Column:
    return any_contains(known, PIZZA_SIGNALS)


def has_taco_evidence(kind: Column, known: Column) -> Column:
    """A taco type (or none) whose words stand in the known text with no letter before or behind."""
    out = kind.isNull() | (kind == "")
    for name, terms in TACO_EVIDENCE.items():
        out = out | ((kind == name) & has_words(known, terms))
    return F.coalesce(out, F.lit(False))


def has_price_evidence(price: Column, *sources: Column) -> Column:
    """A price band (or none) that a JSON source names under a price key at any depth."""
    key = "|".join(PRICE_KEYS)
    named = lambda s: F.exists(F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(rf'(?i)"(?:{key})"\s*:\s*"\s*(\$+)\s*"'), F.lit(1)), lambda x: x == price)
    shown = F.lit(False)
    for s in sources:
        shown = shown | named(s)
    return F.coalesce(price.isNull() | (price == "") | (price.rlike(r"^\${1,4}$") & shown), F.lit(False))

"""Text, number and identifier expressions (N1-N18, M1-M3), all as Columns that stay in the JVM."""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that carry no identity in a place name
NAME_STOP_WORDS = ("the", "and", "pizza", "pizzeria", "restaurant", "bar", "grill")
# fixed values: texts that mean "no closing date"
NO_DATE = ("null", "none", "unknown", "n/a", "not available")
# fixed values: street words and their abbreviations
STREET_WORDS = (("street", "st"), ("avenue", "ave"), ("drive", "dr"), ("boulevard", "blvd"), ("road", "rd"), ("lane", "ln"), ("court", "ct"), ("place", "pl"))
TRACKING = r"utm_[^=&]*|fbclid|gclid|mc_cid|mc_eid"


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def literals(values, form: str = "array") -> Column:
    """An array (or map) of text literals, built in one call."""
    quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"{form}({', '.join(quoted)})")


def any_contains(text: Column, terms) -> Column:
    """True if any of a fixed list of terms stands in the text."""
    terms = list(terms)
    if len(terms) <= 3:
        out = F.lit(False)
        for term in terms:
            out = out | F.contains(text, F.lit(term))
        return out
    return bound(text, lambda x: F.exists(literals(terms), lambda t: F.contains(x, t)))


def _foldings() -> tuple[str, str, dict[str, str]]:
    """From the Unicode tables: characters that fold to one ASCII sign and those signs (accents, without one, come last), and those that fold to several."""
    one, marks, several = {}, [], {}
    for point in range(0x80, 0x20000):
        c = chr(point)
        if 0x300 <= point <= 0x36F:
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not 0x300 <= ord(x) <= 0x36F)
        if len(plain) == 1 and plain.isascii():
            one[c] = plain
        elif len(plain) > 1 and any(x.isascii() for x in plain):
            several[c] = plain
    return "".join(one) + "".join(marks), "".join(one.values()), several


FOLDED, SIGNS, SEVERAL = _foldings()


def folded(text: Column) -> Column:
    """Compatibility decomposition without accents, as far as ASCII signs come of it. ASCII texts pass untouched, others stay in the JVM too.

    Signs that fold to several are rare: the distinct ones in a text are looked
    up and replaced one by one. A search by a class of all of them would try each
    of the hundreds at each letter.
    """
    table = F.from_json(F.lit(json.dumps(SEVERAL)), "map<string,string>")

    def spelled(x: Column) -> Column:
        rare = F.filter(F.array_distinct(F.split(F.regexp_replace(x, r"[\x00-\u024F]+", ""), "")), lambda c: F.map_contains_key(table, c))
        few = F.filter(literals([c for c in SEVERAL if c <= "\u024F"]), lambda c: F.contains(x, c))
        return F.aggregate(F.concat(few, rare), x, lambda t, c: F.replace(t, c, table[c]))

    return bound(text, lambda t: F.when(~t.rlike(r"[^\x00-\x7F]"), t).otherwise(F.translate(spelled(t), FOLDED, SIGNS)))


def normalized(text: Column) -> Column:
    """Lower case, without accents, `&` as a word, other signs as single spaces. Null gives ''."""
    low = folded(F.lower(F.coalesce(text.cast("string"), F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def name_tokens(norm: Column) -> Column:
    """M1: words of a normalized name longer than one letter that are no stop words."""
    return F.filter(F.split(norm, " "), lambda t: (F.length(t) > 1) & ~t.isin(*NAME_STOP_WORDS))


def name_score(left: Column, right: Column) -> Column:
    """M2 on columns of normalized names (made in an earlier select): 0 if blank, 1 if equal, .85 if one holds the other, else the share of shared words."""
    lt, rt = name_tokens(left), name_tokens(right)
    shared = F.size(F.filter(lt, lambda t: F.array_contains(rt, t)))
    return (
        F.when((left == "") | (right == ""), 0.0)
        .when(left == right, 1.0)
        .when(F.contains(left, right) | F.contains(right, left), 0.85)
        .when((F.size(lt) == 0) | (F.size(rt) == 0), 0.0)
        .otherwise(shared / F.greatest(F.size(lt), F.size(rt)))
    )


def phone_key(phone: Column) -> Column:
    """The last ten digits of at least seven, else ''."""
    digits = F.regexp_replace(F.coalesce(phone, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) >= 7, F.right(digits, F.lit(10))).otherwise("")


def url_key(url: Column) -> Column:
    """Lower case, without scheme, www and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^https?://(www\.)?", ""), "/+$", "")


def identifier_match(website: Column, phone: Column, other_website: Column, other_phone: Column) -> tuple[Column, Column]:
    """M3: equal page urls (not bare hosts), equal phones."""
    w, o = url_key(website), url_key(other_website)
    p, q = phone_key(phone), phone_key(other_phone)
    return (w != "") & (w == o) & F.contains(w, F.lit("/")), (p != "") & (p == q)


def flat_strings(text: Column) -> Column:
    """JSON arrays of strings are read, other text is split at `|`, `;` and `,`; blanks go."""
    pieces = lambda x: F.filter(F.transform(F.split(x, r"[|;,]"), lambda y: F.trim(y)), lambda y: y != "")
    listed = F.from_json(F.trim(text), "array<string>")
    parsed = F.trim(text).startswith("[") & listed.isNotNull()
    none = F.array().cast("array<string>")
    return F.when(text.isNull(), none).when(parsed, F.flatten(F.transform(F.filter(listed, lambda x: x.isNotNull()), pieces))).otherwise(pieces(text))


def first_string(text: Column) -> Column:
    """The first flat string, else the text itself if it has any sign."""
    return F.coalesce(F.try_element_at(flat_strings(text), F.lit(1)), F.when(text != "", text))


def finite_number(text: Column) -> Column:
    """Missing and blank are 0; what is no plain or hexadecimal number, or not finite, is null."""
    x = F.trim(F.coalesce(text.cast("string"), F.lit("")))
    plain = F.when(x.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), x.try_cast("double"))
    number = F.when(x == "", 0.0).when(x.rlike("^0[xX][0-9a-fA-F]+$"), F.conv(F.substring(x, 3, 30), 16, 10).try_cast("double")).otherwise(plain)
    return F.when(F.abs(number) < float("inf"), number)


def closed_date(text: Column, as_of: Column) -> Column:
    """Blank words mean open, unreadable text means closed, dates up to `as_of` mean closed."""
    x = F.trim(F.coalesce(text, F.lit("")))
    parsed = F.try_to_timestamp(x)
    return F.when((x == "") | F.lower(x).isin(*NO_DATE), False).otherwise(parsed.isNull() | (parsed <= as_of))


def number_prefix(text: Column, integer: bool = False) -> Column:
    """The number that a text starts with."""
    pattern = r"^\s*([+-]?[0-9]+)" if integer else r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    return F.regexp_extract(text, pattern, 1).try_cast("bigint" if integer else "double")


def short_address(address: Column) -> Column:
    """Lower case, without `.,#`, street words abbreviated."""
    out = F.regexp_replace(F.lower(F.coalesce(address, F.lit(""))), "[.,#]", "")
    for word, short in STREET_WORDS:
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def address_hash(address: Column) -> Column:
    """32-bit h*31+c over the UTF-16 units of the short address, its size in base 36."""
    def add(h: Column, char: Column) -> Column:  # a point above 0xFFFF is two units
        c = F.ascii(char).cast("long")
        pair = (h * 31 + F.floor((c - 0x10000) / 1024) + 0xD800) * 31 + c % 1024 + 0xDC00
        return F.when(c < 0x10000, h * 31 + c).otherwise(pair).bitwiseAND(F.lit((1 << 32) - 1))

    # the letters come from an array made once: inside the fold the address would be made anew for each letter
    letters = F.filter(F.split(short_address(address), ""), lambda c: c != "")
    size = F.aggregate(letters, F.lit(0).cast("long"), add, lambda h: F.when(h >= (1 << 31), F.lit(1 << 32) - h).otherwise(h))
    return F.lower(F.conv(size.cast("string"), 10, 36))


def canonical_website(url: Column) -> Column:
    """Quotes stripped, https by default, lower-case host, no userinfo, default port, fragment or tracking keys."""
    x = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "^['\"]+|['\"]+$", "")
    x = F.when(x == "", F.lit(None)).when(x.rlike("(?i)^https?://"), x).when(x.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:(?![0-9])"), F.lit(None)).otherwise(F.concat(F.lit("https://"), x))
    scheme = F.lower(F.regexp_extract(x, r"^([a-zA-Z]+)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(x, r"^[a-zA-Z]+://([^/?#]*)", 1)), "^.*@", "")
    host = F.when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(F.regexp_replace(host, ":80$", ""))
    path = F.regexp_extract(x, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    query = F.filter(F.split(F.regexp_extract(x, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)"))
    out = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(F.contains(host, F.lit(".")), out)


def valid_phone(phone: Column) -> Column:
    """Seven to sixteen digits."""
    return F.length(F.regexp_replace(F.coalesce(phone, F.lit("")), "[^0-9]", "")).between(7, 16)


def first_alias(fields: Column, names) -> Column:
    """The value of the first alias present in a map with lower-case keys; a present null counts."""
    out = F.lit(None).cast("string")
    for name in reversed(list(names)):
        out = F.when(F.map_contains_key(fields, name.lower()), fields[name.lower()]).otherwise(out)
    return out


def lower_keys(fields: Column) -> Column:
    """A map with its keys in lower case; of equal keys the last one stays."""
    entries = F.transform(F.map_entries(fields), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(later)

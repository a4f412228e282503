"""Facts from web pages and scraped notes."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from placeforge.operators.rules import price_band

# fixed values: words that hint at styles and fillings
STYLE_HINTS = ("detroit", "new york", "chicago", "neapolitan", "sicilian", "tavern", "deep dish", "thin crust", "wood fired", "brick oven")
PROTEIN_HINTS = ("al pastor", "carne asada", "carnitas", "birria", "chorizo", "pollo", "barbacoa", "lengua", "cabeza", "fish", "shrimp")
MENU_KEYS = ("menu", "menu_url", "hasMenu")
EXCERPT = 6000
ITEMS = 100
SCHEMA = "page_id long, body string, tel string, menu_url string, jsonld array<string>"
PARSED = pa.schema([("page_id", pa.int64()), ("body", pa.string()), ("tel", pa.string()), ("menu_url", pa.string()), ("jsonld", pa.list_(pa.string()))])
SLICE = 64  # pages


class _Page(HTMLParser):
    def __init__(self, url: str):
        super().__init__(convert_charrefs=True)
        self.url, self.body, self.tel, self.menu, self.jsonld = url, [], None, None, []
        self._script, self._link, self._words = None, None, []

    def handle_starttag(self, tag, attrs):
        have = dict(attrs)
        if tag in ("script", "style"):
            self._script = (have.get("type") or "") if tag == "script" else "style"
        if tag == "a":
            self._link, self._words = have.get("href") or "", []
            if self._link.startswith("tel:") and self.tel is None:
                self.tel = self._link[4:]

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._script = None
        if tag == "a" and self._link is not None:
            if "menu" in "".join(self._words).lower() and self.menu is None:
                try:
                    self.menu = self._link if self._link.startswith("http") else urljoin(self.url, self._link)
                except ValueError:
                    self.menu = None
            self._link = None

    def handle_data(self, data):
        if self._script is not None:
            if self._script == "application/ld+json":
                try:
                    json.loads(data)
                    self.jsonld.append(data.strip())
                except ValueError:
                    pass
            return
        self.body.append(data)
        if self._link is not None:
            self._words.append(data)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Text, telephone link, menu link and the first three structured-data blocks of each page. HTML needs a parser, so Arrow.

    Pages are parsed and given back `SLICE` at a time, so that a task holds few of them as objects, whatever Spark puts in a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = []
                for row in batch.slice(at, SLICE).to_pylist():
                    page = _Page(row["url"] or "")
                    page.feed(row["html"] or "")
                    page.close()
                    rows.append({"page_id": row["page_id"], "body": "".join(page.body), "tel": page.tel, "menu_url": page.menu, "jsonld": page.jsonld[:3]})
                yield pa.RecordBatch.from_pylist(rows, PARSED)

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)


def page_facts(pages: DataFrame) -> DataFrame:
    """Phone, hours hint, excerpt, price hint, menu link, style and protein hints; all but the parsing is native."""
    rows = parsed_pages(pages)
    body = F.col("body")
    phone = F.regexp_replace(F.regexp_extract(body, r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", 0), r"[^\d+]", "")
    tel = F.regexp_replace(F.col("tel"), r"[^\d+]", "")
    times = F.regexp_extract_all(body, F.lit(r"(?i)\d{1,2}(?::\d{2})?\s*(?:am|pm)"), F.lit(0))
    hours = F.lower(body).rlike("hours|schedule|open|close") & (F.size(times) >= 2)
    excerpt = F.substring(F.trim(F.regexp_replace(body, r"\s+", " ")), 1, EXCERPT)
    return rows.select(
        "page_id", F.when(phone != "", phone).otherwise(tel).alias("phone"), hours.alias("has_hours"), excerpt.alias("excerpt"), price_band(mean_price(body)).alias("price_hint"), "menu_url",
        hints(body, STYLE_HINTS).alias("style_hints"), hints(body, PROTEIN_HINTS).alias("protein_hints"), F.size("jsonld").alias("n_jsonld"), "jsonld",
    )


def mean_price(text: Column) -> Column:
    """Mean of the dollar amounts between 0 and 100."""
    found = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"\$(\d+(?:\.\d{2})?)"), F.lit(1)), lambda p: p.cast("double")), lambda p: (p > 0) & (p < 100))
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0.0), lambda a, b: a + b) / F.size(found))


def hints(text: Column, terms) -> Column:
    low = F.lower(text)
    return F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), t) for t in terms)))


def _clean(value) -> str | None:
    text = " ".join(str(value if value is not None else "").split())
    return text or None


def _many(value) -> list:
    return value if isinstance(value, list) else [value] if value else []


def menu_of(notes: str | None, website: str | None) -> dict | None:
    """E10 for one row of scraped notes: menu urls and items named in structured data, never guessed from free text."""
    try:
        found = json.loads(notes) if notes else {}
    except ValueError:
        found = {}
    found = found if isinstance(found, dict) else {}
    entries = []
    for entry in _many(found.get("jsonld")):
        if isinstance(entry, dict):
            graph = entry.get("@graph")
            entries += [x for x in graph if isinstance(x, dict)] if isinstance(graph, list) else [entry]
    base, urls = website or found.get("website_url"), []
    for holder in [found, *entries]:
        for key in MENU_KEYS:
            for value in _many(holder.get(key)):
                link = _clean(value.get("url") or value.get("@id") if isinstance(value, dict) else value)
                if link and (base or link.lower().startswith("http")):
                    link = urljoin(base or "", link)
                    if link not in urls:
                        urls.append(link)
    items, seen = [], set()
    for entry in entries:
        menu = entry.get("hasMenu") if isinstance(entry.get("hasMenu"), dict) else {}
        listed = _many(entry.get("hasMenuItem")) + _many(menu.get("hasMenuItem"))
        for section in _many(menu.get("hasMenuSection")):
            listed += _many(section.get("hasMenuItem")) if isinstance(section, dict) else []
        for item in listed:
            name = _clean(item.get("name")) if isinstance(item, dict) else None
            if name:
                spec = item.get("priceSpecification")
                price = _clean(item.get("price") or (spec.get("price") if isinstance(spec, dict) else None))
                if (name.lower(), price) not in seen:
                    seen.add((name.lower(), price))
                    items.append({"name": name, "price": price})
    if not items and not urls:
        return None
    return {"menu_urls": urls, "items": items[:ITEMS], "confidence": "high" if items else "medium"}


@F.pandas_udf(StringType())
def menu_json(notes: pd.Series, website: pd.Series) -> pd.Series:
    """E10 over a column of notes; the result as JSON, null without any sign of a menu."""
    out = [menu_of(n, w) for n, w in zip(notes, website, strict=True)]
    return pd.Series([None if x is None else json.dumps(x, sort_keys=True) for x in out])

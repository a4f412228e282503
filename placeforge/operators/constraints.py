"""Versioned row contracts as tables of constraints, compiled into one expression that lists violations with their paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One field: kind text, number, whole, date or list (of texts); most: bytes of a text or an item; items: of a list."""

    path: str
    kind: str = "text"
    required: bool = False
    least: float | None = None
    most: float | None = None
    items: int | None = None
    values: tuple[str, ...] = ()
    form: str | None = None
    never: tuple[str, ...] = ()


# fixed values: the release row of a place feed
RELEASE_V1 = (
    Rule("fsq_place_id", required=True, most=256), Rule("name", required=True, most=1024), Rule("latitude", "number", True, -90, 90), Rule("longitude", "number", True, -180, 180),
    Rule("address", most=2048), Rule("locality", most=512), Rule("region", most=256), Rule("postcode", most=64), Rule("country", most=128), Rule("tel", most=128), Rule("website", most=2048),
    Rule("fsq_category_ids", "list", True, most=128, items=128), Rule("fsq_category_labels", "list", True, most=512, items=128), Rule("date_closed", "date"),
    Rule("unresolved_flags", "list", True, most=256, items=128, never=("delete", "doesntexist", "inappropriate", "privatevenue")),
)
# fixed values: what a mapped permit may hold
PERMIT_V1 = (
    Rule("object_id", "whole", True, 0), Rule("record_id", required=True, most=256), Rule("address", required=True, most=2048), Rule("permit_type", most=128),
    Rule("use_group", values=("B", "M", "R-2", "F-1")), Rule("cost", form=r"^-?[0-9]+(\.[0-9]+)?$"), Rule("num_units", form=r"^[0-9]+$"), Rule("latitude", "number", False, -90, 90),
)


def _text_problem(rule: Rule, c: Column) -> Column:
    out = F.when(F.trim(c) == "", "blank").when(F.trim(c) != c, "untrimmed")
    if rule.most is not None:
        out = out.when(F.octet_length(c) > int(rule.most), "too_long")
    if rule.values:
        out = out.when(~c.isin(*rule.values), "not_allowed")
    if rule.form:
        out = out.when(~c.rlike(rule.form), "malformed")
    if rule.never:
        out = out.when(F.regexp_replace(F.lower(c), "[^a-z]+", "").isin(*rule.never), "forbidden")
    return out


def _problem(rule: Rule, c: Column) -> Column:
    """The first thing that is wrong with a value that is there."""
    if rule.kind == "text":
        return _text_problem(rule, c)
    if rule.kind == "date":
        day = c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(c).isNotNull()
        instant = c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$") & F.try_to_timestamp(c).isNotNull()
        return F.when(~(day | instant), "malformed")
    out = F.when(F.isnan(c) | (F.abs(c) == float("inf")), "not_finite") if rule.kind == "number" else F.when(F.lit(False), "")
    if rule.least is not None:
        out = out.when(c < rule.least, "out_of_range")
    return out.when(c > rule.most, "out_of_range") if rule.most is not None else out


def _found(path: Column, problem: Column) -> Column:
    return F.struct(path.alias("path"), problem.alias("problem"))


def _item(rule: Rule):
    """The violation of the item x at place i of a list, or null."""

    def judge(x: Column, i: Column) -> Column:
        problem = F.when(x.isNull(), "missing").otherwise(_text_problem(rule, x))
        return F.when(problem.isNotNull(), _found(F.concat(F.lit(f"{rule.path}["), i.cast("string"), F.lit("]")), problem))

    return judge


def violations(contract: tuple[Rule, ...]) -> Column:
    """V2: the row's violations as an array of (path, problem), in the order of the contract; items have their place in the path."""
    parts = []
    for rule in contract:
        c, path = F.col(rule.path), F.lit(rule.path)
        missing = F.when(c.isNull(), "missing" if rule.required else None)
        if rule.kind != "list":
            problem = F.when(c.isNull(), missing).otherwise(_problem(rule, c))
            parts.append(F.array(F.when(problem.isNotNull(), _found(path, problem))))
            continue
        many = F.when(c.isNull(), missing).when(F.size(c) > (rule.items or 1 << 30), "too_many")
        parts.append(F.array(F.when(many.isNotNull(), _found(path, many))))
        parts.append(F.when(c.isNotNull(), F.transform(c, _item(rule))).otherwise(F.array()))
    return F.array_compact(F.concat(*parts))


def violation_rows(rows: DataFrame, key: str, contract: tuple[Rule, ...]) -> DataFrame:
    """V2: key, path, problem: one row for each violation."""
    return rows.select(F.col(key), F.explode(violations(contract)).alias("v")).select(key, "v.path", "v.problem")


def closed_keys(rows: DataFrame, contract: tuple[Rule, ...]) -> DataFrame:
    """Exactly the contract's columns in their order: texts trimmed, blank ones null, missing lists empty; other columns end here."""
    have = dict(rows.dtypes)
    kinds = {"text": "string", "date": "string", "number": "double", "whole": "long", "list": "array<string>"}

    def value(rule: Rule) -> Column:
        c = F.col(f"`{rule.path}`") if rule.path in have else F.lit(None).cast(kinds[rule.kind])
        if rule.kind == "list":
            return F.coalesce(c, F.expr("cast(array() as array<string>)"))
        if rule.path not in have:
            return c
        return F.nullif(F.trim(c), F.lit("")) if have[rule.path] == "string" else c

    return rows.select(*(value(r).alias(r.path) for r in contract))

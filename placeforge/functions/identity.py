"""Canonical JSON and the keys that are made from it."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value) -> str:
    """Compact JSON with keys in UTF-16 order; non-finite numbers are refused, whole doubles lose their fraction."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(x[k]) for k in sorted(x, key=lambda s: s.encode("utf-16-be"))}
        if isinstance(x, list | tuple):
            return [plain(y) for y in x]
        if isinstance(x, float) and x.is_integer() and abs(x) < 1e21:
            return int(x)
        return x

    return json.dumps(plain(value), ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def digest(value) -> str:
    return "sha256:" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def json_text(x: Column) -> Column:
    """A JSON string (or null) of a text column, escaped as compact JSON."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r'^\{"v":(.*)\}$', 1), F.lit("null"))


def object_digest(**fields: Column) -> Column:
    """sha256 hex of the canonical JSON object of JSON-text columns; keys are sorted."""
    parts = [x for k, key in enumerate(sorted(fields)) for x in (F.lit(("," if k else "{") + json.dumps(key) + ":"), fields[key])]
    return F.sha2(F.concat(*parts, F.lit("}")), 256)


def source_record_key(profile: str, namespace: str, external_id: Column) -> Column:
    """srk_ and the digest of profile, namespace and external id."""
    return F.concat(F.lit("srk_"), object_digest(profile=F.lit(json.dumps(profile)), sourceNamespace=F.lit(json.dumps(namespace)), externalId=json_text(external_id)))


def observation_id(record_key: Column, payload_json: Column) -> Column:
    """obs_ and the digest of record key, no revision, and the raw row's canonical JSON."""
    return F.concat(F.lit("obs_"), object_digest(sourceRecordKey=json_text(record_key), sourceRevision=F.lit("null"), payload=payload_json))

"""Pipeline definitions: validation, effect grants, admission, and a runner over DataFrames."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

PREVIEW_EFFECTS = ("artifact.write", "source.read", "state.write")


@dataclass
class Stage:
    """A stage: inputs name `stage.port` of earlier stages; run(spark, inputs) gives a frame for each output port."""

    id: str
    run: Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]
    inputs: dict[str, str] = field(default_factory=dict)
    outputs: tuple[str, ...] = ("out",)
    effects: tuple[str, ...] = ()
    sink: bool = False


def issues(stages: list[Stage]) -> list[str]:
    """V1: what is wrong with a definition; empty if it can run."""
    out, seen = [], {}
    used = {ref.split(".")[0] for s in stages for ref in s.inputs.values()}
    for s in stages:
        if not s.id or s.id in seen:
            out.append(f"duplicate or empty stage id: {s.id!r}")
        for port, ref in s.inputs.items():
            source, _, name = ref.partition(".")
            if source not in seen:
                out.append(f"{s.id}.{port} refers to no earlier stage: {ref}")
            elif name not in seen[source].outputs:
                out.append(f"{s.id}.{port} refers to no output: {ref}")
        if s.sink and s.id in used:
            out.append(f"sink {s.id} is not terminal")
        seen.setdefault(s.id, s)
    if not any(s.sink for s in stages):
        out.append("no sink")
    return out


def run(spark: SparkSession, stages: list[Stage], events: list | None = None) -> dict[tuple[str, str], DataFrame]:
    """V7: runs a valid definition in order; frames stay lazy until a sink or the caller asks. Fails at the first error."""
    if found := issues(stages):
        raise ValueError("; ".join(found))
    made: dict[tuple[str, str], DataFrame] = {}
    for s in stages:
        got = s.run(spark, {port: made[tuple(ref.split(".", 1))] for port, ref in s.inputs.items()})
        if set(got) != set(s.outputs):
            raise ValueError(f"{s.id} gave {sorted(got)}, declared {sorted(s.outputs)}")
        made |= {(s.id, port): frame for port, frame in got.items()}
        if events is not None:
            events.append(s.id)
    return made


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """V8: equal as multisets of rows."""
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


class EffectDenied(Exception):
    pass


def authorize(mode: str, request: dict, declared: tuple[str, ...], grants: list[dict]) -> None:
    """V3: raises unless a stage may have the effect: declared, allowed in the mode, granted, and within its record limit."""
    n = request["records"]
    if not isinstance(n, int) or isinstance(n, bool) or n < 0:
        raise EffectDenied("record count must be a non-negative integer")
    uri = urlsplit(request["uri"])
    if not uri.scheme or uri.username or uri.password or uri.query or uri.fragment:
        raise EffectDenied("resource URI is not canonical")
    if request["effect"] not in declared:
        raise EffectDenied(f"{request['effect']} is not declared")
    if mode in ("validate", "plan"):
        raise EffectDenied(f"{mode} mode has no effects")
    if mode == "preview" and (request["effect"] not in PREVIEW_EFFECTS or request["effect"] == "artifact.write" and uri.scheme != "preview"):
        raise EffectDenied("not allowed in preview")
    keys = ("effect", "stage", "uri")
    grant = next((g for g in grants if all(g[k] == request[k] for k in keys) and request["operation"] in g["operations"]), None)
    if grant is None:
        raise EffectDenied("no grant")
    if n > grant["max_records"]:
        raise EffectDenied("more records than granted")
    if request["effect"] == "public.write" and grant.get("verification") != "post_read":
        raise EffectDenied("public writes need a check after the write")


def admit(free: dict[str, int], wanted: dict[str, int], least_free: dict[str, int] | None = None) -> tuple[bool, list[str]]:
    """V4: whether a reservation fits the free resources with their reserves, and what stands against it."""
    reserve = least_free or {}
    short = [k for k, v in sorted(wanted.items()) if v < 0 or free.get(k, 0) - v < reserve.get(k, 0)]
    return not short, short


def strict_json(text: str):
    """JSON without repeated keys."""

    def pairs(items):
        keys = [k for k, _ in items]
        if len(set(keys)) != len(keys):
            raise ValueError("repeated key")
        return dict(items)

    return json.loads(text, object_pairs_hook=pairs)

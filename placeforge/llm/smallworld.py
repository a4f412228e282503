"""Embedding near-dedup: a navigable small-world graph per shard, audited beams, exact cosines, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, FloatType, ShortType

from placeforge.llm.components import components
from placeforge.llm.runtime import cut
from placeforge.llm.textkit import mix

SHARD = 4096
BLOCK = 1024
DEGREE = 16
BEAM = 64
AUDIT = 24
RECALL = 0.995
NEAREST = 0.9
BESIDE = 32  # blocks that one task takes past a shard


class Graph:
    """Layered neighbour lists over unit vectors; layer 0 holds all, each next one about 1/DEGREE of the last."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.x = x
        self.layers = layers if layers is not None else []

    def build(self, ids: np.ndarray) -> Graph:
        u = (mix(ids.astype(np.uint64) + np.uint64(11)) >> np.uint64(11)).astype(float) / 2.0**53
        level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(DEGREE)).astype(int), 6)
        for k in range(int(level.max(initial=0)), -1, -1):
            own = np.flatnonzero(level >= k)
            if len(own) >= 2 or k == 0:
                self.layers.append((own, np.full((len(own), 2 * DEGREE), -1, np.int32)))
                self._fill()
        return self

    def _fill(self) -> None:
        """Insert the newest layer's members in growing batches, each searching what stands already."""
        own, links = self.layers[-1]
        x = self.x[own]
        used = np.zeros(len(own), np.int64)
        done = 1
        while done < len(own):
            batch = np.arange(done, min(len(own), done + min(done, 256)))
            found, sims = _beam(x, links, x[batch], np.zeros((len(batch), 1), np.int64), BEAM, done)
            inner = x[batch] @ x[batch].T
            inner[np.arange(len(batch))[:, None] <= np.arange(len(batch))] = -2  # only earlier ones
            near = np.argsort(-inner, axis=1)[:, :DEGREE]
            found = np.concatenate([found, batch[near]], 1)
            sims = np.concatenate([sims, np.take_along_axis(inner, near, 1)], 1)
            for i, node in enumerate(batch):
                chosen = self._spread(x, found[i], sims[i], DEGREE)
                links[node, : len(chosen)] = chosen
                used[node] = len(chosen)
                for c in chosen:
                    if used[c] < links.shape[1]:
                        links[c, used[c]] = node
                        used[c] += 1
                    else:
                        pool = np.append(links[c], node)
                        kept = self._spread(x, pool, x[pool] @ x[c], links.shape[1])
                        links[c] = -1
                        links[c, : len(kept)] = kept
                        used[c] = len(kept)
            done = int(batch[-1]) + 1

    @staticmethod
    def _spread(x: np.ndarray, pool: np.ndarray, sims: np.ndarray, most: int) -> list[int]:
        """Nearest first, leaving out what is nearer to a chosen one than to the node; free places are filled."""
        order = np.argsort(-sims, kind="stable")
        order = order[(pool[order] >= 0) & (sims[order] > -2)][: 3 * most]
        if not len(order):
            return []
        rows = pool[order]
        among = x[rows] @ x[rows].T
        chosen: list[int] = []
        for i in range(len(rows)):
            if len(chosen) == most:
                break
            if not chosen or among[i, chosen].max() < sims[order[i]]:
                chosen.append(i)
        for i in range(len(rows)):
            if len(chosen) == most:
                break
            if i not in chosen:
                chosen.append(i)
        return rows[chosen].tolist()

    def search(self, q: np.ndarray, beam: int, near: float) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """For each query the members met with a similarity of `near` or more, whether its beam was full of them, and its best member."""
        entry = np.zeros((len(q), 1), np.int64)
        for own, links in self.layers[:-1]:
            at, _ = _beam(self.x[own], links, q, entry, 4, len(own))
            ids = own[np.maximum(at[:, :1], 0)]
            following = self.layers[[o is own for o, _ in self.layers].index(True) + 1][0]
            entry = np.searchsorted(following, ids)
        _, links = self.layers[-1]
        met: list[tuple[np.ndarray, np.ndarray]] = []
        best, sims = _beam(self.x, links, q, entry, beam, len(self.x), near, met)
        rows = np.concatenate([m[0] for m in met]) if met else np.zeros(0, np.int64)
        cols = np.concatenate([m[1] for m in met]) if met else np.zeros(0, np.int64)
        order = np.argsort(rows, kind="stable")
        cols = cols[order]
        cuts = np.searchsorted(rows[order], np.arange(len(q) + 1))
        return [cols[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], sims[:, -1] >= near, best[:, 0]


def _beam(x, links, q, entry, beam: int, n: int, near: float = 2.0, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in lockstep; ids and similarities, best first, padded with -1 and -2."""
    beam = min(beam, n)
    rows = np.arange(len(q))
    seen = np.zeros((len(q), n), bool)
    ids = np.full((len(q), beam), -1, np.int64)
    sims = np.full((len(q), beam), -2.0, np.float32)
    ids[:, 0] = entry[:, 0]
    sims[:, 0] = np.einsum("ij,ij->i", x[entry[:, 0]], q)
    seen[rows, entry[:, 0]] = True
    fresh = ids >= 0
    if met is not None and (hit := np.flatnonzero(sims[:, 0] >= near)).size:
        met.append((hit, ids[hit, 0]))
    step = 4
    while True:
        ready = np.where(fresh, sims, -3.0)
        pick = np.argsort(-ready, axis=1)[:, :step] if beam > step else np.tile(np.arange(beam), (len(q), 1))
        live = np.take_along_axis(ready, pick, 1) > -2
        act = np.flatnonzero(live.any(1))
        if not len(act):
            return ids, sims
        nodes = np.where(live[act], np.take_along_axis(ids, pick, 1)[act], 0)
        np.put_along_axis(fresh, pick, False, 1)
        nbrs = np.where(live[act][:, :, None], links[nodes], -1).reshape(len(act), -1).astype(np.int64)
        nbrs[nbrs >= n] = -1
        nbrs.sort(axis=1)
        nbrs[:, 1:][nbrs[:, 1:] == nbrs[:, :-1]] = -1
        ok = (nbrs >= 0) & ~seen[act[:, None], np.maximum(nbrs, 0)]
        r, c = np.nonzero(ok)
        if not len(r):
            continue
        to = nbrs[r, c]
        seen[act[r], to] = True
        s = np.einsum("ij,ij->i", x[to], q[act[r]])
        if met is not None and (hit := s >= near).any():
            met.append((act[r[hit]], to[hit]))
        new_sims = np.full(nbrs.shape, -2.0, np.float32)
        new_sims[r, c] = s
        all_ids = np.concatenate([ids[act], nbrs], 1)
        all_sims = np.concatenate([sims[act], new_sims], 1)
        all_fresh = np.concatenate([fresh[act], ok], 1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[act] = np.take_along_axis(all_ids, top, 1)
        sims[act] = np.take_along_axis(all_sims, top, 1)
        fresh[act] = np.take_along_axis(all_fresh, top, 1) & (sims[act] > -2)


def _unit(v: np.ndarray) -> np.ndarray:
    return (v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)).astype(np.float32)


def linked(graph: Graph, members: np.ndarray, q: np.ndarray, cosine: float) -> list[np.ndarray]:
    """For each query row the members with a double-precision cosine of at least `cosine`.

    The beam doubles while a sample of queries, compared with all members,
    shows a recall of links under RECALL, or misses its nearest member, link or
    not, more often than NEAREST allows (so that every audit has something to
    miss), and for every query whose beam ends full of links; a beam as wide as
    the shard is exhaustive.
    """
    unit = _unit(q)
    near = cosine - 1e-4
    beam = min(BEAM, len(members))
    sample = np.unique(np.linspace(0, len(q) - 1, AUDIT).astype(int))
    cosines = unit[sample] @ graph.x.T
    truth = [np.flatnonzero(row) for row in cosines >= near]
    want, top = sum(map(len, truth)), cosines.max(1)
    while True:
        found, _, best = graph.search(unit[sample], beam, near)
        got = sum(len(np.intersect1d(a, b)) for a, b in zip(found, truth, strict=True))
        nearest = cosines[np.arange(len(sample)), best] >= top - 1e-6
        if (got >= RECALL * want and nearest.mean() >= NEAREST) or beam >= len(members):
            break
        beam = min(2 * beam, len(members))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
    todo = np.arange(len(q))
    while len(todo):
        again = []
        for part in np.array_split(todo, max(1, len(todo) // 256)):
            found, full, _ = graph.search(unit[part], beam, near)
            for i, f in zip(part, found, strict=True):
                out[i] = f
            again.append(part[full])
        todo = np.concatenate(again) if beam < len(members) else np.zeros(0, np.int64)
        beam = min(4 * beam, len(members))
    exact_members, exact_q = members.astype(float), q.astype(float)
    norm = np.linalg.norm(exact_members, axis=1)
    for i, f in enumerate(out):
        if len(f):
            f = np.unique(f)
            cos = exact_members[f] @ exact_q[i] / (norm[f] * np.linalg.norm(exact_q[i]))
            out[i] = f[cos >= cosine]
    return out


def _pack(pdf: pd.DataFrame, kind: type) -> np.ndarray:
    return np.array(pdf["embedding"].tolist(), kind)


def near_vectors(vectors: DataFrame, cosine: float = 0.93, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id), one row for each row of `vectors`.

    Vectors meet only within equal, non-null labels (and equal lengths). Null,
    zero and empty vectors and those with null or non-finite components link
    with nothing. Equal vectors of a label are one class and count as links of
    each other; a repeated vec_id with the same vector is one vector. A null
    vec_id links with nothing and has a null component. A label's classes are
    dealt into shards of about `shard`; every block of classes queries every
    shard of its label, so no group is held whole by one task. A cosine of just
    `cosine` links; ties of components go to the smallest id; repeated rows are
    answered each; very long vectors are held whole by their shard; an empty
    table gives an empty one; other columns, whatever their names, are not read.
    """
    v = F.col("embedding")
    # graphs hold single precision; links are judged on the components as they are given
    element = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    kind, held = (np.float32, "float") if isinstance(element, FloatType | ByteType | ShortType) else (np.float64, "double")
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.cast(f"array<{held}>").alias("embedding"), good.alias("good"))
    rows = rows.select("*", F.when(F.col("good"), F.struct(F.xxhash64("label", "embedding").alias("a"), F.xxhash64(F.lit(7), "embedding", "label").alias("b"))).alias("key"))
    classes = rows.where("good").select("key", "vec_id", "label", "embedding").dropDuplicates(["key", "vec_id"])
    classes = classes.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = cut(classes.withColumn("dim", F.size("embedding")))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    dealt = classes.join(sizes, ["label", "dim"])
    part = lambda size, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.ceil(F.col("n") / size).cast("long"))
    dealt = dealt.select("rep", "w", "label", "dim", "embedding", part(shard, 1).alias("shard"), part(block, 2).alias("block"))
    label = dict(classes.dtypes)["label"]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        x = _pack(pdf, kind)
        graph = Graph(_unit(x)).build(pdf["rep"].to_numpy())
        sizes = [len(own) for own, _ in graph.layers]
        nodes = b"".join(own.astype(np.int32).tobytes() for own, _ in graph.layers)
        links = b"".join(ln.tobytes() for _, ln in graph.layers)
        one = pdf.iloc[0]
        return pd.DataFrame({"label": [one["label"]], "dim": [one["dim"]], "shard": [one["shard"]], "ids": [pdf["rep"].to_numpy(np.int64).tobytes()], "ws": [pdf["w"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()], "sizes": [sizes], "nodes": [nodes], "links": [links]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        return pd.DataFrame({"label": [one["label"]], "dim": [one["dim"]], "block": [one["block"]], "q_ids": [pdf["rep"].to_numpy(np.int64).tobytes()], "q": [_pack(pdf, kind).tobytes()]})

    shards = cut(dealt.groupBy("label", "dim", "shard").applyInPandas(build, f"label {label}, dim int, shard long, ids binary, ws binary, x binary, sizes array<int>, nodes binary, links binary"))
    blocks = dealt.groupBy("label", "dim", "block").applyInPandas(pack, f"label {label}, dim int, block long, q_ids binary, q binary")
    # a block goes to every shard of its label; a shard stands once for every BESIDE blocks, so that no task takes all of a label
    parts = sizes.select("label", "dim", F.ceil(F.col("n") / shard).cast("long").alias("shards"), F.ceil(F.ceil(F.col("n") / block) / BESIDE).cast("long").alias("lots"))
    key = ["label", "dim", "shard", "lot"]
    tasks = max(2, 2 * classes.sparkSession.sparkContext.defaultParallelism)
    there = shards.join(parts, ["label", "dim"]).withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))).drop("shards", "lots")
    asked = blocks.join(parts, ["label", "dim"]).withColumn("lot", F.pmod("block", F.col("lots"))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).drop("shards", "lots", "block")
    pairs = asked.repartition(tasks, *key).join(there.repartition(tasks, *key), key)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ids, ws = np.frombuffer(r.ids, np.int64), np.frombuffer(r.ws, np.int64)
                x = np.frombuffer(r.x, kind).reshape(-1, r.dim)
                at, layers = 0, []
                for size in r.sizes:
                    own = np.frombuffer(r.nodes, np.int32)[at : at + size].astype(np.int64)
                    ln = np.frombuffer(r.links, np.int32)[at * 2 * DEGREE : (at + size) * 2 * DEGREE].reshape(size, 2 * DEGREE)
                    layers.append((own, ln))
                    at += size
                q_ids, q = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q, kind).reshape(-1, r.dim)
                found = linked(Graph(_unit(x), layers), x, q, cosine)
                parent: dict[int, int] = {}

                def root(k: int, parent: dict[int, int] = parent) -> int:
                    while parent.setdefault(k, k) != k:
                        parent[k] = k = parent[parent[k]]
                    return k

                a, b, n = [], [], []
                for i, f in enumerate(found):
                    own = int(q_ids[i])
                    others = f[ids[f] != own]
                    a.append(own)
                    b.append(None)
                    n.append(int(ws[others].sum()))
                    for o in ids[others].tolist():  # links that close a circle within this task add nothing
                        ra, rb = root(own), root(o)
                        if ra != rb:
                            parent[max(ra, rb)] = min(ra, rb)
                            a.append(own)
                            b.append(o)
                            n.append(0)
                yield pd.DataFrame({"a": a, "b": pd.array(b, "Int64"), "n": n})

    results = cut(pairs.mapInPandas(search, "a long, b long, n long"))
    links = results.groupBy("a").agg(F.sum("n").alias("n"))
    comps = components(results.where("b is not null").select("a", "b"))
    by_class = classes.select("key", "rep", "w").join(links, F.col("rep") == F.col("a"), "left").join(comps, F.col("rep") == F.col("id"), "left")
    by_class = by_class.select("key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", "key").join(by_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))

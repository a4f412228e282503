"""MinHash near-dedup as a chosen-path set similarity join."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.components import PAIR, components, stars
from placeforge.llm.runtime import cut
from placeforge.llm.textkit import LOWER, batch_of, mix, per_text, runs, text_chunks, word_hashes, words

SIGNATURE = 64
RECALL = 0.9999  # of the trees together, for a pair at the threshold
LEAF = 1024
DEPTH = 6
BRANCHES = 2  # over 1 / threshold, so that the recall of a tree doesn't fall with its depth
MAYBE = 0.6  # share of equal minhashes below which a link of 0.8 is 4 standard errors away
UNIT = 4096  # sets that one task compares whole
UNIT_VALUES = 1 << 20  # and their shingles
RARE = 12  # shingles of so few sets are counted pair by pair


def tree_recall(threshold: float, branches: int = BRANCHES) -> float:
    """The share of pairs at `threshold` that meet in one tree, however deep it is.

    A pair shares the first token with that chance; below, it survives where
    either branch keeps it: s = 1 - (1 - threshold * s) ** branches.
    """
    s = 1.0
    for _ in range(200):
        s = 1 - (1 - threshold * s) ** branches
    return threshold * s


def trees_for(threshold: float, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - tree_recall(threshold)))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return seeds[:n] | np.uint64(1), seeds[n:]


def shingle_set(text: str | None, size: int) -> set:
    """Distinct word shingles of a text; fewer words than `size` count as one shingle, no words as none."""
    found = (text or "").encode().translate(bytes(LOWER)).split()
    if len(found) < size:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(size)), strict=False))


def _shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingles of all texts, and each text's bounds in them."""
    raw = LOWER[raw]
    starts, ends, first = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    n = np.diff(first)
    has = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    bounds = np.concatenate([[0], np.cumsum(has)])
    out = np.zeros(bounds[-1], np.uint64)
    whole = np.repeat(n >= size, has)
    at = np.repeat(first[:-1] - bounds[:-1], has) + np.arange(bounds[-1])
    acc = np.full(int(whole.sum()), size, np.uint64)
    for k in range(size):
        acc = mix(acc * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at[whole] + k])
    out[whole] = acc
    for i in np.flatnonzero((n > 0) & (n < size)):
        value = np.full(1, n[i], np.uint64)
        for h in hashes[first[i] : first[i + 1]]:
            value = mix(value * np.uint64(0x94D049BB133111EB) + h)
        out[bounds[i]] = value[0]
    return out, bounds


def signatures(docs: DataFrame, size: int, trees: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (equal for equal shingle sets; null if empty), first tokens and the signature, by row.

    The first tokens are whole minhashes; the signature has one byte of each.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("roots", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _coefficients(SIGNATURE)
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(2)):
                values, bounds = _shingles(raw, offsets, size)
                sig = np.empty((b - a, SIGNATURE), np.uint32)
                for j in range(SIGNATURE):
                    sig[:, j] = per_text(((values * mul[j] + add[j]) >> np.uint64(32)).astype(np.uint32), bounds, np.minimum, 0)
                counts, keys = [], []
                for i in range(b - a):
                    own = np.unique(values[bounds[i] : bounds[i + 1]])
                    counts.append(len(own))
                    keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                yield batch_of(schema, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), counts, keys, [s[:trees].tobytes() for s in sig], [s.tobytes() for s in (sig & 0xFF).astype(np.uint8)])

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_key binary, roots binary, sig binary")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (rows of one id with unlike texts stay apart) and text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def alike(unit: np.ndarray, label: np.ndarray, sig: np.ndarray, maybe: float) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the labels whose members have signatures that agree in a share of `maybe`, within equal units (sorted)."""
    end = np.searchsorted(unit, unit, "right")
    need = maybe * sig.shape[1]
    a, b = [], []
    at, step = np.arange(len(unit)), 1
    while (at := at[at + step < end[at]]).size:
        far = at[label[at] != label[at + step]]
        far = far[(sig[far] == sig[far + step]).sum(1) >= need]
        a.append(label[far])
        b.append(label[far + step])
        step += 1
    if not a:
        return (np.zeros(0, np.int64),) * 2
    return stars(np.concatenate(a), np.concatenate(b))


def _candidates(rows: DataFrame, maybe: float) -> DataFrame:
    """(a, b): stars over what may be alike within each unit; rows: unit, label, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 0):
            if table.num_rows:
                a, b = alike(table["unit"].to_numpy(), table["label"].to_numpy(), _matrix(table["sig"]), maybe)
                yield batch_of(PAIR, a, b)

    return rows.select("unit", "label", "sig").repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def _sized(rows: DataFrame) -> DataFrame:
    """The rows with n, the members of their node, where there are more than one."""
    sizes = cut(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"))  # written first, so that the join of a crowded node can be split
    return cut(rows.join(sizes, "node"))


def _opened(rows: DataFrame, label: DataFrame) -> DataFrame:
    """The rows with label, `main` (the node's commonest label) and `open` (members outside it), of nodes that are not all one label."""
    rows = rows.join(label.select(F.col("id").alias("rep"), F.col("component").alias("label")), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    sizes = rows.groupBy("node", "label").agg(F.count("*").alias("k")).groupBy("node").agg(F.sum("k").alias("all"), F.max(F.struct("k", "label")).alias("m"))
    sizes = cut(sizes.select("node", (F.col("all") - F.col("m.k")).alias("open"), F.col("m.label").alias("main")).where("open > 0"))
    return cut(rows.join(sizes, "node"))


def _dealt(rows: DataFrame, group: str, parts: Column, open_parts: Column, is_open: Column) -> DataFrame:
    """Rows in units of `group` in which every open member meets every member: blocks of all members by blocks of open ones."""
    own = F.pmod(F.xxhash64("rep", F.lit(9)), parts).cast("int")
    open_own = F.pmod(F.xxhash64("rep", F.lit(10)), open_parts).cast("int")
    spot = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    wide = F.transform(F.sequence(F.lit(0), open_parts.cast("int") - 1), lambda j: spot(own, j))
    tall = F.transform(F.sequence(F.lit(0), parts.cast("int") - 1), lambda i: spot(i, open_own))
    to = F.when(is_open, F.array_union(wide, tall)).otherwise(wide)
    spread = rows.withColumn("to", F.explode(to))
    return spread.withColumn("unit", F.xxhash64(group, "to.i", "to.j")).drop("to")


def candidate_groups(reps: DataFrame, roots: DataFrame, leaf: int = LEAF, depth: int = DEPTH, maybe: float = MAYBE) -> DataFrame:
    """(id, component): groups that hold every pair of `reps` (rep, sig) that meets in a tree and may be alike by signature.

    The trees' first nodes are `roots` (rep, node). Nodes of up to `leaf`
    members are compared whole. The members of a larger one are first compared
    within random blocks, which joins groups of copies; a node of one group is
    done. Where few members stand outside the node's main group they meet all
    of it, block by block; other nodes branch by BRANCHES coordinates that the
    node picks, so that a pair's chance to stay together somewhere below does
    not fall with the depth. At the last depth nodes are dealt into blocks of
    which each meets each. No task lists pairs: each gives at most one link
    for each member, which joins it to a group.
    """
    found = None
    width = F.length("sig")
    rows = roots.select("rep", "node").join(reps.select("rep", "sig"), "rep") if "sig" not in roots.columns else roots.select("rep", "node", "sig")
    for level in range(depth + 1):
        rows = _sized(rows)
        crowded = F.col("n") > leaf
        block = F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("n") / leaf).cast("long"))
        unit = F.when(crowded, F.xxhash64("node", block)).otherwise(F.col("node"))
        more = _candidates(rows.select(unit.alias("unit"), F.col("rep").alias("label"), "sig"), maybe)
        found = cut(more if found is None else more.unionByName(found))
        big = rows.where(crowded)
        if big.isEmpty():
            break
        big = _opened(big, components(found))
        few = (F.col("open") <= 2 * leaf) if level < depth else F.lit(True)
        parts, open_parts = F.ceil(F.col("n") / leaf).cast("int"), F.ceil(F.col("open") / leaf).cast("int")
        near = _dealt(big.where(few), "node", parts, open_parts, F.col("label") != F.col("main"))
        found = cut(found.unionByName(_candidates(near, maybe)))
        many = big.where(~few)
        if level == depth or many.isEmpty():
            break
        branch = [F.xxhash64("node", F.lit(b), F.substring("sig", F.pmod(F.xxhash64("node", F.lit(b)), width).cast("int") + 1, F.lit(1))) for b in range(BRANCHES)]
        rows = cut(many.select("rep", F.explode(F.array(*branch)).alias("node"), "sig"))
    return components(found)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, as a square matrix (its diagonal is not filled)."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1]) if len(flat) else np.zeros(0, np.int64)
    often = np.diff(np.append(first, len(flat)))
    out = np.zeros((n, n), np.float32)
    line = out.reshape(-1)
    for k in range(2, min(RARE, n) + 1):
        own = owner[first[often == k][:, None] + np.arange(k)]
        for i in range(k):
            for j in range(i + 1, k):
                np.add.at(line, own[:, i] * n + own[:, j], 1)
    out += out.T
    wide = np.flatnonzero(often > RARE)
    for part in np.array_split(wide, max(1, -(-len(wide) // 2048))):
        if len(part):
            held = np.zeros((n, len(part)), np.float32)
            for column, k in enumerate(part):
                held[owner[first[k] : first[k] + often[k]], column] = 1
            out += held @ held.T
    return out


def forest(near: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Fewest pairs of `near` (a symmetric matrix) that join all it joins, given that equal labels are joined."""
    open_ = np.ones(len(near), bool)
    out = []
    unique = len(np.unique(label)) == len(label)
    for k in range(len(near)):
        if not open_[k]:
            continue
        open_[k] = False
        queue = [k]
        while queue:
            v = queue.pop()
            if not unique:
                same = np.flatnonzero(open_ & (label == label[v]))
                open_[same] = False
                queue += same.tolist()
            more = np.flatnonzero(open_ & near[v])
            open_[more] = False
            queue += more.tolist()
            out += [(v, int(m)) for m in more]
    return out


def _linked(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links that join all true links of each unit; rows: unit, rep, label, values (the whole set)."""

    def links(rep: np.ndarray, label: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        size = np.array([len(s) for s in sets], np.float64)
        if len(sets) == 2:
            both = len(np.intersect1d(*sets, assume_unique=True))
            return [(rep[0], rep[1])] if label[0] != label[1] and both and 100 * both >= percent * (size.sum() - both) else []
        both = shared_counts(sets)
        near = np.empty(both.shape, bool)
        for k in range(0, len(size), 256):  # a few rows at a time, as the numbers are wide
            part = both[k : k + 256]
            near[k : k + 256] = (part > 0) & (100.0 * part >= percent * (size[k : k + 256, None] + size[None, :] - part))
        np.fill_diagonal(near, False)
        return [(rep[i], rep[j]) for i, j in forest(near, label)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 0):
            if not table.num_rows:
                continue
            unit, rep, label = (table[c].to_numpy() for c in ("unit", "rep", "label"))
            edge = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            out: list[tuple[int, int]] = []
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                _, one = np.unique(rep[s:e], return_index=True)
                one += s
                if len(one) > 1:
                    out += links(rep[one], label[one], [np.frombuffer(table["values"][int(i)].as_py(), np.uint64) for i in one])
            yield batch_of(PAIR, [x[0] for x in out], [x[1] for x in out])

    return rows.select("unit", "rep", "label", "values").repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def connect(reps: DataFrame, roots: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, leaf: int = LEAF, depth: int = DEPTH, maybe: float = MAYBE, unit: int = UNIT, unit_values: int = UNIT_VALUES) -> DataFrame:
    """Verified links (a, b) that join all similar members of the trees with the first nodes `roots` (rep, node).

    reps: rep, n (size of its set) and sig (a byte for each minhash), of unlike
    sets; sets_of(ids) gives (rep, values) for `ids` (rep), values being the
    whole sorted set of 64-bit shingles. Candidate groups of up to `unit` sets
    are compared whole by one task each, exactly. Larger ones are compared in
    random blocks, dealt twice, so that linked copies join; then the members
    outside a group's main component meet all of it in blocks. Tasks give
    spanning links only, so rows stay linear in the members.
    """
    groups = candidate_groups(reps, roots, leaf, depth, maybe)
    sets = cut(sets_of(groups.select(F.col("id").alias("rep"))))
    own = groups.select(F.col("id").alias("rep"), F.col("component").alias("node")).join(reps.select("rep", F.col("n").alias("size")), "rep")
    weight = F.greatest(F.ceil(F.col("k") / unit), F.ceil(F.col("v") / unit_values)).cast("int")
    sizes = cut(own.groupBy("node").agg(F.count("*").alias("k"), F.sum("size").alias("v")).select("node", "k", weight.alias("parts")))
    rows = own.select("rep", "node").join(sizes, "node").withColumn("label", F.col("rep"))
    small = rows.where("parts = 1").select(F.col("node").alias("unit"), "rep", "label").join(sets, "rep")
    large = cut(rows.where("parts > 1"))
    links = _linked(small, percent)
    if large.isEmpty():
        return cut(links)
    for salt in (3, 4):
        block = F.pmod(F.xxhash64("rep", F.lit(salt)), F.col("parts").cast("long"))
        links = links.unionByName(_linked(large.select(F.xxhash64("node", block).alias("unit"), "rep", "label").join(sets, "rep"), percent))
    links = cut(links)
    open_ = _opened(large.select("node", "rep", "k", "parts"), components(links))
    open_parts = F.ceil(F.col("open") * F.col("parts") / F.col("k")).cast("int")
    dealt = _dealt(open_, "node", F.col("parts"), open_parts, F.col("label") != F.col("main"))
    return cut(links.unionByName(_linked(dealt.select("unit", "rep", "label").join(sets, "rep"), percent)))


def document_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, values): the whole shingle sets of the wanted texts; wanted: rep, doc_id, text_key."""
    schema = pa.schema([("rep", pa.int64()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rep = batch.column(0).to_pylist()
            for a, b, raw, offsets in text_chunks(batch.column(1)):
                values, bounds = _shingles(raw, offsets, size)
                ids, sets = [], []
                for i in range(a, b):
                    if rep[i] != last:  # rows that repeat stand together
                        last = rep[i]
                        ids.append(last)
                        sets.append(np.unique(values[bounds[i - a] : bounds[i - a + 1]]).tobytes())
                yield batch_of(schema, ids, sets)

    return keyed(docs).join(wanted, ["doc_id", "text_key"]).select("rep", "text").mapInArrow(run, "rep long, values binary")


def grouped(docs: DataFrame, size: int, percent: int, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH, unit: int = UNIT) -> DataFrame:
    """doc_id, text_key, n_shingles and `one` (doc_id, text_key of the first text of its group; null where doc_id is), by row."""
    trees = trees_for(percent / 100, recall)
    sigs = cut(signatures(docs, size, trees))
    known = sigs.where("set_key is not null and doc_id is not null")
    reps = known.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("sig").alias("sig"), F.first("roots").alias("roots"), F.first("n_shingles").alias("n"))
    reps = cut(reps.withColumn("rep", F.col("one.doc_id")))
    again = reps.groupBy("rep").agg(F.min("set_key").alias("least"), F.count("*").alias("k")).where("k > 1").select("rep", "least")
    if again.count():  # an id with unlike texts is the first of several classes: all but one go by a number of their own
        reps = reps.join(again, "rep", "left")
        reps = cut(reps.withColumn("rep", F.when(F.col("least") != F.col("set_key"), F.xxhash64("set_key")).otherwise(F.col("rep"))).drop("least"))
    roots = reps.select("rep", "sig", F.explode(F.array(*(F.xxhash64(F.lit(t), F.substring("roots", t * 4 + 1, 4)) for t in range(trees)))).alias("node"))

    def sets_of(ids: DataFrame) -> DataFrame:
        return document_sets(docs, reps.select("rep", "one.*").join(ids, "rep", "left_semi"), size)

    final = components(connect(reps.select("rep", "sig", "n"), roots, sets_of, percent, leaf, depth, unit=unit))
    linked = cut(reps.select("rep", "set_key", "one").join(final.withColumnRenamed("id", "rep"), "rep"))
    first = linked.groupBy("component").agg(F.min("one").alias("first"))
    by_class = reps.select("set_key", "one").join(linked.join(first, "component").select("set_key", "first"), "set_key", "left")
    by_class = cut(by_class.select("set_key", F.coalesce("first", "one").alias("one")))
    out = sigs.select("doc_id", "text_key", "n_shingles", "set_key").join(by_class, "set_key", "left")
    one = F.when(F.col("doc_id").isNotNull(), F.coalesce("one", F.struct("doc_id", "text_key")))
    return out.select("doc_id", "text_key", "n_shingles", one.alias("one"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH, unit: int = UNIT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id), one row for each row of `docs`.

    Words are lower-cased (A-Z) runs without white space. Documents with equal
    shingle sets are one class; classes meet in independent trees (as many as
    `recall` of links at the threshold asks for), and links hold on full sets
    only. Ties go to the smallest doc_id. Repeated rows get equal results; rows
    of one doc_id with unlike texts are compared each on its own. Null and
    blank texts have no shingles and stay alone; very long texts are read whole,
    one at a time where they fill a chunk; a null doc_id has a null component
    and is kept; an empty table gives an empty one; other columns are not read.
    """
    out = grouped(docs, size, percent, recall, leaf, depth, unit)
    component = F.col("one.doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))

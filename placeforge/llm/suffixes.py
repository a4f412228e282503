"""Suffix-array dedup: repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from placeforge.llm.runtime import cut
from placeforge.llm.textkit import BASE, BASE_INVERSE, MASK, batch_of, mix, powers, text_chunks, word_hashes, words

GROUP = 512  # distinct segments of one anchor that are expanded together
BATCH = 1 << 20  # bytes that are expanded at a time
END = 0xFF  # stands in no UTF-8 text
WORDY = np.uint64(1)  # an anchor's lowest bit: its windows are counted in words


def windows_hash(raw: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of raw[i:i+size] for all i."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(BASE_INVERSE, len(raw))[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width], by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


NONE = (*(np.zeros(0, np.int64),) * 2, np.zeros(0, np.uint64), np.zeros(0, bool))


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a text: first and last start of the runs of `length`-windows with one minimal gram, its hash, and whether it repeats there.

    Equal windows have equal minimal grams, wherever they stand.
    """
    grams = windows_hash(raw, gram)
    wide = length - gram + 1
    if len(grams) < wide:
        return NONE
    return lowest(grams, wide)


def lowest(grams: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the runs of windows of `wide` grams with one minimum, that, and whether it stands in the run more than once.

    Where a gram repeats, its next place continues the run: only the value
    matters, and a text that repeats itself makes few runs instead of one a byte.
    """
    bits = np.uint64(max(1, int(len(grams) - 1).bit_length()))
    place = np.arange(len(grams), dtype=np.uint64)
    low = sliding_min(((grams >> bits) << bits) | place, wide) & ((np.uint64(1) << bits) - np.uint64(1))
    least = grams[low.astype(np.int64)]
    edge = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    last = np.append(edge[1:] - 1, len(low) - 1)
    return edge, last, least[edge], low[last] != low[edge]


def passages(raw: np.ndarray, count: int, always: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a text: first and end byte of the runs of `count`-word windows with one minimal word gram, its hash, and whether it repeats there.

    Runs of `always`-byte windows come with them where such a window may hold fewer words.
    """
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    gram = max(2, count * 4 // 25)
    hashes = word_hashes(raw, starts, ends)
    found = []
    if len(starts) >= count:
        grams = np.full(len(starts) - gram + 1, gram, np.uint64)
        for k in range(gram):
            grams = mix(grams * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + len(grams)])
        edge, last, key, again = lowest(grams, count - gram + 1)
        found.append((starts[edge], ends[last + count - 1], key, again))
    if len(raw) >= always:
        begun = np.zeros(len(raw) + 1, np.int64)
        begun[starts + 1] = 1
        begun = np.cumsum(begun)
        sparse = begun[always:] - begun[:-always] <= count
        if sparse.any():
            before = np.concatenate([[0], np.cumsum(sparse)])
            edge, last, key, again = anchors(raw, always, max(4, always * 8 // 25))
            some = before[last + 1] > before[edge]
            found.append((edge[some], last[some] + always, key[some], again[some]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else NONE


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` bytes or more (prefix doubling from 8)."""
    n = len(text)
    padded = np.concatenate([text, np.full(8, END, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k]
    have = 8
    while True:
        order = np.argsort(key, kind="stable" if n < 1000 else None)
        ordered = key[order]
        fresh = np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)])
        number = np.cumsum(fresh)
        if have >= depth or number[-1] == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = number.astype(np.uint64) + np.uint64(1)
        after = np.zeros(n, np.uint64)
        after[: max(n - have, 0)] = rank[have:]
        key = rank * np.uint64(n + 1) + after
        have *= 2


def long_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and where a suffix shares at least `length` bytes with the one before it.

    Breadth-first backward extension: from the interval of the empty string,
    each interval of w is extended by every byte c of its transform to that of
    cw, and the common prefix behind it, if still unknown, is |w|; only such
    intervals are extended on. Values come in increasing order; at `length`
    the expansion stops, and what is unknown by then is long enough.
    """
    n = len(text)
    order = suffix_order(text, length)
    bwt = text[order - 1].astype(np.int64)
    step = np.empty(n, np.int64)
    step[np.argsort(bwt, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = True
    known[n] = True
    lo, hi = np.array([0]), np.array([n])
    for level in range(length):
        size = hi - lo
        total = np.concatenate([[0], np.cumsum(size)])
        if not total[-1]:
            break
        owner = np.repeat(np.arange(len(lo)), size)
        member = np.arange(total[-1]) + np.repeat(lo - total[:-1], size)
        code = owner * 256 + bwt[member]
        sort = np.argsort(code, kind="stable")
        ordered = code[sort]
        first = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        last = np.append(first[1:], len(ordered)) - 1
        new_lo, new_hi = step[member[sort[first]]], step[member[sort[last]]] + 1
        if level == 0:
            open_ = np.ones(len(new_lo), bool)
        else:
            open_ = ~known[new_hi]
        known[new_hi[open_]] = True
        lo, hi = new_lo[open_], new_hi[open_]
    return order, ~known[:n]


def repeated_starts(segments: list[bytes], weights: list[int], length: int, groups: list[int] | None = None) -> list[np.ndarray]:
    """For each segment a mask of the starts whose `length` bytes occur at least twice in its group, counting segments by weight."""
    size = np.array([len(s) for s in segments], np.int64)
    text = np.frombuffer((bytes([END])).join(segments) + bytes([END]), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    order, joined = long_prefixes(text, length)
    weight = np.zeros(len(text), np.int64)
    for b, s, w in zip(begin, size, weights, strict=True):
        weight[b : b + s - length + 1] = w
    run = np.cumsum(~joined) - 1
    if groups is not None:
        group = np.repeat(np.unique(groups, return_inverse=True)[1], size + 1)
        run = np.unique(run * len(segments) + group[order], return_inverse=True)[1]
    total = np.bincount(run, weight[order])
    often = np.zeros(len(text), bool)
    often[order] = total[run] >= 2
    return [often[b : b + s - length + 1] & (weight[b : b + s - length + 1] > 0) for b, s in zip(begin, size, strict=True)]


def covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs that the marked starts' strings cover."""
    at = np.flatnonzero(starts)
    if not len(at):
        return at, at
    cuts = np.flatnonzero(np.diff(at) > length)
    return at[np.concatenate([[0], cuts + 1])], at[np.append(cuts, len(at) - 1)] + length


def segment_hashes(raw: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of raw[first:stop]."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return mix((sums[stop] - sums[first]) * powers(BASE_INVERSE, len(raw))[first] + (stop - first).astype(np.uint64))


def word_windows(raw: np.ndarray, offsets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all `count`-word windows of the texts: first and end byte within the text, fingerprint, and the text's number."""
    starts, ends, first = words(raw, offsets)
    sums = np.zeros(len(starts) + 1, np.uint64)
    np.cumsum(word_hashes(raw, starts, ends) * powers(BASE, len(starts) + 1)[: len(starts)], out=sums[1:])
    size = np.maximum(np.diff(first) - count + 1, 0)
    owner = np.repeat(np.arange(len(size)), size)
    at = np.arange(size.sum()) + np.repeat(first[:-1] - np.cumsum(size) + size, size)
    key = mix((sums[at + count] - sums[at]) * powers(BASE_INVERSE, len(starts) + 1)[at])
    return starts[at] - offsets[owner], ends[at + count - 1] - offsets[owner], key, owner


def _occurrences(docs: DataFrame, length: int, gram: int, least_words: int, always: int, report_words: int) -> DataFrame:
    schema = pa.schema([("uid", pa.int64()), ("check", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int64()), ("seg", pa.int64()), ("again", pa.bool_())])
    shortest = min(length, 2 * report_words - 1) if report_words else length  # words of one byte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, checks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, raw, offsets in text_chunks(batch.column(2)):
                found = []
                for i in np.flatnonzero(np.diff(offsets) >= shortest):
                    own = raw[offsets[i] : offsets[i + 1]]
                    dealt = []
                    if len(own) >= length and least_words:
                        first, end, key, again = passages(own, least_words, always)
                        dealt.append((first, end, key & ~WORDY, again))
                    elif len(own) >= length:
                        first, last, key, again = anchors(own, length, gram)
                        dealt.append((first, last + length, key & ~WORDY, again))
                    if report_words:
                        first, end, key, again = passages(own, report_words, len(own) + 1)
                        dealt.append((first, end, key | WORDY, again))
                    first, end, key, again = (np.concatenate(c) for c in zip(*dealt, strict=True))
                    seg = segment_hashes(own, first, end)
                    found.append((np.full(len(first), uids[a + i]), np.full(len(first), checks[a + i]), first, end - length, key.view(np.int64), seg.view(np.int64), again))
                if found:
                    yield batch_of(schema, *(np.concatenate(c) for c in zip(*found, strict=True)))

    return docs.select("uid", "check", "text").mapInArrow(run, "uid long, check int, first int, last int, anchor long, seg long, again boolean")


def _segments(rows: DataFrame) -> DataFrame:
    """(anchor, seg, w, kinds, bytes) of the representative segments; rows: text (or bytes), wanted."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("w", pa.int64()), ("kinds", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                raw = text.as_py()
                raw = raw.encode() if isinstance(raw, str) else raw
                want = wanted.as_py()
                yield batch_of(schema, *([x[k] for x in want] for k in ("anchor", "seg", "w", "kinds")), [raw[x["first"] : x["stop"]] for x in want])

    return rows.select("text", "wanted").mapInArrow(run, "anchor long, seg long, w long, kinds long, bytes binary")


def repeated_passages(segments: list[bytes], weights: list[int], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each segment the byte runs of its `count`-word windows that occur at least twice, counting segments by weight; windows that overlap are one run."""
    size = np.array([len(s) + 1 for s in segments], np.int64)
    raw = np.frombuffer(b" ".join(segments) + b" ", np.uint8)
    first, end, key, owner = word_windows(raw, np.concatenate([[0], np.cumsum(size)]), count)
    same = np.unique(key, return_inverse=True)[1]
    often = np.bincount(same, np.array(weights, np.int64)[owner])[same] >= 2
    first, end, owner = first[often], end[often], owner[often]
    bounds = np.searchsorted(owner, np.arange(len(segments) + 1))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        s, e = first[a:b], end[a:b]
        apart = s[1:] >= e[:-1]
        out.append((s[np.concatenate([[True], apart])] if b > a else s, e[np.concatenate([apart, [True]])] if b > a else e))
    return out


def _expand(segments: DataFrame, length: int, apart: bool, count: int = 0) -> DataFrame:
    """(anchor, seg, runs): the covered byte runs of each segment that a repeat covers; with `count` by windows of so many words."""
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("runs", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BATCH and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    def solve(held: list[tuple]) -> pa.RecordBatch:
        texts, weights = [x[3] for x in held], [x[2] for x in held]
        if count:
            found = repeated_passages(texts, weights, count)
        else:
            found = [covered(mask, length) for mask in repeated_starts(texts, weights, length, [x[0] for x in held] if apart else None)]
        out = []
        for x, (s, e) in zip(held, found, strict=True):
            if len(s):
                out.append((x[0], x[1], [{"s": int(p), "e": int(q)} for p, q in zip(s, e, strict=True)]))
        return batch_of(schema, [o[0] for o in out], [o[1] for o in out], [o[2] for o in out])

    segments = segments.select("anchor", "seg", "w", "bytes")
    return segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, seg long, runs array<struct<s:int,e:int>>")


def _window_keys(segments: DataFrame, length: int, count: int) -> DataFrame:
    """(key, check, anchor, seg, s, e, w) of every window of the segments, of `count` words or else `length` bytes."""
    schema = pa.schema([("key", pa.int64()), ("check", pa.int64()), ("anchor", pa.int64()), ("seg", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("w", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, seg, w, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, np.uint8)
                if count:
                    s, e, key, _ = word_windows(own, np.array([0, len(own)]), count)
                    check = np.full(len(key), anchor)
                else:
                    key, check = windows_hash(own, length), windows_hash(own ^ np.uint8(0x5A), length).view(np.int64)
                    s = np.arange(len(key))
                    e = s + length
                n = len(key)
                yield batch_of(schema, key.view(np.int64), check, np.full(n, anchor), np.full(n, seg), s, e, np.full(n, w))

    return segments.select("anchor", "seg", "w", "bytes").mapInArrow(run, "key long, check long, anchor long, seg long, s int, e int, w long")


def _hot_runs(segments: DataFrame, length: int, apart: bool, count: int = 0) -> DataFrame:
    """The end of dealing by longer grams: a gram as long as the window is the window, and equal ones are counted (by 128 bits), each by itself."""
    keys = cut(_window_keys(segments, length, count))
    same = ["anchor", "key", "check"] if apart else ["key", "check"]
    often = keys.groupBy(*same).agg(F.sum("w").alias("n")).where("n > 1")
    return keys.join(often, same).groupBy("anchor", "seg").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))  # at most a segment's windows


def _dealt_again(segments: DataFrame, length: int, gram: int, apart: bool) -> DataFrame:
    """(anchor, seg, w, first, last, anchor2, seg2, again) of runs of windows of the segments by a longer minimal gram."""
    names = ("anchor", "seg", "w", "first", "last", "anchor2", "seg2", "again")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, seg, w, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, np.uint8)
                first, last, key, again = anchors(own, length, gram)
                if apart:
                    key = mix(key + np.uint64(anchor & MASK))
                n = len(first)
                yield batch_of(schema, np.full(n, anchor), np.full(n, seg), np.full(n, w), first, last, key.view(np.int64), segment_hashes(own, first, last + length).view(np.int64), again)

    return segments.select("anchor", "seg", "w", "bytes").mapInArrow(run, "anchor long, seg long, w long, first int, last int, anchor2 long, seg2 long, again boolean")


def _grouped(found: DataFrame, anchor: str, seg: str, weight, one: list[str]) -> DataFrame:
    """Each distinct segment with its weight, the anchor's weight n and its kinds, and its first place `one`, for anchors that can hold a repeat."""
    distinct = found.groupBy(anchor, seg).agg(weight.alias("w"), F.min(F.struct(*one)).alias("one"), F.first("again").alias("again"))
    distinct = cut(distinct.select(anchor, seg, "w", "again", "one.*"))
    counts = distinct.groupBy(anchor).agg(F.sum("w").alias("n"), F.count("*").alias("kinds"), F.max("again").alias("alone")).where("n > 1 or alone").drop("alone")
    return cut(distinct.join(counts, anchor))


def _runs(segments: DataFrame, length: int, gram: int, group: int, apart: bool) -> DataFrame:
    """(anchor, seg, runs): the covered byte runs of each segment; anchors of more than `group` segments are dealt anew by a longer gram.

    Equal windows have equal minimal grams of any length, so they still meet:
    first by grams halfway to the window's length, and what is still too much
    for one task by grams of its length, where only equal windows are together.
    """
    runs = _expand(segments.where(F.col("kinds") <= group), length, apart)
    hot = segments.where(F.col("kinds") > group)
    if hot.isEmpty():
        return runs
    longer = (length * 8 // 25 + length) // 2
    if gram >= longer:
        return runs.unionByName(_hot_runs(hot, length, apart))
    found = cut(_dealt_again(hot, length, longer, apart))
    distinct = _grouped(found, "anchor2", "seg2", F.sum("w"), ["anchor", "seg", "first", "last"])
    stop = (F.col("last") + length).cast("int")
    alike = distinct.where("kinds = 1 and n > 1").select("anchor2", "seg2", F.array(F.struct(F.lit(0).alias("s"), (stop - F.col("first")).alias("e"))).alias("runs"))
    unlike = distinct.where("kinds > 1 or n = 1")
    wanted = unlike.groupBy("anchor", "seg").agg(F.collect_list(F.struct(F.col("anchor2").alias("anchor"), F.col("seg2").alias("seg"), "w", "kinds", "first", stop.alias("stop"))).alias("wanted"))  # at most a segment's windows
    parts = cut(_segments(hot.select("anchor", "seg", F.col("bytes").alias("text")).join(wanted, ["anchor", "seg"])))
    below = _runs(parts, length, longer, group, apart).select(F.col("anchor").alias("anchor2"), F.col("seg").alias("seg2"), "runs")
    placed = found.select("anchor", "seg", "first", "anchor2", "seg2").join(alike.unionByName(below), ["anchor2", "seg2"])
    placed = placed.select("anchor", "seg", F.transform("runs", lambda r: F.struct((r["s"] + F.col("first")).alias("s"), (r["e"] + F.col("first")).alias("e"))).alias("runs"))
    return runs.unionByName(placed.groupBy("anchor", "seg").agg(F.flatten(F.collect_set("runs")).alias("runs")))  # at most a segment's windows


def _passage_runs(segments: DataFrame, count: int, group: int) -> DataFrame:
    """(anchor, seg, runs): the byte runs of each segment whose `count`-word windows repeat; those of crowded anchors are counted each by itself."""
    runs = _expand(segments.where(F.col("kinds") <= group), 0, True, count)
    hot = segments.where(F.col("kinds") > group)
    return runs if hot.isEmpty() else runs.unionByName(_hot_runs(hot, 0, True, count))


def whole_words(raw: bytes, start: int, end: int) -> int:
    """Words of `raw` that lie wholly within raw[start:end]."""
    n = len(raw[start:end].split())
    if start and n and not raw[start - 1 : start].isspace() and not raw[start : start + 1].isspace():
        n -= 1
    if end < len(raw) and n and not raw[end : end + 1].isspace() and not raw[end - 1 : end].isspace():
        n -= 1
    return n


def remove_repeats(docs: DataFrame, length: int = 400, group: int = GROUP, least_words: int = 0, always: int = 0, report_words: int = 0) -> DataFrame:
    """All columns of `docs` with `kept` (the UTF-8 bytes that stay) and `spans` (removed runs, byte offsets).

    A byte goes if a string of `length` bytes over it also starts anywhere else
    in any row, the same row included. Texts are judged as given. Every window
    of that length is dealt by its minimal gram, so equal ones meet; equal
    segments around an anchor are one with a weight. Anchors with unlike
    segments go through the transform; one with more than `group` of them is
    first dealt anew by longer grams, until its groups fit. Null and empty texts
    lose nothing (kept is empty); very long texts are read whole; a null doc_id
    is a row like others; repeated rows count as two texts; ties need no rule,
    as all of equal strings go; columns named like the new ones are replaced,
    others stay whatever their names; an empty table gives an empty one.

    With `least_words` strings count of that many words, or of `always` bytes;
    no such string may be shorter than `length`, which then is the least overlap
    that is looked for where windows with equal grams meet. Runs with fewer
    whole words and bytes stay.

    With `report_words` a column `passages` follows: byte runs of that many
    words in a row (or more) which also stand in a row anywhere else, whatever
    space is between them. They are found in the same passes and only listed:
    `kept` and `spans` do not depend on them.
    """
    gram = max(4, length * 8 // 25)
    docs = docs.drop("kept", "spans", *["passages"] * bool(report_words))
    text = F.col("text").cast("string")
    # the rows travel as one column, so that no name of theirs can clash
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"), F.xxhash64("doc_id", "text").alias("uid"), F.hash(F.lit(7), "text", "doc_id").alias("check"))
    who = ["uid", "check"]
    found = cut(_occurrences(keyed.select(*who, "text"), length, gram, least_words, always, report_words))
    # most anchors stand alone, and only the others travel on
    met = found.groupBy("anchor").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 or again").select("anchor")
    found = cut(found.join(met, "anchor", "left_semi"))
    distinct = _grouped(found, "anchor", "seg", F.count("*"), [*who, "first", "last"])
    stop = (F.col("last") + length).cast("int")
    alike = distinct.where("kinds = 1 and n > 1").select("anchor", "seg", F.array(F.struct(F.lit(0).alias("s"), (stop - F.col("first")).alias("e"))).alias("runs"))
    unlike = distinct.where("kinds > 1 or n = 1")  # one text can repeat within itself
    wanted = unlike.groupBy(*who).agg(F.collect_list(F.struct("anchor", "seg", "w", "kinds", "first", stop.alias("stop"))).alias("wanted"))
    texts = keyed.select(*who, "text").join(wanted, who).dropDuplicates(who)
    segments = cut(_segments(texts))
    wordy = F.col("anchor").bitwiseAND(1) == 1
    runs = alike.unionByName(_runs(segments.where(~wordy), length, gram, group, least_words > 0))
    if report_words:
        runs = runs.unionByName(_passage_runs(segments.where(wordy), report_words, group))
    spans = found.select(*who, "first", "anchor", "seg").join(runs, ["anchor", "seg"])
    spans = spans.select(*who, "anchor", F.transform("runs", lambda r: F.struct((r["s"] + F.col("first")).alias("s"), (r["e"] + F.col("first")).alias("e"))).alias("runs"))
    kinds = {"runs of repeats": ~wordy} | ({"runs of passages": wordy} if report_words else {})
    spans = spans.groupBy(*who).agg(*(F.flatten(F.collect_set(F.when(own, F.col("runs")))).alias(c) for c, own in kinds.items()))  # at most a text's windows, however often its row stands
    return _cut_texts(keyed.select(*who, "row").join(spans, who, "left").select("row.*", *(F.col(c) for c in kinds)), docs, least_words, always)


def joined(runs: pa.Scalar) -> list[list[int]]:
    """The runs in order, those that touch or overlap as one."""
    out: list[list[int]] = []
    for r in sorted((r["s"], r["e"]) for r in runs.as_py()) if runs.is_valid else ():
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return out


def _cut_texts(rows: DataFrame, docs: DataFrame, least_words: int, always: int) -> DataFrame:
    names = docs.columns
    at = names.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    listed = ArrayType(StructType().add("start", "long").add("end", "long"))
    schema = StructType(list(docs.schema.fields)).add("kept", "binary").add("spans", listed)
    more = ["passages"] * (len(rows.columns) - len(names) - 1)
    for name in more:
        schema = schema.add(name, listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, runs in zip(batch.column(at), batch.column(len(names)), strict=True):
                raw = str(text.as_py() if text.is_valid else "").encode()  # a text of another type counts as its string
                merged = joined(runs)
                if least_words:
                    merged = [r for r in merged if r[1] - r[0] >= always or whole_words(raw, *r) >= least_words]
                stay, place = [], 0
                for s, e in merged:
                    stay.append(raw[place:s])
                    place = e
                kept.append(b"".join([*stay, raw[place:]]))
                spans.append([{"start": s, "end": e} for s, e in merged])
            passages_ = [pa.array([[{"start": s, "end": e} for s, e in joined(runs)] for runs in batch.column(len(names) + 1)], kind) for _ in more]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(kept, pa.binary()), pa.array(spans, kind), *passages_], names=[*names, "kept", "spans", *more])

    return rows.mapInArrow(run, schema)

"""Benchmark decontamination: q-gram lemma filter in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeforge.llm.textkit import LOWER, SPACE, mix, text_chunks

Q = 10
WINDOW = 120
RATE = 0.07
INDEX_BYTES = 4 << 20  # of items; a task holds about 40 times as much while it sorts them
BITS = 22
STARTS = 1024  # windows that are aligned at a time
FOLD = LOWER.copy()
FOLD[SPACE] = 0x20
LEAKS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def grams(folded: np.ndarray) -> np.ndarray:
    """A 64-bit value for the Q bytes from each position on."""
    n = len(folded) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((n + Q - 8,), np.dtype("<u8"), np.ascontiguousarray(folded).tobytes(), strides=(1,))
    return mix(eight[:n] * np.uint64(0x9E3779B97F4A7C15) + eight[Q - 8 :])


def budget(length: int) -> tuple[int, int, int]:
    """For an item: the window that must match, its edits, and the q-grams that such a match leaves (lemma)."""
    window = min(length, WINDOW)
    edits = int(window * RATE)
    while edits and window + 1 - Q - Q * edits < 1:
        edits -= 1
    return window, edits, max(1, window + 1 - Q - Q * edits)


class Index:
    """All q-grams of a bounded set of items with their places."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, FOLD[np.frombuffer(t, np.uint8)]) for i, t in items]
        self.items = [(i, t) for i, t in self.items if len(t) >= Q]
        keys = [grams(t) for _, t in self.items]
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(keys)), [len(k) for k in keys]) if keys else np.zeros(0, np.int64)
        self.at = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.key, kind="stable")
        self.key, self.item, self.at = self.key[order], self.item[order], self.at[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[self.key >> np.uint64(64 - BITS)] = True
        self.bounds = np.array([budget(len(t)) for _, t in self.items], np.int64).reshape(-1, 3)

    def leaks(self, raw: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
        """For each text the items that it holds, with byte spans and edits."""
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        if not len(self.key) or len(raw) < Q:
            return out
        folded = FOLD[raw]
        key = grams(folded)
        at = np.flatnonzero(self.seen[key >> np.uint64(64 - BITS)])
        lo = np.searchsorted(self.key, key[at], "left")
        hit = self.key[np.minimum(lo, len(self.key) - 1)] == key[at]
        at, lo = at[hit], lo[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[doc + 1]
        at, lo, doc = at[inside], lo[inside], doc[inside]
        # no item can match where fewer grams than its bound stand within a window and its edits
        least = int(self.bounds[:, 2].min())
        reach = int((self.bounds[:, 0] + 2 * self.bounds[:, 1]).max())
        if len(at) < least:
            return out
        dense = np.zeros(len(at) + 1, np.int64)
        ok = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] <= reach)
        np.add.at(dense, ok, 1)
        np.add.at(dense, ok + least, -1)
        keep = np.cumsum(dense)[:-1] > 0
        at, lo, doc = at[keep], lo[keep], doc[keep]
        for d in np.unique(doc):
            own = doc == d
            out[d] = self._match(folded[offsets[d] : offsets[d + 1]], at[own] - offsets[d], lo[own])
        return out

    def _match(self, text: np.ndarray, at: np.ndarray, lo: np.ndarray) -> list[dict]:
        count = np.searchsorted(self.key, self.key[lo], "right") - lo
        pos = np.repeat(at, count)
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, place = self.item[entry], self.at[entry]
        edits = self.bounds[item, 1]
        wide = 2 * edits + 1
        diagonal = pos - place + (1 << 40)
        found: dict[int, tuple[int, int, int]] = {}
        for shift in (0, 1):  # overlapping bands: any diagonals `edits` apart share one of them
            band = (diagonal + shift * (edits + 1)) // wide
            order = np.lexsort((place, band, item))
            it, bd, pl, ps = item[order], band[order], place[order], pos[order]
            start = 0
            edge = np.flatnonzero((it[1:] != it[:-1]) | (bd[1:] != bd[:-1])) + 1
            for end in [*edge.tolist(), len(it)]:
                window, e, need = self.bounds[it[start]]
                k = int(it[start])
                n = end - start
                if n >= need and (k not in found or found[k][2] > 0):
                    spans = pl[start + need - 1 : end] - pl[start : end - need + 1]
                    at_ = start + np.flatnonzero(spans <= window - Q)
                    firsts, one = self._firsts(k, pl[at_], pl[at_ + need - 1], int(window))
                    if len(firsts):
                        hit = self._align(k, firsts, int(window), int(e), text, firsts + (ps[at_] - pl[at_])[one])
                        if hit and (k not in found or hit[2] < found[k][2]):
                            found[k] = hit
                start = end
        return [{"item_id": self.items[k][0], "start": s, "end": t, "edits": e} for k, (s, t, e) in sorted(found.items())]

    def _firsts(self, k: int, low: np.ndarray, high: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """All starts of item windows that hold the grams from `low` to `high` of one of the runs, and a run of each."""
        last = len(self.items[k][1]) - window
        lo, hi = np.clip(high + Q - window, 0, last), np.minimum(low, last)
        size = np.maximum(hi - lo + 1, 0)
        run = np.repeat(np.arange(len(low)), size)
        firsts, where = np.unique(lo[run] + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size), return_index=True)
        return firsts, run[where]

    def _align(self, k: int, firsts: np.ndarray, window: int, edits: int, text: np.ndarray, begin: np.ndarray) -> tuple[int, int, int] | None:
        """Least edits of the item's windows from `firsts` on against text near `begin`, both ends free within the band."""
        band = 3 * edits + 1
        best = np.concatenate([least_edits(self.items[k][1], firsts[i : i + STARTS], text, begin[i : i + STARTS], window, edits, band) for i in range(0, len(firsts), STARTS)])
        for i in np.argsort(best, kind="stable"):
            if best[i] > edits:
                break
            pattern = self.items[k][1][firsts[i] : firsts[i] + window]
            s = max(0, int(begin[i]) - 3 * edits)
            region = text[s : max(0, min(len(text), int(begin[i]) + window + 3 * edits))]
            exact = region.tobytes().find(pattern.tobytes())
            hit = (s + exact, s + exact + window, 0) if exact >= 0 else banded(pattern, region, s, edits, int(begin[i]) - s, band)
            if hit:
                return hit
        return None


def least_edits(item: np.ndarray, firsts: np.ndarray, text: np.ndarray, begin: np.ndarray, window: int, edits: int, band: int) -> np.ndarray:
    """For each start of an item window its semi-global edits within `band` diagonals of `begin`; edits + 1 where above."""
    reach = np.arange(window + 2 * band)
    at = begin[:, None] - band + reach
    near = np.where((at >= 0) & (at < len(text)), text[np.clip(at, 0, len(text) - 1)].astype(np.int16), 256)
    pattern = item[firsts[:, None] + np.arange(window)]
    out = np.full(len(firsts), edits + 1, np.int16)
    exact = (near[:, band : band + window] == pattern).all(1)
    if exact.any():
        out[exact] = 0
        return out
    wide = np.arange(2 * band + 1, dtype=np.int16)
    row = np.zeros((len(firsts), 2 * band + 1), np.int16)
    live = np.arange(len(firsts))
    for i in range(window):
        following = row + (near[:, i : i + 2 * band + 1] != pattern[:, i : i + 1])
        following[:, :-1] = np.minimum(following[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(following - wide, axis=1) + wide
        if i % 8 == 7:
            stay = row.min(1) <= edits
            if not stay.all():
                row, near, pattern, live = row[stay], near[stay], pattern[stay], live[stay]
                if not len(live):
                    return out
    out[live] = np.minimum(row.min(1), edits + 1)
    return out


def banded(pattern: np.ndarray, region: np.ndarray, shift: int, edits: int, diagonal: int, band: int) -> tuple[int, int, int] | None:
    """Semi-global edit distance within `band` diagonals around `diagonal`; None above `edits`."""
    far = edits + 1
    start = {j: (0, j) for j in range(max(0, diagonal - band), min(len(region), diagonal + band) + 1)}
    row = start
    for i, c in enumerate(pattern.tolist(), 1):
        following = {}
        for j in range(max(0, i + diagonal - band), min(len(region), i + diagonal + band) + 1):
            best = (far, 0)
            if j - 1 in row:
                x = row[j - 1]
                best = min(best, (x[0] + (region[j - 1] != c), x[1]))
            if j in row:
                best = min(best, (row[j][0] + 1, row[j][1]))
            if j - 1 in following:
                best = min(best, (following[j - 1][0] + 1, following[j - 1][1]))
            if best[0] <= edits:
                following[j] = best
        row = following
        if not row:
            return None
    j, (e, s) = min(row.items(), key=lambda x: (x[1][0], -x[0]))
    return shift + s, shift + j, int(e)


def find_leaks(docs: DataFrame, items: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """All columns of `docs` with `leaks`: the benchmark items found in each text (offsets in UTF-8 bytes).

    An item is found where a window of it (WINDOW bytes, or all of a shorter
    item) stands in the text with at most RATE edits a byte; letters A-Z and
    kinds of white space count as equal. The item set is measured first: up to
    `index_bytes` of it are held by each task at a time, larger sets take as
    many passes. Null or short (under Q bytes) items match nothing; null and
    empty texts hold none; very long texts are read whole; repeated rows get
    equal results, repeated items count once for each id. Of several places of
    an item the one with the fewest edits is given, of those the first found.
    Empty tables give no leaks. A column named `leaks` is replaced.
    """
    docs = docs.drop("leaks")
    items = items.where("text is not null and item_id is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // index_bytes))
    out = docs.withColumn("leaks", F.expr(f"cast(array() as {LEAKS})"))
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).distinct().orderBy("item_id", "text")
        out = _scan(out, [(r[0], r[1].encode()) for r in part.toLocalIterator()])
    return out


def _scan(docs: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    at, own = docs.columns.index("text"), docs.columns.index("leaks")
    schema = StructType(list(docs.schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            found = batch.column(own).to_pylist()
            for a, _, raw, offsets in text_chunks(batch.column(at)):
                for i, more in enumerate(index.leaks(raw, offsets)):
                    found[a + i] = found[a + i] + more
            columns = list(batch.columns)
            columns[own] = pa.array(found, batch.schema.field(own).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)

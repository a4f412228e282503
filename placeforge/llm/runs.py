"""Periodic runs of words: squares from LZ blocks, their whole vocabulary on the suffix order, occurrences merged into runs.

The suffix tree is held as a suffix array with the names of all blocks of
2, 4, 8, ... words (prefix doubling), so that one comparison tells whether two
stretches are equal, and all steps run on whole chunks of texts. A name holds
its text's number: nothing matches across texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.textkit import BASE, batch_of, mix, text_chunks, word_hashes, words

CHUNK = 1 << 21
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
])


class Suffixes:
    """Suffix order of many texts at once, with the names of their blocks of 2**level words.

    keys: for each word a number that stands for its text and itself; first,
    end: bounds of its text. names[level][i] == names[level][j] if the blocks
    are equal; in the last level all names differ and are the suffixes' ranks.
    """

    def __init__(self, keys: np.ndarray, first: np.ndarray, end: np.ndarray):
        n = len(keys)
        self.first = first
        self.order = np.argsort(keys, kind="stable")
        self.depth = np.zeros(n + 1, np.int8)  # no other suffix of the text shares 2**depth words
        slots, ties = np.arange(n), keys[self.order]
        rank = np.full(n + 1, -1, np.int64)  # the row behind the last word equals none
        self.names: list[np.ndarray] = []
        while True:
            fresh = np.ones(len(slots) + 1, bool)
            fresh[1:-1] = ties[1:] != ties[:-1]
            rank = rank.copy()
            at = self.order[slots]
            rank[at] = slots[np.maximum.accumulate(np.where(fresh[:-1], np.arange(len(slots)), 0))] if len(slots) else slots
            self.names.append(rank)
            slots = slots[~(fresh[:-1] & fresh[1:])]
            if not len(slots):
                return
            at = self.order[slots]
            self.depth[at] = len(self.names)
            far = at + (1 << (len(self.names) - 1))
            ties = (rank[at] << 32) | np.where(far < end[at], rank[np.minimum(far, n)] + 1, 0)
            by = np.argsort(ties, kind="stable")
            self.order[slots], ties = at[by], ties[by]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on."""
        a, b = i.copy(), j.copy()
        least = np.minimum(self.depth[i], self.depth[j])
        for level in range(int(least.max(initial=0)) - 1, -1, -1):
            on = np.flatnonzero(least > level)
            same = self.names[level][a[on]] == self.names[level][b[on]]
            a[on] += same.astype(np.int64) << level
            b[on] += same.astype(np.int64) << level
        return a - i

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words just before i equal those just before j, where i < j stand in one text or at its end."""
        a, b, low = i.copy(), j.copy(), self.first[np.minimum(i, len(self.first) - 1)]
        for level in range(len(self.names) - 2, -1, -1):
            step = 1 << level
            on = np.flatnonzero(a - step >= low)
            on = on[self.names[level][a[on] - step] == self.names[level][b[on] - step]]
            a[on] -= step
            b[on] -= step
        return i - a

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the `length` words from i equal those from j; those from i lie in one text."""
        level = np.frexp(length.astype(float))[1] - 1
        out = np.zeros(len(i), bool)
        for one in np.unique(level):
            on = np.flatnonzero(level == one)
            if one < len(self.names):
                name, more = self.names[one], length[on] - (1 << int(one))
                far = np.minimum(j[on] + more, len(name) - 1)
                out[on] = (name[i[on]] == name[j[on]]) & (name[i[on] + more] == name[far])
        return out

    def earlier(self) -> np.ndarray:
        """For each word how many words from it on also start at an earlier place of its text."""
        n = len(self.order)
        slots = np.flatnonzero(self.depth[self.order] > 0)
        place, group = self.order[slots], self.names[0][self.order[slots]]
        longest = np.zeros(n, np.int64)
        for step in (-1, 1):
            near = np.arange(len(slots)) + step  # nearest slot to that side with a smaller place; what lies between is larger
            near[(near < 0) | (near >= len(slots))] = -1
            near[(near >= 0) & (group[near] != group)] = -1
            on = np.flatnonzero(near >= 0)
            while len(on):
                on = on[place[near[on]] > place[on]]
                near[on] = near[near[on]]
                on = on[near[on] >= 0]
            on = np.flatnonzero(near >= 0)
            longest[place[on]] = np.maximum(longest[place[on]], self.ahead(place[on], place[near[on]]))
        return longest


def _blocks(earlier: np.ndarray) -> np.ndarray:
    """Starts of the LZ blocks: each the longest stretch that also starts earlier, or one word."""
    lengths, starts, at = earlier.tolist(), [], 0
    while at < len(lengths):
        starts.append(at)
        at += lengths[at] or 1
    return np.array(starts, np.int64)


def _covering(tree: Suffixes) -> np.ndarray:
    """Rows (start, end, period) of runs that hold the first occurrence of every square.

    That occurrence touches two LZ blocks, and its right half two at most. With
    its centre in a block, either the next block starts in its right half, or it
    starts before the block itself; both places are compared with all words
    of the block, the second also with those of the next one.
    """
    n = len(tree.order)
    starts = _blocks(tree.earlier())
    block = np.repeat(np.arange(len(starts)), np.diff(starts, append=n))
    name, each = tree.names[0], np.arange(n)
    after = np.append(starts[1:], n)[block]
    pairs = [np.stack([each, after])[:, name[each] == name[after]]]
    for back in (0, 1):
        head = starts[np.maximum(block - back, 0)]
        on = np.flatnonzero((head > 0) & (block >= back) & (name[np.maximum(head - 1, 0)] == name[:-1]))
        pairs.append(np.stack([head[on], on + 1]))
    u, v = np.concatenate(pairs, 1)
    u, v = np.stack([u, v])[:, u < v]
    right, left = tree.ahead(u, v), tree.behind(u, v)
    on = np.flatnonzero(right + left >= v - u)
    return np.unique(np.column_stack([u[on] - left[on], v[on] + right[on], v[on] - u[on]]), axis=0)


def _primitive(tree: Suffixes, runs: np.ndarray) -> np.ndarray:
    """Runs with their smallest periods, each once: a period that is no multiple of one of its own."""
    start, end, period = runs.T.copy()
    most = int(period.max(initial=1))
    factor = np.arange(most + 1)  # smallest prime factors
    for p in range(2, int(most**0.5) + 1):
        if factor[p] == p:
            multiples = factor[p * p :: p]
            multiples[multiples == np.arange(p * p, most + 1, p)] = p
    rest = period.copy()
    while (on := np.flatnonzero(rest > 1)).size:
        p = factor[rest[on]]
        less = period[on] // p
        fits = tree.ahead(start[on], start[on] + less) >= end[on] - start[on] - less
        period[on[fits]] = less[fits]
        rest[on] //= p
    return np.unique(np.column_stack([start, end, period]), axis=0)


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first, first + 1, ... of each row, and the rows that they belong to."""
    row = np.repeat(np.arange(len(first)), count)
    return np.arange(len(row)) - (np.cumsum(count) - count)[row] + first[row], row


def _bound(tree: Suffixes, at: np.ndarray, length: np.ndarray, rank: np.ndarray, side: int) -> np.ndarray:
    """The last slot to one side of `rank` whose suffix starts with the `length` words from `at`."""
    n, reach = len(tree.order), np.zeros(len(at), np.int64)
    step = 1 << max(0, n.bit_length() - 1)
    while step:
        to = rank + side * (reach + step)
        on = np.flatnonzero((to >= 0) & (to < n))
        on = on[tree.equal(at[on], tree.order[to[on]], length[on])]
        reach[on] += step
        step >>= 1
    return rank + side * reach


def find(tree: Suffixes, least_words: int, least_exponent: int) -> np.ndarray:
    """Rows (start, length, period), by start, then period, of all runs of at least that many words and periods (2 or more)."""
    none = np.zeros((0, 3), np.int64)
    runs = _covering(tree)
    if not len(runs):
        return none
    start, end, period = _primitive(tree, runs).T
    # the vocabulary: a walk along the suffix links goes word by word through a run, until its squares come again
    at, row = _spread(start, np.minimum(period, end - start - 2 * period + 1))
    q = period[row]
    rank = tree.names[-1][at]
    low, high = _bound(tree, at, 2 * q, rank, -1), _bound(tree, at, 2 * q, rank, 1)
    low, high, q = np.unique(np.column_stack([low, high, q]), axis=0).T
    # all places where a word of the vocabulary stands; places in a row make a run
    slot, row = _spread(low, high - low + 1)
    place, q = tree.order[slot], q[row]
    by = np.lexsort((place, q))
    place, q = place[by], q[by]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(place)) - 1
    start, period = place[head], q[head]
    length = place[tail] - start + 2 * period
    keep = length >= np.maximum(least_words, least_exponent * period)
    out = np.column_stack([start, length, period])[keep]
    return out[np.lexsort((out[:, 2], out[:, 0]))] if len(out) else none


def _chunk(raw: np.ndarray, offsets: np.ndarray, least_words: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray, list, list[str]]:
    """For each text its number of words, its number of runs, the runs (words from 0), and the text without repeats."""
    starts, ends, bound = words(raw, offsets)
    n_words = np.diff(bound)
    if not len(starts):
        return n_words, np.zeros(len(n_words), np.int64), [], [""] * len(n_words)
    text = np.repeat(np.arange(len(n_words)), n_words)
    keys = mix(word_hashes(raw, starts, ends) + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
    runs = find(Suffixes(keys, bound[:-1][text], bound[1:][text]), least_words, least_exponent)
    dropped = np.zeros(len(starts) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    # kept words, a space after each, in one buffer
    size = ends[kept] - starts[kept] + 1
    joined = np.full(int(size.sum()), 0x20, np.uint8)
    at, row = _spread(starts[kept], size - 1)
    joined[np.arange(len(at)) + row] = raw[at]
    to = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(kept, bound)]
    out = joined.tobytes()
    of = text[runs[:, 0]]
    runs[:, 0] -= bound[:-1][of]
    return n_words, np.bincount(of, minlength=len(n_words)), runs.tolist(), [out[a : max(a, b - 1)].decode() for a, b in zip(to[:-1], to[1:], strict=True)]


def find_runs(docs: DataFrame, least_words: int = 6, least_exponent: int = 4) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed, one row for each row of `docs`.

    A run is a stretch of consecutive words with smallest period q, of at least
    `least_words` words and `least_exponent` periods (2 or more), that no
    neighbouring word extends. collapsed holds the words outside all runs and
    the first period of each, joined by one space. Null, empty and blank texts
    have no words and no runs; a very long text is worked on alone, with about
    8 bytes a word for each doubling of its longest repeat; runs that tie or
    overlap are all listed. Repeated rows give repeated results, null ids stand
    for themselves, an empty table gives an empty one; other columns are not
    read. Words count as equal by 64 bits of fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(1), CHUNK):
                n_words, n_runs, found, collapsed = _chunk(raw, offsets, least_words, least_exponent)
                flat = pa.StructArray.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(3)], ["start", "length", "period"])
                runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_runs)]), pa.int32()), flat)
                yield batch_of(FOUND, batch.column(0).slice(a, b - a), n_words.astype(np.int64), runs, pa.array(collapsed, pa.string()))

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where texts of a tenth of the ids (crc32 of the id divisible by 10) repeat themselves from some word on.

    With h that number and g = h // 10, the words from a = g % n on come again
    with period 1 + (n - a) // (3 + g % 8). Null ids and texts without words
    stay as they are.
    """

    def loop(doc_id: int, text: str) -> str:
        own, g = WORD.findall(text.encode()), zlib.crc32(str(doc_id).encode()) // 10
        if not own:
            return text
        a = g % len(own)
        period = 1 + (len(own) - a) // (3 + g % 8)
        return b" ".join([*own[:a], *(own[a + i % period] for i in range(len(own) - a))]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            on = [k for k, i in enumerate(ids) if i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and texts[k].is_valid]
            if on:
                mask = np.zeros(len(ids), bool)
                mask[on] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array([loop(ids[k], texts[k].as_py()) for k in on], texts.type))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, text string")


def longest(runs: Column) -> Column:
    """The run of most periods, compared exactly; of equal ones the first, then that of the smallest period; null without runs."""
    more = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    better = lambda a, b: F.when(more(a, b) != 0, more(a, b) > 0).when(a["start"] != b["start"], a["start"] < b["start"]).otherwise(a["period"] < b["period"])
    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda best, r: F.when(best.isNull() | better(r, best), r).otherwise(best))

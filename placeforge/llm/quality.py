"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeforge.llm.runtime import split_of
from placeforge.llm.textkit import SPACE, batch_of, per_text, text_chunks, word_hashes, words

FEATURES = (
    "log_bytes", "log_words", "word_len", "upper", "digit", "symbol", "stop", "pipe", "newline", "high", "distinct_words",
    "distinct_pairs", "top_word", "repeats", "log_lines", "distinct_lines", "line_words", "long_words", "short_words",
    "symbol_ends", "stop_ends", "capital_words", "mark_words", "byte_entropy",
)
_KIND = np.zeros((8, 256), bool)
_KIND[0, 65:91] = True
_KIND[1, 48:58] = True
_KIND[2, [ord(c) for c in "#$%&*@~^_=+<>\\{}[]"]] = True
_KIND[3, [ord(c) for c in ".,;:"]] = True
_KIND[4, ord("|")] = True
_KIND[5, 10] = True
_KIND[6, 128:] = True
_KIND[7, [ord("!"), ord("?")]] = True


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    starts, ends, first = words(raw, offsets)
    n_words = np.diff(first)
    some = np.maximum(n_words, 1).astype(float)
    hashes, length = word_hashes(raw, starts, ends), ends - starts

    def share(mask, bounds, base):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / base

    byte = [share(k[raw], offsets, size) for k in _KIND]
    tail, head = (raw[ends - 1], raw[starts]) if len(starts) else (np.zeros(0, np.uint8),) * 2
    twin = np.zeros(len(starts), bool)
    twin[1:] = hashes[1:] == hashes[:-1]
    twin[first[:-1][first[:-1] < len(twin)]] = False  # the word before stands in another text
    newline = np.zeros(256, bool)
    newline[10] = True
    ls, le, lf = words(raw, offsets, newline)
    lines = word_hashes(raw, ls, le)
    n_lines = np.maximum(np.diff(lf), 1).astype(float)
    pairs = hashes.copy()
    pairs[1:] += hashes[:-1] * np.uint64(0x9FB21C651E98DF25)
    distinct, distinct_pairs, top, distinct_lines, entropy = (np.zeros(n) for _ in range(5))
    for i in range(n):
        a, b = first[i], first[i + 1]
        if a < b:
            _, count = np.unique(hashes[a:b], return_counts=True)
            distinct[i], top[i] = len(count), count.max()
            distinct_pairs[i] = len(np.unique(pairs[a + 1 : b])) if b - a > 1 else 1
        distinct_lines[i] = len(set(lines[lf[i] : lf[i + 1]].tolist()))
        if offsets[i] < offsets[i + 1]:
            p = np.bincount(raw[offsets[i] : offsets[i + 1]], minlength=256) / size[i]
            p = p[p > 0]
            entropy[i] = -(p * np.log2(p)).sum()
    marks = _KIND[2] | _KIND[4]
    out = np.column_stack([
        np.log1p(np.diff(offsets)), np.log1p(n_words), per_text(length.astype(float), first, np.add, 0.0) / some,
        *byte[:7], distinct / some, distinct_pairs / np.maximum(n_words - 1, 1), top / some, share(twin, first, some),
        np.log1p(np.diff(lf)), distinct_lines / n_lines, n_words / n_lines, share(length > 14, first, some), share(length < 4, first, some),
        share(marks[tail], first, some), share(_KIND[3][tail] | _KIND[7][tail], first, some), share(_KIND[0][head], first, some), byte[7], entropy,
    ])
    return out.astype(np.float32)


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays: a node's feature (-1: leaf), threshold, left child (right is next) and value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > self.threshold[at]
                at = np.where(inner, self.left[at] + right, at)
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, bins: int = 64, rate: float = 0.15, ridge: float = 2.0, least: float = 4.0) -> Forest:
    """Fit logistic boosting on histograms. No rows, or one class only, give the constant smoothed share."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    nodes: list[list] = []
    roots: list[int] = []
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for f in range(x.shape[1])]
        code = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
        flat = code + np.arange(x.shape[1]) * bins
        raw = np.full(len(y), prior)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            nodes.append([-1, 0.0, 0, 0.0])
            open_nodes = [(roots[-1], np.arange(len(y)))]
            for level in range(depth + 1):
                following = []
                for node, rows in open_nodes:
                    g, h = grad[rows].sum(), hess[rows].sum()
                    nodes[node][3] = rate * g / (h + ridge)
                    if level == depth or h < 2 * least:
                        continue
                    keys = flat[rows].ravel()
                    n = x.shape[1] * bins
                    gl = np.bincount(keys, np.repeat(grad[rows], x.shape[1]), n).reshape(-1, bins).cumsum(1)
                    hl = np.bincount(keys, np.repeat(hess[rows], x.shape[1]), n).reshape(-1, bins).cumsum(1)
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
                    gain[(hl < least) | (h - hl < least)] = 0
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] <= 1e-6 or b >= len(cuts[f]):
                        continue
                    left = len(nodes)
                    nodes[node][:3] = [int(f), float(cuts[f][b]), left]
                    nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
                    right = code[rows, f] > b
                    following += [(left, rows[~right]), (left + 1, rows[right])]
                open_nodes = following
            flat_tree = Forest(*_arrays(nodes), np.array(roots[-1:]), depth, 0.0)
            at = flat_tree.score(x)
            raw += np.log(at / (1 - at))
    return Forest(*_arrays(nodes), np.array(roots, np.int64), depth, prior)


def _arrays(nodes: list[list]) -> tuple[np.ndarray, ...]:
    columns = list(zip(*nodes, strict=True)) or [(), (), (), ()]
    return tuple(np.array(c, t) for c, t in zip(columns, (np.int64, np.float32, np.int64, float), strict=True))


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(1)):
                x = statistics(raw, offsets)
                yield batch_of(schema, batch.column(0).slice(a, b - a), pa.array(list(x), pa.list_(pa.float32())))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, folds: int = 5, **model) -> Forest:
    """Learn from at most `max_rows` labelled documents outside the held-out fold (crc32(doc_id) mod folds = 0).

    The rows with the smallest id hashes are taken, so the bound does not
    follow the order of the files. Null ids or labels teach nothing; a document
    labelled more than once counts with the mean, 1 from a half on; of unlike
    texts of one id that with the smallest statistics teaches. Ids are numbers.
    """
    known = labels.where("doc_id is not null and quality is not null").where(split_of("doc_id", folds) > 0)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    stats = document_statistics(picked).join(F.broadcast(known), "doc_id")
    rows = stats.groupBy("doc_id").agg(F.min("x").alias("x"), F.first("y").alias("y")).toPandas().sort_values("doc_id")  # at most max_rows
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), len(FEATURES))
    return boost(x, rows["y"].to_numpy(float), **model)


def score_quality(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """All columns of `docs` with `quality_score` (0 to 1) and `quality_ok` (score >= threshold).

    A null or empty text is scored by its (zero) statistics like any other.
    Very long texts are read whole. A score of just `threshold` passes. Columns
    named like the two new ones are replaced. Each row stands alone: repeated
    rows get equal scores, an empty table stays empty.
    """
    docs = docs.drop("quality_score", "quality_ok")
    at = docs.columns.index("text")
    schema = StructType(list(docs.schema.fields)).add("quality_score", "double").add("quality_ok", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [forest.score(statistics(raw, offsets)) for _, _, raw, offsets in text_chunks(batch.column(at))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            extra = [pa.array(scores, pa.float64()), pa.array(scores >= threshold, pa.bool_())]
            yield pa.RecordBatch.from_arrays(batch.columns + extra, batch.schema.names + ["quality_score", "quality_ok"])

    return docs.mapInArrow(run, schema)

"""Substring dedup by paragraph MinHash banding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeforge.llm.components import components
from placeforge.llm.minhash_paths import _coefficients, _shingles, connect, keyed
from placeforge.llm.runtime import cut
from placeforge.llm.suffixes import sliding_min
from placeforge.llm.textkit import BASE, BASE_INVERSE, LOWER, batch_of, mix, powers, text_chunks, word_hashes, words

SIZE = 5
PERCENT = 80
LEAST = 20  # words of a paragraph that is compared; shorter ones recur in clean texts and stay
SPREAD = 32  # starts of runs of which one is taken: LEAST + SPREAD - 1 words hold a whole run
WIDTH = 32
RECALL = 0.998
MAYBE = 0.55  # of WIDTH minhashes; a pair of 0.8 is 3.5 standard errors away


def tune(threshold: float, recall: float, width: int) -> tuple[int, int]:
    """Bands and rows with the fewest bucket entries whose recall at `threshold` is at least `recall`."""
    for bands in range(1, width + 1):
        for rows in range(width // bands, 0, -1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches the recall")


def paragraphs_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, first word, end word and kind (1: line, 0: run) of all texts' paragraphs; all words' starts and ends, and all shingles.

    Lines of LEAST or more words are paragraphs. So are runs of LEAST words
    wherever they stand, across lines too: of any SPREAD neighbouring starts
    the one with the lowest hash of its SIZE words begins a run, so equal
    passages give equal runs.
    """
    starts, ends, first = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    fresh = np.zeros(len(raw) + 1, np.int64)
    fresh[1:] = np.cumsum(raw == 10)
    line = fresh[starts]
    edge = np.ones(len(starts), bool)
    edge[1:] = line[1:] != line[:-1]
    edge[first[:-1][first[:-1] < len(starts)]] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(starts))
    long = end - begin >= LEAST
    begin, end = begin[long], end[long]
    n = max(len(starts) - SIZE + 1, 0)
    gram = np.full(n, SIZE, np.uint64)
    for k in range(SIZE):
        gram = mix(gram * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k : k + n])
    low = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        count = b - a - LEAST + 1  # starts of whole runs
        if count > 0:
            own = ((gram[a : a + count] >> np.uint64(32)) << np.uint64(32)) | np.arange(count, dtype=np.uint64)
            picked = np.unique(sliding_min(own, min(SPREAD, count)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            low.append(a + picked)
    run = np.concatenate(low) if low else np.zeros(0, np.int64)
    at, to = np.concatenate([begin, run]), np.concatenate([end, run + LEAST])
    kind = np.concatenate([np.ones(len(begin), np.int64), np.zeros(len(run), np.int64)])
    owner = np.searchsorted(first, at, "right") - 1
    order = np.lexsort((to, at))
    return owner[order], at[order], to[order], kind[order], starts, ends, gram


def _units(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """One row for each text: doc_id, text_key, n, its paragraphs' keys, byte spans and kinds, and of its lines sizes, bands and signatures."""
    names = ("keys", "starts", "ends", "kinds", "sizes", "bands", "sigs")
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), *((x, pa.binary()) for x in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _coefficients(WIDTH)
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(2)):
                owner, at, to, kind, starts, ends, gram = paragraphs_of(LOWER[raw], offsets)
                last = to - SIZE + 1
                chain = np.zeros(len(gram) + 1, np.uint64)
                np.cumsum(gram * powers(BASE, max(len(gram), 1))[: len(gram)], out=chain[1:])
                key = mix((chain[last] - chain[at]) * powers(BASE_INVERSE, len(gram) + 1)[at] + (to - at).astype(np.uint64))
                lines = np.flatnonzero(kind == 1)
                size = last[lines] - at[lines]
                sig = np.zeros((len(lines), WIDTH), np.uint32)
                if len(lines):
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    own = gram[np.repeat(at[lines] - bounds[:-1], size) + np.arange(bounds[-1])]
                    for j in range(WIDTH):
                        sig[:, j] = np.minimum.reduceat(((own * mul[j] + add[j]) >> np.uint64(32)).astype(np.uint32), bounds[:-1])
                band = np.full((len(lines), bands), 0x9E37, np.uint64)
                for j in range(bands * rows):
                    band[:, j // rows] = mix(band[:, j // rows] * np.uint64(31) + sig[:, j] + np.uint64(1))
                text = np.arange(b - a + 1)
                cut_at, line_at = np.searchsorted(owner, text), np.searchsorted(owner[lines], text)
                begin, end = starts[at] - offsets[owner], ends[to - 1] - offsets[owner]
                packed = [[x[i:j].tobytes() for i, j in zip(cut_at[:-1], cut_at[1:], strict=True)] for x in (key, begin.astype(np.int32), end.astype(np.int32), kind.astype(np.int8))]
                packed += [[x[i:j].tobytes() for i, j in zip(line_at[:-1], line_at[1:], strict=True)] for x in (size.astype(np.int32), band, (sig & 0xFF).astype(np.uint8))]
                yield batch_of(schema, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), np.diff(cut_at), *packed)

    return keyed(docs).mapInArrow(run, "doc_id long, text_key long, n long, " + ", ".join(f"{x} binary" for x in names))


def _flat(units: DataFrame) -> DataFrame:
    """key, doc_id, text_key, s and e of every paragraph of texts with an id."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy()
            key, s, e = (np.frombuffer(b"".join(batch.column(k).to_pylist()), kind) for k, kind in ((3, np.int64), (4, np.int32), (5, np.int32)))
            yield batch_of(schema, key, np.repeat(batch.column(0).to_numpy(), n), np.repeat(batch.column(1).to_numpy(), n), s, e)

    return units.where("doc_id is not null").select("doc_id", "text_key", "n", "keys", "starts", "ends").mapInArrow(run, "key long, doc_id long, text_key long, s int, e int")


def _lines(units: DataFrame, bands: int) -> DataFrame:
    """key, one (doc_id, text_key, s, e), n (shingles), bands and sig of every line of texts with an id."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("n", pa.int64()), ("bands", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy()
            key, s, e, kind, size = (np.frombuffer(b"".join(batch.column(k).to_pylist()), t) for k, t in ((3, np.int64), (4, np.int32), (5, np.int32), (6, np.int8), (7, np.int32)))
            own = np.flatnonzero(kind == 1)
            band, sig = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(len(own), -1) for k in (8, 9))
            yield batch_of(schema, key[own], np.repeat(batch.column(0).to_numpy(), n)[own], np.repeat(batch.column(1).to_numpy(), n)[own], s[own], e[own], size, [x.tobytes() for x in band], [x.tobytes() for x in sig])

    rows = units.where("doc_id is not null and octet_length(sizes) > 0").select("doc_id", "text_key", "n", "keys", "starts", "ends", "kinds", "sizes", "bands", "sigs")
    rows = rows.mapInArrow(run, "key long, doc_id long, text_key long, s int, e int, n long, bands binary, sig binary")
    return rows.select("key", F.struct("doc_id", "text_key", "s", "e").alias("one"), "n", "bands", "sig")


def _line_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, values): the whole shingle sets of the wanted lines; wanted: rep, one."""
    schema = pa.schema([("rep", pa.int64()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, places in zip(batch.column(0), batch.column(1), strict=True):
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                want = places.as_py()
                own = [raw[p["s"] : p["e"]] for p in want]
                values, bounds = _shingles(np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]), SIZE)
                yield batch_of(schema, [p["rep"] for p in want], [np.unique(values[i:j]).tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)])

    places = wanted.groupBy("one.doc_id", "one.text_key").agg(F.collect_list(F.struct("rep", "one.s", "one.e")).alias("places"))  # at most a text's lines
    return keyed(docs).join(places, ["doc_id", "text_key"]).select("text", "places").mapInArrow(run, "rep long, values binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_paragraphs, n_removed (paragraphs) and spans (maximal removed runs, UTF-8 byte offsets), by row of `docs`."""
    bands, rows = tune(PERCENT / 100, RECALL, WIDTH)
    units = cut(_units(docs, bands, rows))
    lines = _lines(units, bands)
    reps = cut(lines.groupBy(F.col("key").alias("rep")).agg(F.min("one").alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    roots = reps.select("rep", "sig", F.explode(F.array(*(F.xxhash64(F.lit(b), F.substring("bands", b * 8 + 1, 8)) for b in range(bands)))).alias("node"))
    links = connect(reps.select("rep", "sig", "n"), roots, lambda ids: _line_sets(docs, reps.select("rep", "one").join(ids, "rep", "left_semi")), PERCENT, maybe=MAYBE)
    near = components(links).select(F.col("id").alias("key"), "component")
    flat = _flat(units)
    equal = flat.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    clusters = cut(equal.join(near, "key", "full").select("key", F.coalesce("component", "key").alias("cluster")))
    placed = cut(flat.join(clusters, "key").select("cluster", F.struct("doc_id", "text_key", "s", "e").alias("one")))
    first = cut(placed.groupBy("cluster").agg(F.min("one").alias("first")))
    same = (F.col("one.doc_id") == F.col("first.doc_id")) & (F.col("one.text_key") == F.col("first.text_key")) & (F.col("one.s") < F.col("first.e"))
    gone = placed.join(first, "cluster").where(~same).select("one.*").distinct()
    gone = gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("gone"))  # at most a text's paragraphs
    out = units.select("doc_id", "text_key", F.col("n").alias("n_paragraphs")).join(cut(gone), ["doc_id", "text_key"], "left")
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    joined = F.aggregate("gone", none, lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))))).otherwise(F.concat(acc, F.array(x))))
    return out.select("doc_id", "text_key", "n_paragraphs", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(joined, none).alias("spans"))


def duplicate_paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_removed (paragraphs), removed_bytes and spans (maximal removed runs, UTF-8 byte offsets), one row for each row of `docs`.

    Paragraphs are lines of LEAST or more words, and runs of LEAST words that
    content picks anywhere, across lines too, so that a passage of over 50 words
    holds a whole run wherever it stands. Lines whose bands collide and whose
    five-word shingles have a Jaccard similarity of 0.8 or more make up
    clusters, and so do equal paragraphs (by a 64-bit key of their words). A
    run's similarity of 0.8 allows for no more than its last word, so runs are
    compared whole. Words are lower-cased (A-Z). Of each cluster the paragraph
    with the smallest doc_id, then place, stays, with those of its text that
    overlap it. Null and empty texts have no paragraphs; very long texts are
    read whole; a null doc_id loses nothing and is compared with none; rows that
    repeat a doc_id and its text share their results, unlike texts of one id
    are compared as two; an empty table gives an empty one; other columns are
    not read.
    """
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"])
    return repeated_spans(docs).select("doc_id", "n_paragraphs", "n_removed", size.alias("removed_bytes"), "spans")


def remove_paragraphs(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, `text` without the spans that duplicate_paragraphs names; a null text becomes empty."""
    found = repeated_spans(docs).where("n_removed > 0").select(F.struct("doc_id", "text_key").alias("text_id"), "spans").dropDuplicates(["text_id"])
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key")).alias("text_id"))
    joined = packed.join(found, "text_id", "left").select("row.*", F.col("spans").alias("removed spans"))
    at = docs.columns.index("text")
    schema = StructType(list(docs.schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                raw = (text.as_py() or "").encode()
                out, place = [], 0
                for span in gone.as_py() or []:
                    out.append(raw[place : span["s"]])
                    place = span["e"]
                texts.append(b"".join([*out, raw[place:]]).decode())
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, schema)

"""LM scoring with a Brown class bigram: exchange clustering, class transitions, word emissions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.runtime import cut, split_of
from placeforge.llm.textkit import LOWER, batch_of, runs, text_chunks, word_hashes, words

CLASSES = 64
CORE = 1024
BLOCK = 12 << 20
BUCKET = 400_000  # words of all blocks together that one task gathers
OTHER = 1  # the class of words outside the core while the core is clustered; the end has class 0
LAST_FIXED = 1
END = np.uint64(1)  # the end of a text is a token like others
ADD = 0.1
ALPHA = 20.0


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """Texts as block-local token numbers: one row for each block of about `block` bytes (or one longer text)."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.binary()), ("sizes", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])

    def pack(part: int, number: int, ids: list, train: list, sizes: list, hashes: list) -> pa.RecordBatch:
        flat = np.concatenate(hashes)
        names, local, often = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        names, local = names[order], rank[local]
        learn = np.repeat(np.array(train, bool), sizes)
        counts = np.bincount(local[learn], minlength=len(names)).astype(np.int32)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        key = hashlib.blake2b(f"{part} {number}".encode() + names[:64].tobytes(), digest_size=8).digest()
        return batch_of(schema, np.frombuffer(key, np.int64), [ids], [np.array(train, bool).tobytes()], [np.array(sizes, np.int64).tobytes()], [squeeze(_planes(local))], [names.tobytes()], [squeeze(counts.tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids, train, sizes, hashes = [], [], [], []
        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False)
            names = batch.column(0).to_pylist()
            for a, b, raw, offsets in text_chunks(batch.column(2)):
                raw = LOWER[raw]
                starts, ends, first = words(raw, offsets)
                flat = np.insert(word_hashes(raw, starts, ends), first[1:], END)
                ids += names[a:b]
                train += learn[a:b].tolist()
                sizes += (np.diff(first) + 1).tolist()
                hashes.append(flat)
                held += len(raw)
                if held >= block:
                    yield pack(part, number, ids, train, sizes, hashes)
                    number, held = number + 1, 0
                    ids, train, sizes, hashes = [], [], [], []
        if ids:
            yield pack(part, number, ids, train, sizes, hashes)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (split_of("doc_id", 10) != 0).alias("learn"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "block long, ids array<long>, train binary, sizes binary, tokens binary, words binary, counts binary")


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: equal high bytes stand together."""
    return np.ascontiguousarray(numbers.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _whole(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


def _unpack(batch: pa.RecordBatch, i: int):
    get = lambda name: batch.column(batch.schema.names.index(name))[i].as_py()
    squeeze = zstandard.ZstdDecompressor().decompress
    sizes = np.frombuffer(get("sizes"), np.int64)
    tokens = _whole(squeeze(get("tokens")))
    names = np.frombuffer(get("words"), np.uint64)
    counts = np.frombuffer(squeeze(get("counts")), np.int32)
    return get("block"), np.frombuffer(get("train"), bool), sizes, tokens, names, counts


def _spread(blocks: DataFrame, parts: int, evidence: tuple | None = None) -> DataFrame:
    """Each block's words in hash order, dealt into `parts` ranges: bucket, block, words, counts and, with `evidence` (core, group), neighbours' classes.

    A word's evidence is a list of (side and class, count) over its training
    neighbours: a core word's class, or OTHER.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(evidence)
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("sizes", pa.binary()), ("codes", pa.binary()), ("often", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for i in range(batch.num_rows):
                block, train, sizes, tokens, names, counts = _unpack(batch, i)
                order = np.argsort(names)
                names, counts = names[order], counts[order]
                number = np.zeros(len(names), np.int32)
                code, often = np.zeros(0, np.uint8), np.zeros(0, np.int32)
                if shared.value is not None:
                    core, group, kinds = shared.value
                    rank = np.empty(len(order), np.int64)
                    rank[order] = np.arange(len(order))
                    at = _positions(core, names)
                    cls = np.where(at >= 0, group[np.maximum(at, 0)], OTHER)
                    word = rank[tokens]
                    seq = cls[word]
                    left, _ = _before(seq, sizes, 0)
                    right = np.append(seq[1:], 0)
                    learn = np.repeat(train, sizes) & (at[word] < 0)
                    key = np.concatenate([word[learn] * (2 * kinds) + left[learn], word[learn] * (2 * kinds) + kinds + right[learn]])
                    key, often = np.unique(key, return_counts=True)
                    code = (key % (2 * kinds)).astype(np.uint8)
                    number = np.bincount(key // (2 * kinds), minlength=len(names)).astype(np.int32)
                    often = often.astype(np.int32)
                bucket = ((names >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                edge = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
                total = np.concatenate([[0], np.cumsum(number)])
                spans = list(zip(edge[:-1], edge[1:], strict=True))
                if len(names):
                    yield batch_of(
                        schema, bucket[edge[:-1]].astype(np.int64), np.full(len(spans), block), [names[p:q].tobytes() for p, q in spans], [squeeze(_planes(counts[p:q])) for p, q in spans],
                        [squeeze(_planes(number[p:q])) for p, q in spans], [squeeze(code[total[p] : total[q]].tobytes()) for p, q in spans], [squeeze(_planes(often[total[p] : total[q]])) for p, q in spans],
                    )

    return blocks.select("block", "train", "sizes", "tokens", "words", "counts").mapInArrow(run, "bucket long, block long, words binary, counts binary, sizes binary, codes binary, often binary")


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's rows: distinct words, their counts over all blocks, and by row each word's number."""
    loose = zstandard.ZstdDecompressor().decompress
    names = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
    counts = np.concatenate([_whole(loose(x)) for x in table["counts"].to_pylist()])
    word, at = np.unique(np.concatenate(names), return_inverse=True)
    c = np.zeros(len(word), np.int64)
    np.add.at(c, at, counts)
    return word, c, at, np.array([len(x) for x in names])


def _core_words(blocks: DataFrame, parts: int, core: int) -> np.ndarray:
    """The words of the exchange: the most frequent training words of the corpus (ties: the smaller hash), and the end."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 0):
            bucket = table["bucket"].to_numpy()
            for k in np.unique(bucket):
                word, c, _, _ = _gathered(table.filter(bucket == k))
                word, c = word[c > 0], c[c > 0]
                top = np.lexsort((word.view(np.int64), -c))[:core]  # no other word of this range can be among the first `core` of all
                yield batch_of(schema, word[top].view(np.int64), c[top])

    counts = _spread(blocks, parts).select("bucket", "words", "counts").repartition(parts, "bucket").sortWithinPartitions("bucket")
    rows = counts.mapInArrow(run, "word long, n long").orderBy(F.desc("n"), "word").limit(core).collect()
    words_ = np.array([r.word for r in rows], np.int64).view(np.uint64)
    return np.unique(np.append(words_, END))


def _core_pairs(blocks: DataFrame, core: np.ndarray) -> np.ndarray:
    """Counts of neighbouring core words in training texts, all others being one (at most core x core numbers)."""
    shared = blocks.sparkSession.sparkContext.broadcast(core)
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                _, train, sizes, tokens, names, _ = _unpack(batch, i)
                at = _positions(own, names)
                number = np.where(at >= 0, at, len(own))[tokens]
                left, ok = _before(number, sizes, int(np.searchsorted(own, END)))
                ok &= np.repeat(train, sizes)
                pair, n = np.unique(left[ok] * (len(own) + 1) + number[ok], return_counts=True)
                yield batch_of(schema, pair, n)

    rows = blocks.select("block", "train", "sizes", "tokens", "words", "counts").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    size = len(core) + 1
    out = np.zeros(size**2, np.int64)
    out[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out.reshape(size, size)


def _positions(own: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(own, names), len(own) - 1)
    return np.where(own[at] == names, at, -1)


def _before(values: np.ndarray, sizes: np.ndarray, start) -> tuple[np.ndarray, np.ndarray]:
    """Each token's predecessor in its text; the first one follows an end."""
    left = np.empty_like(values)
    left[1:] = values[:-1]
    left[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = start
    return left, np.ones(len(values), bool)


def exchange(pairs: np.ndarray, fixed: tuple[int, ...], classes: int = CLASSES, rounds: int = 12) -> np.ndarray:
    """Class of each word: words move to the class that raises the class-bigram likelihood most, until none moves.

    Words start by frequency rank; those of `fixed` (the end, and all words
    outside the core as one) keep the first classes, each its own.
    """
    n, own = len(pairs), len(fixed)
    rank = np.argsort(np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable"))
    k = max(own + 1, min(classes, n))
    group = own + rank % (k - own)
    group[list(fixed)] = np.arange(own)
    table = np.zeros((k, k))
    np.add.at(table, (group[:, None], group[None, :]), pairs)
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)
    for _ in range(rounds):
        moved = 0
        for w in np.argsort(rank):
            if w in fixed:
                continue
            old = group[w]
            self_pair = float(pairs[w, w])
            right = np.bincount(group, pairs[w], k)
            left = np.bincount(group, pairs[:, w], k)
            right[old] -= self_pair
            left[old] -= self_pair
            base = table.copy()
            base[old] -= right
            base[:, old] -= left
            base[old, old] -= self_pair
            row, col = base.sum(1), base.sum(0)
            r, c = right.sum() + self_pair, left.sum() + self_pair
            gain = (f(base + right[None, :]) - f(base)).sum(1) + (f(base + left[:, None]) - f(base)).sum(0)
            d = np.diag(base)
            gain += f(d + right + left + self_pair) - f(d + right) - f(d + left) + f(d)
            gain -= f(row + r) - f(row) + f(col + c) - f(col)
            gain[:own] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table = base
            table[new] += right
            table[:, new] += left
            table[new, new] += self_pair
            moved += new != old
            group[w] = new
        if not moved:
            break
    return group


def _assign(blocks: DataFrame, parts: int, core: np.ndarray, group: np.ndarray, logp: np.ndarray) -> DataFrame:
    """The exchange step for all words outside the core, by their neighbours in the whole corpus; and each block's answers.

    One row for each bucket and block: bucket, block, c and class of the block's
    words in hash order; and one row without a block for each bucket, with the
    tokens and the kinds of words by class.
    """
    kinds = len(logp)
    shared = blocks.sparkSession.sparkContext.broadcast((core, group, np.concatenate([logp, logp.T])))
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("cs", pa.binary()), ("classes", pa.binary()), ("n", pa.list_(pa.int64())), ("kinds", pa.list_(pa.int64()))])

    def choose(table: pa.Table) -> Iterator[pa.RecordBatch]:
        core, group, gain = shared.value
        loose, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        word, c, at, sizes = _gathered(table)
        number = np.concatenate([_whole(loose(x)) for x in table["sizes"].to_pylist()])
        code = np.concatenate([np.frombuffer(loose(x), np.uint8) for x in table["codes"].to_pylist()]).astype(np.int64)
        often = np.concatenate([_whole(loose(x)) for x in table["often"].to_pylist()])
        key, where = np.unique(np.repeat(at, number) * (2 * kinds) + code, return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, where, often)
        owner = key // (2 * kinds)
        best = np.full(len(word), LAST_FIXED + 1, np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1]) if len(key) else np.zeros(0, np.int64)
        for part in np.array_split(starts, len(key) // 40_000 + 1):
            if len(part):
                s, e = part[0], int(np.searchsorted(owner, owner[part[-1]], "right"))
                total = np.add.reduceat(gain[key[s:e] % (2 * kinds)] * n[s:e, None], part - s, 0)
                total[:, : LAST_FIXED + 1] = -np.inf
                best[owner[part]] = total.argmax(1)
        known = _positions(core, word)
        best = np.where(known >= 0, group[np.maximum(known, 0)], best)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        bucket, blocks_ = table["bucket"][0].as_py(), table["block"].to_pylist()
        m = len(blocks_)
        replies = [(squeeze(np.ascontiguousarray(c[own].view(np.uint8).reshape(-1, 8).T).tobytes()), squeeze(best[own].astype(np.uint8).tobytes())) for own in (at[p:q] for p, q in zip(edge[:-1], edge[1:], strict=True))]
        yield batch_of(schema, [bucket] * m, blocks_, [r[0] for r in replies], [r[1] for r in replies], [None] * m, [None] * m)
        seen = c > 0
        yield batch_of(schema, [bucket], [None], [None], [None], [np.bincount(best, c, kinds).astype(np.int64)], [np.bincount(best[seen], minlength=kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, 0):
            bucket = table["bucket"].to_numpy()
            for k in np.unique(bucket):
                yield from choose(table.filter(bucket == k))

    rows = _spread(blocks, parts, (core, group, kinds)).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "bucket long, block long, cs binary, classes binary, n array<long>, kinds array<long>")


def score_texts(docs: DataFrame, classes: int = CLASSES, core: int = CORE, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score; one row for each row of `docs`.

    Rows whose crc32(doc_id) mod 10 is not 0 teach (a null id teaches too); all
    are scored, in log10. base_score is the smoothed unigram. The class model
    gives P(class | class before) P(word | class): the `core` most frequent
    words are clustered by exchange on their pair counts, all other words being
    one; then every other word moves to the class that its neighbours, counted
    over the whole corpus, make likeliest (ties: the smaller class). Counts,
    classes and scores do not depend on how the rows are dealt. An unseen word
    is one event, with the share that once-seen words have after a class. Null
    and empty texts are the end token alone; very long texts are one block;
    repeated rows teach as often as they stand and score alike; an empty table
    gives an empty one; without training rows all is uniform. A doc_id that is
    no number is an error. Other columns are not read.
    """
    blocks = cut(_blocks(docs, block))
    held = blocks.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    parts = max(1, -(-held // (8 * bucket)))
    core_words = _core_words(blocks, parts, core)
    pairs = _core_pairs(blocks, core_words)
    group = exchange(pairs, (int(np.searchsorted(core_words, END)), len(core_words)), classes)
    k = int(group.max()) + 1
    table = np.zeros((k, k))
    np.add.at(table, (group[:, None], group[None, :]), pairs)
    share = (table.sum(0) + 1) / (table.sum() + k)
    smooth = (table + ALPHA * share) / (table.sum(1, keepdims=True) + ALPHA)
    # what a word gains in class c: log P(c | before) and log P(after | c), against the size of c
    logp = np.log(smooth) - np.log(share)[None, :]
    answers = cut(_assign(blocks, parts, core_words, group, logp))
    by_class, total, kinds = np.zeros(k), 0, 0
    stats = answers.where("block is null").select(F.posexplode(F.arrays_zip("n", "kinds")).alias("class", "x")).groupBy("class").agg(F.sum("x.n").alias("n"), F.sum("x.kinds").alias("kinds"))
    for r in stats.collect():  # one row for each class
        by_class[r["class"]] = r["n"]
        total, kinds = total + r["n"], kinds + r["kinds"]
    tables = answers.where("block is not null").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "cs", "classes"))).alias("answers"))  # at most a block's ranges
    coded = cut(blocks.join(tables, "block", "left").select("block", "train", "sizes", "tokens", "words", "counts", "ids", "answers").mapInArrow(_encode(total, kinds, by_class), "ids array<long>, train binary, sizes binary, codes binary, n_known binary, base binary, emit binary, moves binary"))
    moves = np.zeros(((k + 1), (k + 1)))
    unseen = np.zeros(k + 1)
    seen = np.zeros(k + 1)
    for r in coded.select(F.explode(_moves(coded, k)).alias("m")).groupBy("m.key").agg(F.sum("m.n").alias("n")).collect():  # at most 3 (k + 1)^2 sums
        kind, at = divmod(r["key"], (k + 1) ** 2)
        if kind == 0:
            moves[at // (k + 1), at % (k + 1)] = r["n"]
        elif kind == 1:
            unseen[at] = r["n"]
        else:
            seen[at] = r["n"]
    return _score(coded, k, moves, unseen, seen, by_class, total)


def _encode(total: int, kinds: int, by_class: np.ndarray):
    """Blocks with their words' counts and classes become class codes by token and sums by text."""
    k = len(by_class)
    kind = [("ids", pa.list_(pa.int64()))] + [(n, pa.binary()) for n in ("train", "sizes", "codes", "n_known", "base", "emit", "moves")]
    schema = pa.schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loose = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                _, train, sizes, tokens, names, _ = _unpack(batch, i)
                answers = batch.column(batch.schema.names.index("answers"))[i].as_py() or []
                order = np.argsort(names)
                c, cls = np.zeros(len(names), np.int64), np.zeros(len(names), np.uint8)
                if answers:
                    c[order] = np.concatenate([np.frombuffer(loose(x["cs"]), np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel() for x in answers])
                    cls[order] = np.concatenate([np.frombuffer(loose(x["classes"]), np.uint8) for x in answers])
                cls[c == 0] = k  # unseen
                base = np.log10((c + ADD) / (total + ADD * (kinds + 1)))
                emit = np.where(c > 0, np.log10(np.maximum(c, 1) / np.maximum(by_class[np.minimum(cls, k - 1)], 1)), 0.0)
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                add = lambda x: np.add.reduceat(x[tokens], first)
                codes = cls[tokens]
                # moves: in training, from the class before (once-seen words stand for unseen ones) to the class
                learn = np.repeat(train, sizes)
                once = (c == 1)[tokens]
                before, _ = _before(codes.astype(np.int64), sizes, 0)
                once_before, _ = _before(once, sizes, False)
                size = k + 1
                ok = learn
                moves = np.bincount(before[ok] * size + codes[ok], minlength=size * size)
                moves += np.bincount(np.full(int((ok & once_before).sum()), k) * size + codes[ok & once_before], minlength=size * size)
                unseen = np.bincount(before[ok & once], minlength=size) + np.bincount(np.full(int((ok & once & once_before).sum()), k), minlength=size)
                seen = moves.reshape(size, size).sum(1)
                flat = np.concatenate([moves, unseen, seen]).astype(np.int64)
                squeeze = zstandard.ZstdCompressor(level=1).compress
                yield batch_of(schema, batch.column(batch.schema.names.index("ids")).slice(i, 1), [train.tobytes()], [sizes.tobytes()], [squeeze(codes.tobytes())], [add((c > 0).astype(np.int64)).tobytes()], [add(base).tobytes()], [add(emit).tobytes()], [squeeze(flat.tobytes())])

    return run


def _moves(coded: DataFrame, k: int):
    """The move counts of a block as an array of (key, n); a Python function, as the counts are packed."""
    size = (k + 1) ** 2

    @F.pandas_udf("array<struct<key:long,n:long>>")
    def unpack(packed: pd.Series) -> pd.Series:
        out = []
        for p in packed:
            flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.int64)
            at = np.flatnonzero(flat)
            key = np.where(at < size, at, np.where(at < size + k + 1, at, size * 2 + at - size - (k + 1)))
            out.append([{"key": int(a), "n": int(b)} for a, b in zip(key, flat[at], strict=True)])
        return pd.Series(out)

    return unpack(coded["moves"])


def _score(coded: DataFrame, k: int, moves: np.ndarray, unseen: np.ndarray, seen: np.ndarray, by_class: np.ndarray, total: int) -> DataFrame:
    share = (by_class + 1e-3) / (by_class.sum() + 1e-3 * k)
    given = (moves[:, :k] + ALPHA * share) / (moves[:, :k].sum(1, keepdims=True) + ALPHA)
    rare = (unseen.sum() + 1) / (seen.sum() + 2)
    new = (unseen + ALPHA * rare) / (seen + ALPHA)
    step = np.log10(np.concatenate([given * (1 - new[:, None]), new[:, None]], 1))
    shared = coded.sparkSession.sparkContext.broadcast(step)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                train, sizes, codes, known, base, emit = (batch.column(j)[i].as_py() for j in range(1, 7))
                sizes = np.frombuffer(sizes, np.int64)
                codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(codes), np.uint8).astype(np.int64)
                before, _ = _before(codes, sizes, 0)
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                score = np.add.reduceat(step[before, codes], first) + np.frombuffer(emit)
                ids = batch.column(0)[i].values
                yield batch_of(schema, ids, ~np.frombuffer(train, bool), sizes, np.frombuffer(known, np.int64), np.full(len(sizes), total), np.frombuffer(base), score)

    out = coded.select("ids", "train", "sizes", "codes", "n_known", "base", "emit").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select("doc_id", F.when(F.col("doc_id").isNull(), False).otherwise(F.col("held_out")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

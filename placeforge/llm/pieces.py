"""SentencePiece encoding and decoding by streaming Viterbi."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

from placeforge.llm.textkit import mix, text_chunks, word_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
STEP = 0x9E3779B97F4A7C15
UNKNOWN_PENALTY = 10.0
LOOK = 64
SHORT = 48  # longest span that is decoded side by side with others
CACHE = 600_000


@dataclass
class Vocabulary:
    """Pieces as bytes (the escape sign stands for a space), with ids and scores, and the ids of single bytes."""

    pieces: list[bytes]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    size: int

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = (float(self.scores.min()) if len(self.scores) else 0.0) - UNKNOWN_PENALTY
        self.lookup = {p: (float(s), int(i)) for p, s, i in zip(self.pieces, self.scores, self.ids, strict=True)}
        keys = np.array([_piece_hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_scores, self.key_ids = keys[order], self.scores[order], self.ids[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True
        inner = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        # where no piece holds such a pair, all paths of the lattice meet between its two bytes
        self.space_cuts = not any(x[1:] == b" " and x[:1] != b" " for x in inner)
        self.newline_cuts = not any(b"\n" in p for p in self.pieces)
        raw = [bytes()] * self.size
        for p, i in zip(self.pieces, self.ids, strict=True):
            raw[i] = p
        for b, i in enumerate(self.byte_ids):
            raw[i] = bytes([b])
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_len)])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)


def _piece_hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * STEP + b + 1) & ((1 << 64) - 1)
    return int(mix(np.array([h], np.uint64))[0])


def log_probabilities(scores: np.ndarray) -> np.ndarray:
    """Log-probabilities of pieces from a model's scores.

    A merge model stores the negative rank of each piece, which is no
    log-probability: the sum over a path would mostly count pieces of low rank.
    Ranks follow frequency, so a piece's probability is taken by Zipf's law as
    1 / (rank + 1) over the sum of all. Nothing is fitted. Scores that are
    log-probabilities already (not a run of whole numbers) stay.
    """
    if not len(scores) or not (scores == np.round(scores)).all():
        return scores
    rank = np.minimum(-scores, len(scores)) + 1.0
    return -np.log(rank) - np.log((1 / rank).sum())


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte_ids = np.full(256, -1, np.int64)
    pieces, ids, scores = [], [], []
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append(name.replace("▁", " ").encode())
            ids.append(i)
            scores.append(model.get_score(i))
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback, so texts would not come back whole")
    return Vocabulary(pieces, np.array(ids, np.int64), log_probabilities(np.array(scores, np.float64)), byte_ids, n)


def stream(span: bytes, vocab: Vocabulary) -> list[int]:
    """Viterbi over one span with a window of the longest piece.

    Ids are committed where all surviving backpointer paths meet in one
    boundary, so only the open part of the span is held. Whether they meet is
    looked for when the open part has reached LOOK bytes, and again each time it
    has doubled, so the looking stays in proportion to the span.
    """
    out: list[int] = []
    best: dict[int, tuple[float, int, tuple[int, ...]]] = {0: (0.0, -1, ())}
    done, look = 0, LOOK

    def commit(meet: int) -> None:
        path, q = [], meet
        while q > done:
            path.append(best[q][2])
            q = best[q][1]
        for ids in reversed(path):
            out.extend(ids)

    for p in range(len(span)):
        if p in best:
            here = best[p][0]
            single = False
            width = 1 if span[p] < 0x80 else 2 if span[p] < 0xE0 else 3 if span[p] < 0xF0 else 4
            for q in range(p + 1, min(len(span), p + vocab.longest) + 1):
                known = vocab.lookup.get(span[p:q])
                if known:
                    single |= q == p + width
                    if q not in best or here + known[0] > best[q][0]:
                        best[q] = (here + known[0], p, (known[1],))
            q = p + width
            if not single and (q not in best or here + vocab.unknown > best[q][0]):
                best[q] = (here + vocab.unknown, p, tuple(int(vocab.byte_ids[b]) for b in span[p:q]))
        if p - done < look:
            continue
        # paths that can still grow end after p: follow them back to where they meet
        front = {q for q in range(p + 1, min(len(span), p + vocab.longest + 3) + 1) if q in best}
        while len(front) > 1:
            last = max(front)
            front.discard(last)
            front.add(best[last][1])
            if min(front) <= done:
                break
        meet = front.pop() if len(front) == 1 else done
        if done < meet <= p + 1:
            commit(meet)
            best = {q: x for q, x in best.items() if q >= meet}
            best[meet] = (best[meet][0], -1, ())
            done, look = meet, LOOK
        else:
            look *= 2
    commit(len(span))
    return out


def _side_by_side(spans: np.ndarray, length: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The same lattice for many short spans (rows padded with zeros): flat ids, and their number by span."""
    n, most = spans.shape
    best = np.full((n, most + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, most + 1), np.int16)
    kind = np.full((n, most + 1), -1, np.int64)  # piece id, or -1 for bytes
    for p in range(most):
        rows = np.flatnonzero((length > p) & np.isfinite(best[:, p]))
        if not len(rows):
            continue
        lead = spans[rows, p]
        width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        single = np.zeros(len(rows), bool)
        h = np.zeros(len(rows), np.uint64)
        here, left = best[rows, p], length[rows]
        for q in range(p + 1, min(most, p + vocab.longest) + 1):
            h = h * np.uint64(STEP) + spans[rows, q - 1] + np.uint64(1)
            key = mix(h)
            may = np.flatnonzero(vocab.seen[key >> np.uint64(44)] & (left >= q))
            if not len(may):
                continue
            at = np.minimum(np.searchsorted(vocab.keys, key[may]), len(vocab.keys) - 1)
            true = vocab.keys[at] == key[may]
            may, at = may[true], at[true]
            single[may] |= width[may] == q - p
            score = here[may] + vocab.key_scores[at]
            better = score > best[rows[may], q]
            r = rows[may[better]]
            best[r, q], back[r, q], kind[r, q] = score[better], p, vocab.key_ids[at[better]]
        rest = np.flatnonzero(~single)
        if len(rest):
            q = p + width[rest]
            score = here[rest] + vocab.unknown
            better = score > best[rows[rest], q]
            r, q = rows[rest[better]], q[better]
            best[r, q], back[r, q], kind[r, q] = score[better], p, -1
    out = np.full((n, most), -1, np.int64)
    at, slot = length.astype(np.int64).copy(), np.full(n, most)
    while (open_rows := np.flatnonzero(at > 0)).size:
        end = at[open_rows]
        start = back[open_rows, end].astype(np.int64)
        piece = kind[open_rows, end]
        plain = piece >= 0
        slot[open_rows[plain]] -= 1
        out[open_rows[plain], slot[open_rows[plain]]] = piece[plain]
        raw = np.flatnonzero(~plain)
        for k in range(4):
            more = raw[end[raw] - start[raw] > k]
            r = open_rows[more]
            slot[r] -= 1
            out[r, slot[r]] = vocab.byte_ids[spans[r, end[more] - 1 - k]]
        at[open_rows] = start
    keep = np.arange(most)[None, :] >= slot[:, None]
    return out[keep], most - slot


class Encoder:
    """Encodes chunks of texts; remembers the ids of spans it has met, up to CACHE of them."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self):
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and each text's bounds in them."""
        vocab = self.vocab
        filled = np.diff(offsets) > 0
        text = np.insert(raw, offsets[:-1][filled], 0x20)  # the dummy space before each text
        bounds = np.concatenate([[0], np.cumsum(np.diff(offsets) + filled)])
        if not len(text):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        start = np.zeros(len(text), bool)
        start[bounds[:-1][filled]] = True
        if vocab.space_cuts:
            start[1:] |= (text[1:] == 0x20) & (text[:-1] != 0x20)
        if vocab.newline_cuts:
            start[1:] |= (text[1:] == 0x0A) | (text[:-1] == 0x0A)
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(text))
        keys = word_hashes(text, starts, ends)
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > CACHE:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        new = np.ones(len(unique), bool) if not len(self.keys) else self.keys[at] != unique
        if new.any():
            self._learn(text, unique[new], starts[where[new]], ends[where[new]])
        at = np.searchsorted(self.keys, unique)[inverse]
        count = self.count[at]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = self.flat[np.repeat(self.first[at] - total[:-1], count) + np.arange(total[-1])]
        return flat, total[np.searchsorted(starts, bounds)]

    def _learn(self, text: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        length = ends - starts
        flats, counts, order = [], [], []
        low = 0
        for most in (4, 8, 12, 16, 24, SHORT):
            own = np.flatnonzero((length > low) & (length <= most))
            low = most
            for part in np.array_split(own, max(1, len(own) // 20_000)):
                if len(part):
                    index = starts[part][:, None] + np.arange(most)
                    pad = np.arange(most) >= length[part][:, None]
                    spans = text[np.minimum(index, len(text) - 1)]
                    spans[pad] = 0
                    flat, count = _side_by_side(spans.astype(np.uint64), length[part], self.vocab)
                    flats.append(flat.astype(np.int32))
                    counts.append(count)
                    order.append(part)
        for i in np.flatnonzero(length > SHORT):
            ids = np.array(stream(text[starts[i] : ends[i]].tobytes(), self.vocab), np.int32)
            flats.append(ids)
            counts.append(np.array([len(ids)]))
            order.append(np.array([i]))
        count, order = np.concatenate(counts), np.concatenate(order)
        first = len(self.flat) + np.concatenate([[0], np.cumsum(count)[:-1]])
        self.flat = np.concatenate([self.flat, *flats])
        all_keys = np.concatenate([self.keys, keys[order]])
        sort = np.argsort(all_keys)
        self.keys, self.first, self.count = all_keys[sort], np.concatenate([self.first, first])[sort], np.concatenate([self.count, count])[sort]


def decode_ids(flat: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts and their offsets: pieces joined, without each text's dummy space."""
    size = vocab.raw_len[flat]
    total = np.concatenate([[0], np.cumsum(size)])
    raw = vocab.raw[np.repeat(vocab.raw_at[flat] - total[:-1], size) + np.arange(total[-1])]
    at = total[bounds]
    filled = np.diff(at) > 0
    raw = np.delete(raw, at[:-1][filled])
    return raw, np.concatenate([[0], np.cumsum(np.diff(at) - filled)])


def _again(flat: np.ndarray, bounds: np.ndarray, same: np.ndarray, raw: np.ndarray, offsets: np.ndarray, vocab: Vocabulary):
    """Texts that did not come back (a remembered span with an equal hash) are encoded without memory."""
    own = [flat[s:e] for s, e in zip(bounds, bounds[1:], strict=False)]
    same = same.copy()
    for i in np.flatnonzero(~same):
        text = raw[offsets[i] : offsets[i + 1]].tobytes()
        own[i] = np.array(stream(b" " + text, vocab) if text else [], np.int32)
        same[i] = decode_ids(own[i].astype(np.int64), np.array([0, len(own[i])]), vocab)[0].tobytes() == text
    return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]), same


def encode_texts(docs: DataFrame, model: str = MODEL, verify: bool = True) -> DataFrame:
    """All columns of `docs` with `ids` (array of int) and `round_trip` (decoding the ids gave the whole text back).

    The ids are the likeliest path by piece probabilities (log_probabilities),
    which for a merge model is not always the one its merges give. The lattice
    holds every piece and, for characters that no piece spells, their bytes;
    ties go to the path whose last piece begins earliest. Texts are not
    normalised. Where no piece can cross a boundary all paths meet there, and
    what stands between two such places is one stream: short streams run side by
    side, long ones one by one, in the same window of the longest piece. Null
    and empty texts have no ids and come back empty; very long texts are encoded
    whole. Repeated rows get equal ids; columns named like the new ones are
    replaced; an empty table gives an empty one.
    """
    docs = docs.drop("ids", "round_trip")
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    at = docs.columns.index("text")
    schema = StructType(list(docs.schema.fields)).add("ids", ArrayType(IntegerType())).add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(at)):
                flat, bounds = encoder.encode(raw, offsets)
                same = np.ones(b - a, bool)
                if verify:
                    back, ends = decode_ids(flat, bounds, encoder.vocab)
                    if len(back) != len(raw) or not (back == raw).all():
                        same = np.array([np.array_equal(back[s:e], raw[o:p]) for s, e, o, p in zip(ends, ends[1:], offsets, offsets[1:], strict=False)])
                        flat, bounds, same = _again(flat, bounds, same, raw, offsets, encoder.vocab)
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(same)], names=[*batch.schema.names, "ids", "round_trip"])

    return docs.mapInArrow(run, schema)


def decode_texts(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """All columns with `text` made from `ids`; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    encoded = encoded.drop("text")
    at = encoded.columns.index("ids")
    schema = StructType(list(encoded.schema.fields)).add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            texts = []
            for ids in batch.column(at):
                own = np.array(ids.as_py() or [], np.int64)
                raw, _ = decode_ids(own, np.array([0, len(own)]), vocab)
                texts.append(raw.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return encoded.mapInArrow(run, schema)

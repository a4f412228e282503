"""Each operator against a brute-force version on texts with awkward cases."""

import hashlib
import json
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from placeforge.llm import brown, decontaminate, licenses, merkle, minhash_paths, paragraphs, pieces, quality, queries, runs, sharding, smallworld, suffixes, urls
from placeforge.llm.components import components
from tests.llm import cases

UP = {c: c + 32 for c in range(65, 91)}


def multiset(rows):
    return Counter(json.dumps(list(map(repr, r))) for r in rows)


class Sets:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


# 1
def test_brown_base_and_normalisation(spark):
    data = cases.rows()
    got = brown.score_texts(cases.frame(spark, data), block=4000, core=64, classes=8).collect()
    tokens = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for _, t in data]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data]
    c = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, _), ws, h in zip(data, tokens, held, strict=True)]
    assert multiset(want) == multiset([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got])
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_brown_beats_the_unigram_on_held_out_text(spark):
    r = random.Random(5)
    left, right = cases.vocabulary(1, 60), cases.vocabulary(2, 60)
    data = [(k, " ".join(r.choice(left if j % 2 else right) for j in range(80))) for k in range(400)]
    got = [x for x in brown.score_texts(cases.frame(spark, data), block=20_000).collect() if x.held_out]
    assert sum(x.score for x in got) > sum(x.base_score for x in got) * 0.93


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((10, 10), np.int64)
    for a in range(1, 5):
        for b in range(5, 9):
            pairs[a, b] = pairs[b, a] = 20 + a * b
    group = brown.exchange(pairs, (0, 9), classes=4)
    assert len(set(group[1:5])) == 1 and len(set(group[5:9])) == 1 and group[1] != group[5] and group[0] == 0 and group[9] == 1 and min(group[1:9]) == 2


def brute_scores(data, core, classes):
    """The class model by plain counting: core words by exchange, other words by all their neighbours, transitions, emissions."""
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for _, t in data]
    learn = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in data]
    train = [ws for ws, use in zip(tokens, learn, strict=True) if use]
    c = Counter(w for ws in train for w in ws)
    number = {w: 1 if w is None else int(brown.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in {w for ws in tokens for w in ws}}
    signed = lambda w: number[w] - (1 << 64) if number[w] >> 63 else number[w]
    top = {*sorted(c, key=lambda w: (-c[w], signed(w)))[:core], None}
    order = sorted(top, key=number.get)
    at = {w: k for k, w in enumerate(order)}
    pairs = np.zeros((len(order) + 1, len(order) + 1), np.int64)
    for ws in train:
        for a, b in zip([None, *ws], ws, strict=False):
            pairs[at.get(a, len(order)), at.get(b, len(order))] += 1
    group = brown.exchange(pairs, (at[None], len(order)), classes)
    k = group.max() + 1
    cls = {w: int(group[n]) for w, n in at.items()}
    table = np.zeros((k, k))
    for a in range(len(pairs)):
        for b in range(len(pairs)):
            table[group[a], group[b]] += pairs[a, b]
    share = (table.sum(0) + 1) / (table.sum() + k)
    logp = np.log((table + brown.ALPHA * share) / (table.sum(1, keepdims=True) + brown.ALPHA)) - np.log(share)
    near = defaultdict(lambda: np.zeros(k))
    for ws in train:
        full = [None, *ws]
        for n, w in enumerate(full[1:], 1):
            if w not in cls:
                near[w] += logp[cls.get(full[n - 1], 1)]
                near[w] += logp[:, cls.get(full[n + 1], 1)]
    for w, total in near.items():
        total[:2] = -np.inf
        cls[w] = int(total.argmax())
    mass = np.zeros(k)
    for w, n in c.items():
        mass[cls[w]] += n
    moves, unseen, seen = np.zeros((k + 1, k + 1)), np.zeros(k + 1), np.zeros(k + 1)
    for ws in train:
        for a, b in zip([None, *ws], ws, strict=False):
            for row in [cls[a], k] if c[a] == 1 and (a is not None) else [cls[a]]:
                moves[row, cls[b]] += 1
                unseen[row] += c[b] == 1
                seen[row] += 1
    share = (mass + 1e-3) / (mass.sum() + 1e-3 * k)
    given = (moves[:, :k] + brown.ALPHA * share) / (moves[:, :k].sum(1, keepdims=True) + brown.ALPHA)
    rare = (unseen.sum() + 1) / (seen.sum() + 2)
    new = (unseen + brown.ALPHA * rare) / (seen + brown.ALPHA)
    out = []
    for ws in tokens:
        score = 0.0
        for a, b in zip([None, *ws], ws, strict=False):
            row = cls[a] if c[a] else k
            score += math.log10(given[row, cls[b]] * (1 - new[row])) + math.log10(c[b] / mass[cls[b]]) if c[b] else math.log10(new[row])
        out.append(score)
    return out


def test_brown_scores_by_brute_force_and_whatever_the_layout(spark):
    data = cases.rows(n=40)
    want = brute_scores(data, 64, 8)
    exact = Counter((i, round(x, 6)) for (i, _), x in zip(data, want, strict=True))
    for parts, block, bucket in ((1, 1 << 20, 400_000), (16, 3000, 500), (3, 9000, 50)):
        got = brown.score_texts(cases.frame(spark, data).repartition(parts), block=block, core=64, classes=8, bucket=bucket).collect()
        assert exact == Counter((r.doc_id, round(r.score, 6)) for r in got), (parts, block)


# 2
def brute_repeats(data, length):
    raw = [(t or "").encode() for _, t in data]
    count = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(data, raw, strict=True):
        mark = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                mark[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        out.append((i, len(b), int(mark.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~mark])).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "group"), [(60, 512), (60, 1), (400, 512)])
def test_repeats(spark, length, group):
    data = cases.rows()
    frame = cases.frame(spark, data).withColumnRenamed("key", "uid").withColumnRenamed("node", "runs")
    found = suffixes.remove_repeats(frame, length=length, group=group)
    assert found.columns == [c for c in frame.columns if c not in ("kept", "spans")] + ["kept", "spans"]
    got = found.collect()
    assert {(r.uid, r.runs) for r in got} == {("k", 1)}
    mine = [(r.doc_id, len((r.text or "").encode()), len((r.text or "").encode()) - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert multiset(mine) == multiset(brute_repeats(data, length))


def test_repeats_around_one_common_passage(spark):
    r, ws = random.Random(14), cases.vocabulary()
    passage = cases.prose(r, ws, 60)
    tails = [cases.prose(r, ws, 40) for _ in range(300)]
    data = [(k, f"{cases.prose(r, ws, 30)} {passage} {tails[k % 300] if k % 7 == 0 else cases.prose(r, ws, 30)}") for k in range(2000)]
    assert len(passage.encode()) > 130
    got = suffixes.remove_repeats(cases.frame(spark, data), length=400).collect()
    mine = [(x.doc_id, len(x.text.encode()), len(x.text.encode()) - len(x.kept), len(x.spans), hashlib.sha256(x.kept).hexdigest()) for x in got]
    want = brute_repeats(data, 400)
    assert multiset(mine) == multiset(want) and any(x[2] for x in want)


def test_repeats_of_one_row_that_stands_often(spark):
    r, ws = random.Random(15), cases.vocabulary()
    one = cases.prose(r, ws, 300)
    data = [(1, one)] * 5000 + [(2, "x" + one[100:900]), (3, cases.prose(r, ws, 300))]
    got = suffixes.remove_repeats(cases.frame(spark, data), length=400).collect()
    by = defaultdict(set)
    for x in got:
        by[x.doc_id].add((len(x.kept), len(x.spans)))
    assert len(got) == 5002 and by == {1: {(0, 1)}, 2: {(1, 1)}, 3: {(len(data[-1][1].encode()), 0)}}


def brute_passages(data, count):
    spots = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in data]
    tokens = [[(t or "").encode()[a:b] for a, b in w] for (_, t), w in zip(data, spots, strict=True)]
    times = Counter(tuple(w[k : k + count]) for w in tokens for k in range(len(w) - count + 1))
    out = []
    for (i, t), w, at in zip(data, tokens, spots, strict=True):
        joined = []
        for k in range(len(w) - count + 1):
            if times[tuple(w[k : k + count])] > 1:
                if joined and at[k][0] < joined[-1][1]:
                    joined[-1][1] = at[k + count - 1][1]
                else:
                    joined.append([at[k][0], at[k + count - 1][1]])
        out.append((i, t, tuple(map(tuple, joined))))
    return out


@pytest.mark.parametrize(("count", "group"), [(12, 512), (12, 1), (51, 512)])
def test_reported_passages(spark, count, group):
    data = cases.rows()
    r, ws = random.Random(16), cases.vocabulary()
    shared = [cases.prose(r, ws, n) for n in (51, 52, 13, 12, 11)]
    data += [(1000 + k, f"{cases.prose(r, ws, 20)}\n{shared[k % 5]} {cases.prose(r, ws, 30)} {shared[k % 3]}") for k in range(30)]
    data += [(2000, shared[0].replace(" ", " \t ")), (2001, "a b " * 60), (2002, "z"), (2003, " ".join(["one"] * 52))]
    got = suffixes.remove_repeats(cases.frame(spark, data).withColumnRenamed("key", "passages"), length=400, group=group, report_words=count)
    assert got.columns[-3:] == ["kept", "spans", "passages"] and got.columns.count("passages") == 1
    got = got.collect()
    want = brute_passages(data, count)
    assert multiset((x.doc_id, x.text, tuple(map(tuple, x.passages))) for x in got) == multiset(want) and sum(bool(x[2]) for x in want) > 30
    mine = [(x.doc_id, len((x.text or "").encode()), len((x.text or "").encode()) - len(x.kept), len(x.spans), hashlib.sha256(x.kept).hexdigest()) for x in got]
    assert multiset(mine) == multiset(brute_repeats(data, 400))


def test_repeats_query_shows_passages_shorter_than_its_strings(spark, tmp_path):
    r, ws = random.Random(17), cases.vocabulary()
    passage = cases.prose(r, ws, 52)
    while len(passage.encode()) >= 390:
        passage = cases.prose(r, [w for w in ws if len(w) < 7], 52)
    data = [(k, f"{cases.prose(r, ws, 90)} {passage if k < 2 else cases.prose(r, ws, 52)} {cases.prose(r, ws, 90)}") for k in range(9)]
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in queries.op2_suffixes(spark, str(tmp_path)).collect()}
    assert all((x.n_removed, x.n_spans) == (0, 0) for x in got.values())
    assert {i: (x.n_passages, x.passage_bytes) for i, x in got.items()} == {i: (1, len(passage.strip().encode())) if i < 2 else (0, 0) for i in range(9)}


def test_expansion_matches_sorted_suffixes():
    r = random.Random(2)
    for _ in range(20):
        text = np.array([r.choice(b"ab") for _ in range(200)] + [255], np.uint8)
        length = r.randint(1, 12)
        order, joined = suffixes.long_prefixes(text, length)
        raw = text.tobytes()
        for k in range(1, len(raw)):
            a, b = raw[order[k - 1] :][:length], raw[order[k] :][:length]
            assert a <= b and joined[k] == (a == b and len(a) == length), (k, a, b)


# 3
def brute_labels(words):
    """Labels and the best share of each template, by diagonals over plain lists."""
    labels, best = set(), 0.0
    for phrase, label in [*licenses.BASE, *licenses.NAMES, *licenses.NOTICES]:
        own = phrase.split()
        k = licenses.LONG_GRAM if len(own) >= licenses.LONG_WORDS else 2
        place = defaultdict(list)
        for i in range(len(own) - k + 1):
            place[tuple(own[i : i + k])].append(i)
        diagonals = defaultdict(set)
        for pos in range(len(words) - k + 1):
            for at in place.get(tuple(words[pos : pos + k]), []):
                diagonals[pos - at].add(at)
        grams = len(own) - k + 1
        shares = [1.0 for at in diagonals.values() if len(at) == grams]
        if len(own) >= licenses.LONG_WORDS:
            chain, last = set(), None
            for d in sorted(d for d, at in diagonals.items() if len(at) < grams):
                chain = diagonals[d] | (chain if last is not None and d - last <= licenses.DRIFT else set())
                last = d
                if len(chain) / grams >= licenses.COVER:
                    shares.append(len(chain) / grams)
        if shares:
            labels.add(label)
            best = max(best, *shares)
    return ",".join(sorted(labels)), best


def test_licenses(spark):
    r, words = random.Random(4), cases.vocabulary()
    data = cases.rows() + [
        (1, "Released under the MIT License.\nCC-BY cc by; gnu general public license"),
        (2, "mit\u00e9 license apache License x APACHE license"),
        (3, "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files"),
        (4, "mit\x00license"), (5, "MITLicense"), (6, "License mit license mit license"),
    ]
    for k, (phrase, _) in enumerate(licenses.NOTICES):
        own = phrase.upper().split()
        data += [(30100 + k, f"{cases.prose(r, words, 20)} {' / '.join(own)} {cases.prose(r, words, 20)}"), (30200 + k, " ".join(own[: len(own) // 2]))]
        for j in range(3):  # words changed, left out and put in
            some = own[:]
            for _ in range(1 + j * len(own) // 25):
                at = r.randrange(len(some))
                some[at : at + r.randint(0, 2)] = r.choice([["x"], [], ["y", "z"]])
            data.append((31000 + 10 * k + j, cases.prose(r, words, 30) + " " + " ".join(some)))
    got = licenses.scan_licenses(cases.frame(spark, data)).collect()
    want = []
    for i, t in data:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
        places = [(k, label) for phrase, label in licenses.BASE for p in [phrase.split()] for k in range(len(w)) if w[k : k + len(p)] == p]
        at = [k for k, _ in places]
        labels, best = brute_labels(w)
        want.append((i, len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), labels, round(best, 9)))
    assert multiset(want) == multiset([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in got])
    by = {r.doc_id: r for r in got}
    assert by[3].labels == "mit" and by[3].n_base == 0 and 0.7 <= by[3].score < 1
    assert all(by[30100 + k].score == 1 and label in by[30100 + k].labels.split(",") for k, (_, label) in enumerate(licenses.NOTICES))
    assert any(0.7 <= r.score < 1 for r in got if (r.doc_id or 0) >= 31000)


# 4
def best_path(text, vocab):
    raw = (" " + text).encode() if text else b""
    best = [(0.0, 0, ())] + [None] * len(raw)
    for p in range(len(raw)):
        if best[p] is None:
            continue
        width = 1 if raw[p] < 0x80 else 2 if raw[p] < 0xE0 else 3 if raw[p] < 0xF0 else 4
        single = False
        for q in range(p + 1, min(len(raw), p + vocab.longest) + 1):
            if raw[p:q] in vocab.lookup:
                single |= q == p + width
                s, i = vocab.lookup[raw[p:q]]
                if best[q] is None or best[p][0] + s > best[q][0]:
                    best[q] = (best[p][0] + s, p, (i,))
        if not single and (best[p + width] is None or best[p][0] + vocab.unknown > best[p + width][0]):
            best[p + width] = (best[p][0] + vocab.unknown, p, tuple(int(vocab.byte_ids[b]) for b in raw[p : p + width]))
    out, q = [], len(raw)
    while q:
        out = list(best[q][2]) + out
        q = best[q][1]
    return out


def test_pieces_round_trip_and_best_paths(spark):
    data = cases.rows()
    got = pieces.encode_texts(cases.frame(spark, data)).collect()
    vocab = pieces.load_vocabulary()
    assert len(got) == len(data)
    for r in got:
        text = r.text or ""
        assert r.round_trip
        assert pieces.stream((" " + text).encode() if text else b"", vocab) == r.ids
    back = pieces.decode_texts(spark.createDataFrame([(r.doc_id, r.ids) for r in got], "doc_id long, ids array<int>"))
    assert multiset((r.doc_id, r.text) for r in back.collect()) == multiset((r.doc_id, r.text or "") for r in got)


def unigram_library(vocab):
    """The library as a unigram model with the operator's probabilities."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    score = {int(i): float(s) for i, s in zip(vocab.ids, vocab.scores, strict=True)}
    for i, piece in enumerate(model.pieces):
        if i in score:
            piece.score = score[i]
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_pieces_equal_the_library_and_an_independent_lattice(spark):
    vocab = pieces.load_vocabulary()
    library = unigram_library(vocab)
    r = random.Random(8)
    data = [t for _, t in cases.rows() if t]
    data += ["The house is red, and internationalisation of Stra\u00dfenbahn-Fahrpl\u00e4ne querelle 12345 don't W\u00f6rter", "\u6771\u4eac\u90fd\u306b\u4f4f\u3093\u3067\u3044\u307e\u3059" * 20, "".join(r.choice("abcdefgh\u00e9\u20ac\U0001f600") for _ in range(3000))]
    got = pieces.encode_texts(spark.createDataFrame([(k, t) for k, t in enumerate(data)], "doc_id int, text string")).collect()
    plain = 0
    for x in got:
        assert x.round_trip
        assert x.ids == best_path(x.text, vocab), x.doc_id
        if "\t" not in x.text and "\n" not in x.text and "  " not in x.text and x.text == x.text.strip() and "\u2581" not in x.text:
            plain += 1
            ours, theirs = (sum(score_of(vocab, i) for i in ids) for ids in (x.ids, library.encode(x.text)))
            assert x.ids == library.encode(x.text) or ours == pytest.approx(theirs, rel=1e-5), x.doc_id
    assert plain >= 5
    words = ["the", "house", "is", "and", "time"]
    assert all(len(pieces.stream(b" " + w.encode(), vocab)) == 1 for w in words)


def score_of(vocab, i):
    at = np.flatnonzero(vocab.ids == i)
    return float(vocab.scores[at[0]]) if len(at) else vocab.unknown


# 5
def test_urls(spark):
    table = [
        (1, "http://a.org/x?q#f"), (2, "https://WWW.Example.ORG/es/1"), (3, "https://example.org/en/1"), (4, "x://example.org/en/2"),
        (5, "http://b.com/fr/"), (6, "http://b.com/de/9"), (7, "http://notorg/fr"), (8, None), (9, "mailto:x"), (10, ""), (11, "http://a.org"),
        (12, "http://a.org?x=://y/z"), (13, "http://borg/"), (14, "http://com/de/"), (15, "a://b://c.org/d"), (6, "http://b.com/de/9"), (None, "http://q.net/de/7"),
    ]
    frame = spark.createDataFrame([(i, u, "h", "t", "p") for i, u in table], "page_id long, url string, host string, template string, html string")
    got = urls.judge_urls(frame).collect()

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(UP)
        fits = [(len(r), r, v) for v, r in urls.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return host, path, *(max(fits)[1:] if fits else (None, None))

    assert len(got) == len(table)
    assert multiset((i, *judge(u)[:3]) for i, u in table) == multiset((r.page_id, r.host, r.path, r.rule) for r in got)
    for r in got:
        want = judge(dict(table)[r.page_id])[3]
        assert r.verdict in ("allow", "block") and (want is None or r.verdict == want)


def test_urls_block_what_labels_say(spark):
    table = [(k, f"http://s{k % 5}.com/de/{k}") for k in range(60)] + [(100 + k, f"http://s{k % 5}.com/fr/{k}") for k in range(60)] + [(200, "http://n.net/de/5"), (201, "http://n.net/fr/5")]
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(table, "page_id long, url string")).collect()}
    assert got[200] == "block" and got[201] == "allow"


# 6
def words_of(raw):
    """(start, end, word) of the words of a text, lower-cased."""
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]


def brute_paragraphs(raw, starts):
    """Lines of LEAST or more words, and the runs that begin at `starts` (taken from the operator: content picks them)."""
    found, out = words_of(raw), []
    line = {}
    for k, (s, _, _) in enumerate(found):
        line.setdefault(raw.count(b"\n", 0, s), []).append(k)
    out += [(ks[0], ks[-1] + 1, True) for ks in line.values() if len(ks) >= paragraphs.LEAST]
    out += [(k, k + paragraphs.LEAST, False) for k in starts]
    return [(found[a][0], found[b - 1][1], [w for _, _, w in found[a:b]], line_) for a, b, line_ in sorted(out)]


def brute_spans(data):
    units = []
    for i, t in {(i, t) for i, t in data if i is not None}:
        raw = (t or "").encode()
        _, at, _, kind, *_ = paragraphs.paragraphs_of(paragraphs.LOWER[np.frombuffer(raw, np.uint8)], np.array([0, len(raw)]))
        units += [(i, t or "", s, e, tuple(w), line) for s, e, w, line in brute_paragraphs(raw, [int(a) for a, k in zip(at, kind, strict=True) if k == 0])]
    units.sort(key=lambda u: u[:4])
    sets, shingles = Sets(), [set(zip(*(u[4][k:] for k in range(5)), strict=False)) for u in units]
    for x, u in enumerate(units):
        for y in range(x):
            v = units[y]
            if u[4] == v[4] or (u[5] and v[5] and 100 * len(shingles[x] & shingles[y]) >= 80 * len(shingles[x] | shingles[y])):
                sets.join(x, y)
    gone = defaultdict(list)
    for x, u in enumerate(units):
        first = units[sets.root(x)]
        if u[:2] != first[:2] or u[2] >= first[3]:
            gone[u[:2]].append(u[2:4])
    out = {}
    for key, spans in gone.items():
        merged = []
        for s, e in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out[key] = merged
    return out


def test_paragraphs(spark):
    data = cases.rows()
    r, vocabulary = random.Random(14), cases.vocabulary()
    base = [[r.choice(vocabulary) for _ in range(60)] for _ in range(5)]
    for k in range(30):  # lines of one word changed, within other lines
        own = base[k % 5][:]
        own[r.randrange(60)] = "changed"
        data.append((9000 + k, cases.prose(r, vocabulary, 9) + "\n" + " ".join(own) + "\n" + cases.prose(r, vocabulary, 30)))
    got = paragraphs.duplicate_paragraphs(cases.frame(spark, data)).collect()
    want = brute_spans(data)
    assert multiset((i, want.get((i, t or ""), [])) for i, t in data) == multiset((r.doc_id, [[s.s, s.e] for s in r.spans]) for r in got)
    assert all(r.removed_bytes == sum(s.e - s.s for s in r.spans) and (r.n_removed > 0) == bool(r.spans) for r in got)
    kept = paragraphs.remove_paragraphs(cases.frame(spark, data).withColumnRenamed("key", "removed").withColumnRenamed("node", "_id")).collect()
    assert len(kept) == len(data) and "removed" in kept[0].asDict() and "_id" in kept[0].asDict()

    def cut(i, t):
        raw, out, place = (t or "").encode(), b"", 0
        for s, e in want.get((i, t or ""), []):
            out, place = out + raw[place:s], e
        return (out + raw[place:]).decode()

    assert multiset((i, cut(i, t)) for i, t in data) == multiset((x.doc_id, x.text) for x in kept)


@pytest.mark.parametrize("layout", ["one line", "own line", "many lines", "start", "end"])
def test_paragraphs_find_passages_wherever_they_stand(spark, layout):
    r, vocabulary = random.Random(12), cases.vocabulary(3)
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    data, passages = [], []
    for k in range(30):
        passage = line(51 + k % 10)
        if layout == "many lines":
            passage = "\n".join(" ".join(passage.split(" ")[n : n + 9]) for n in range(0, 99, 9)).strip()
        passages.append(passage)
        mark = "\n" if layout == "own line" else " "
        for j in (0, 1):
            before, after = ("" if layout == "start" else line(r.randint(20, 200)) + mark), ("" if layout == "end" else mark + line(r.randint(20, 200)))
            data.append((2 * k + j, before + passage + after))
    got = {x.doc_id: x for x in paragraphs.duplicate_paragraphs(cases.frame(spark, data)).collect()}
    for k, passage in enumerate(passages):
        assert got[2 * k].n_removed == 0 and got[2 * k + 1].n_removed > 0, k
        raw = data[2 * k + 1][1].encode()
        at = raw.index(passage.encode())
        assert all(at <= s.s and s.e <= at + len(passage.encode()) for s in got[2 * k + 1].spans)
        assert sum(len(raw[s.s : s.e].split()) for s in got[2 * k + 1].spans) >= paragraphs.LEAST


def test_paragraphs_leave_short_common_lines(spark):
    r, vocabulary = random.Random(2), cases.vocabulary(3)
    common = " ".join(r.choice(vocabulary) for _ in range(13)) + "."
    data = [(k, "\n".join([cases.prose(r, vocabulary, 40), common, cases.prose(r, vocabulary, 40)])) for k in range(60)]
    assert all(x.n_removed == 0 for x in paragraphs.duplicate_paragraphs(cases.frame(spark, data)).collect())


# 7
def brute_links(table, cosine):
    good = {}
    for i, v, label in table:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, np.float32).astype(float))
    n, sets = Counter(), Sets()
    for a in good:
        for b in good:
            if a != b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]):
                x, y = good[a][1], good[b][1]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    n[a] += 1
                    sets.join(a, b)
    return [(i, n[i] if i is not None else 0, sets.root(i) if i is not None else None) for i, _, _ in table]


@pytest.mark.parametrize("shard", [4096, 60])
def test_vectors(spark, shard):
    r = np.random.default_rng(4)
    base = r.normal(size=(12, 16))
    table = []
    for k in range(400):
        v = base[k % 12] + r.normal(size=16) * [0.05, 0.2, 0.5, 2][k % 4]
        table.append((k, v.astype(np.float32).tolist(), int(k % 12 % 2)))
    table += [(500, table[0][1], 0), (501, table[0][1], 1), (502, None, 0), (503, [0.0] * 16, 0), (504, [float("nan")] * 16, 0), (505, table[0][1], None), (506, [None] * 16, 0), (507, [1.0, 2.0], 0), (508, [], 0), (509, [float("inf")] * 16, 0), (None, table[0][1], 0), table[0]]
    frame = spark.createDataFrame([(*t, 9.0, "x") for t in table], "vec_id long, embedding array<float>, label int, n double, rep string")
    got = smallworld.near_vectors(frame, cosine=0.93, shard=shard, block=50).collect()
    assert multiset(brute_links(table, 0.93)) == multiset((r.vec_id, r.n_links, r.component_id) for r in got)
    assert all(r.kept == (r.component_id == r.vec_id) for r in got if r.vec_id is not None)


def test_vectors_are_judged_in_their_own_precision(spark):
    r = np.random.default_rng(11)
    table = []
    for k in range(0, 200, 2):  # pairs whose cosine is a few 1e-9 over or under the bound
        a = r.normal(size=12)
        b = r.normal(size=12)
        a, b = a / np.linalg.norm(a), b - (b @ a) / (a @ a) * a
        cos = 0.93 + (2e-9 if k % 4 else -2e-9)
        table += [(k, a.tolist(), k), (k + 1, (cos * a + math.sqrt(1 - cos * cos) * b / np.linalg.norm(b)).tolist(), k)]
    got = smallworld.near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>, label int"), cosine=0.93).collect()
    assert all(x.n_links == (1 if (x.vec_id // 2 * 2) % 4 else 0) for x in got) and len(got) == 200


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
def test_recall_on_all_vectors_of_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = vectors.collect()
    want, x = {}, np.array([t.embedding for t in table], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([t.label for t in table])
    near = (x @ x.T >= 0.4) & (same[:, None] == same[None, :])  # the table holds no pair of 0.93
    for t, n in zip(table, near.sum(1) - 1, strict=True):
        want[t.vec_id] = int(n)
    got = {t.vec_id: t.n_links for t in smallworld.near_vectors(vectors, cosine=0.4, shard=100, block=64).collect()}
    assert sum(want.values()) > 100 and sum(got.values()) >= 0.9 * sum(want.values()) and all(got[k] <= want[k] for k in want)


def test_audits_of_vectors_without_links_see_misses():
    r = np.random.default_rng(3)
    x = r.normal(size=(900, 48)).astype(np.float32)
    graph = smallworld.Graph(smallworld._unit(x)).build(np.arange(900))
    beams, search = [], graph.search
    graph.search = lambda q, beam, near: beams.append(beam) or search(q, beam, near)
    graph.layers[-1][1][:] = -1  # a graph that reaches nothing
    assert all(len(f) == 0 for f in smallworld.linked(graph, x, r.normal(size=(30, 48)).astype(np.float32), 0.93))
    assert max(beams) == 900


def test_graph_recall():
    r = np.random.default_rng(1)
    x = smallworld._unit(r.normal(size=(3000, 24)) + 3 * r.normal(size=(40, 24))[r.integers(0, 40, 3000)])
    graph = smallworld.Graph(x).build(np.arange(3000))
    truth = x[:200] @ x.T >= 0.93
    found, _, _ = graph.search(x[:200], 64, 0.93)
    assert sum(len(f) for f in found) >= 0.9 * truth.sum()


# 8
def test_leaks(spark):
    r, words = random.Random(8), cases.vocabulary(7)
    items = [(k, cases.prose(r, words, r.randint(12, 60))) for k in range(12)] + [(50, None), (51, ""), (52, "short"), (None, "an item without an id of some length")]
    data = cases.rows()
    edited = list(items[1][1])
    for k in range(20, len(edited), 40):
        edited[k] = "#"
    data += [(1, "pre " + items[0][1] + " post"), (2, items[0][1].upper().replace(" ", "\n")), (3, "so " + "".join(edited)), (4, items[2][1][: len(items[2][1]) // 4]), (5, items[3][1] + " " + items[4][1])]
    frame = cases.frame(spark, data).withColumnRenamed("key", "leaks")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame, table).collect()
    found = defaultdict(set)
    for x in got:
        found[x.doc_id] |= {h.item_id for h in x.leaks}
    assert found[1] == {0} and found[2] == {0} and found[3] == {1} and found[4] == set() and found[5] == {3, 4}
    assert all(not x.leaks for x in got if x.doc_id not in (1, 2, 3, 5))
    many = decontaminate.find_leaks(frame, table, index_bytes=300).collect()
    assert multiset((x.doc_id, sorted(h.item_id for h in x.leaks)) for x in many) == multiset((x.doc_id, sorted(h.item_id for h in x.leaks)) for x in got)


def test_leaks_of_edited_excerpts_of_longer_items():
    r, vocabulary = random.Random(21), cases.vocabulary(7)
    texts = [" ".join(r.choice(vocabulary) for _ in range(80)).encode()[:300] for _ in range(8)]
    index = decontaminate.Index(list(enumerate(texts)))

    def found(excerpt):
        before, after = ("~" * 200 + " ").encode(), (" " + "~" * 200).encode()
        raw = np.frombuffer(before + excerpt + after, np.uint8)
        return [h["item_id"] for h in index.leaks(raw, np.array([0, len(raw)]))[0]]

    early = bytearray(texts[0][50:170])
    early[9] = early[19] = ord("#")
    assert found(bytes(early)) == [0]
    for n in range(160):
        k, edits = n % 8, 1 + n // 8 % 8
        first = r.randint(0, len(texts[k]) - 120)
        own = [bytes([x]) for x in texts[k][first : first + 120]]
        for at in r.sample(range(120), edits):
            own[at] = r.choice([b"#", b"", own[at] + b"#"])
        assert found(b"".join(own)) == [k], (n, k, edits, first)
    for k in range(8):
        own = bytearray(texts[k][60:180])
        own[3::8] = b"#" * len(own[3::8])
        assert found(bytes(own)) == []


def semi_global(pattern, text):
    """The least edits that turn the pattern into any part of the text."""
    row = np.zeros(len(text) + 1, np.int32)
    place = np.arange(len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        row = np.minimum.accumulate(new - place) + place
    return int(row.min())


def test_leaks_by_brute_force(spark):
    r, words = random.Random(31), cases.vocabulary(7)
    items = [(k, " ".join(r.choice(words) for _ in range(n))) for k, n in enumerate((30, 22, 9, 4, 3))]
    data = []
    for n in range(70):
        k, edits = n % 5, n // 5
        raw = bytearray(items[k][1].encode())
        if len(raw) > 130:
            first = r.randint(0, len(raw) - 125)
            raw = raw[first : first + 125]
        for _ in range(edits):
            at = r.randrange(len(raw))
            raw[at : at + 1] = r.choice([b"#", b"", bytes([raw[at]]) + b"#"])
        data.append((n, cases.prose(r, words, 5) + " " + raw.decode("utf-8", "replace") + " " + cases.prose(r, words, 5)))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = {x.doc_id: {h.item_id for h in x.leaks} for x in decontaminate.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    hits = 0
    for i, text in data:
        folded = decontaminate.FOLD[np.frombuffer(text.encode(), np.uint8)]
        want = set()
        for k, item in items:
            own = decontaminate.FOLD[np.frombuffer(item.encode(), np.uint8)]
            if len(own) < decontaminate.Q:
                continue
            window, edits, _ = decontaminate.budget(len(own))
            if any(semi_global(own[at : at + window], folded) <= edits for at in range(len(own) - window + 1)):
                want.add(k)
        hits += len(want)
        assert got[i] == want, (i, got[i], want)
    assert 25 < hits < 70


def test_banded_alignment_is_the_edit_distance():
    r = random.Random(3)
    for _ in range(60):
        a = [r.choice(b"abc") for _ in range(r.randint(5, 12))]
        b = [r.choice(b"abc") for _ in range(r.randint(5, 14))]
        row = [0] * (len(b) + 1)
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
            row = new
        got = decontaminate.banded(np.array(a, np.uint8), np.array(b, np.uint8), 0, 20, 0, 30)
        assert got is not None and got[2] == min(row)


# 9
def test_quality_learns_and_scores_all(spark):
    r, words = random.Random(9), cases.vocabulary()
    data = [(k, cases.prose(r, words, 60) if k % 2 else " | ".join([r.choice(words)] * 40)) for k in range(300)] + [(900, None), (901, ""), (None, "x y")]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)] + [(3, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    frame = cases.frame(spark, data).withColumnRenamed("key", "quality_score")
    forest = quality.fit(frame, labels, trees=20)
    got = quality.score_quality(frame, forest).collect()
    assert len(got) == len(data)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 300 and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert sum((x.quality_score >= 0.5) == x.doc_id % 2 for x in held) >= 0.95 * len(held)
    assert all(0 <= x.quality_score <= 1 and x.quality_ok == (x.quality_score >= 0.3) for x in got)
    none = quality.fit(frame, labels.where("false"))
    assert {x.quality_score for x in quality.score_quality(frame, none).collect()} == {0.5}


def brute_statistics(text):
    raw = text.encode()
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = [x for x in raw.split(b"\n") if x]
    n, size = max(len(w), 1), max(len(raw), 1)
    share = lambda signs: sum(b in signs for b in raw) / size
    symbols = b"#$%&*@~^_=+<>\\{}[]"
    counts, pairs = Counter(w), set(zip(w, w[1:], strict=False))
    p = [c / size for c in Counter(raw).values()]
    return [
        math.log1p(len(raw)), math.log1p(len(w)), sum(map(len, w)) / n, share(range(65, 91)), share(range(48, 58)), share(symbols), share(b".,;:"), share(b"|"), share(b"\n"), share(range(128, 256)),
        len(counts) / n, (len(pairs) if len(w) > 1 else min(len(w), 1)) / max(len(w) - 1, 1), max(counts.values(), default=0) / n, sum(a == b for a, b in zip(w, w[1:], strict=False)) / n,
        math.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), len(w) / max(len(lines), 1), sum(len(x) > 14 for x in w) / n, sum(len(x) < 4 for x in w) / n,
        sum(x[-1] in symbols + b"|" for x in w) / n, sum(x[-1] in b".,;:!?" for x in w) / n, sum(65 <= x[0] <= 90 for x in w) / n, share(b"!?"), -sum(x * math.log2(x) for x in p),
    ]


def test_statistics_by_brute_force():
    texts = [t or "" for _, t in cases.rows()] + ["same", "same word word", "word", "A|B #x! 12\n\n12", "a\na\nb"]
    raw = [t.encode() for t in texts]
    got = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    assert got.shape[1] == len(quality.FEATURES)
    for text, row in zip(texts, got, strict=True):
        assert np.allclose(row, brute_statistics(text), rtol=1e-4, atol=1e-6), (text[:60], dict(zip(quality.FEATURES, zip(row, brute_statistics(text), strict=True), strict=True)))


def test_forest_arrays_equal_a_walk():
    r = np.random.default_rng(0)
    x = r.normal(size=(500, 5)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    forest = quality.boost(x, y, trees=15, depth=4)

    def walk(row):
        total = forest.prior
        for k in forest.roots:
            while forest.feature[k] >= 0:
                k = forest.left[k] + (row[forest.feature[k]] > forest.threshold[k])
            total += forest.value[k]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(forest.score(x), [walk(row) for row in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9


# 10
def brute_groups(data, size):
    sets, full = Sets(), {}
    for i, t in data:
        if i is not None:
            full.setdefault((i, t or ""), minhash_paths.shingle_set(t, size))
    keys = sorted(full)
    for x in range(len(keys)):
        for y in range(x):
            a, b = full[keys[x]], full[keys[y]]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                sets.join(keys[x], keys[y])
    return [(i, len(minhash_paths.shingle_set(t, size)), sets.root((i, t or ""))[0] if i is not None else None, i is None or sets.root((i, t or ""))[0] == i) for i, t in data]


def crowd(seed, n, most):
    """Near copies of one text with up to `most` of its words changed: many at the edge of the threshold."""
    r, words = random.Random(seed), cases.vocabulary(11)
    base = [r.choice(words) for _ in range(90)]
    out = []
    for _ in range(n):
        own = base[:]
        for k in r.sample(range(90), r.randint(0, most)):
            own[k] = r.choice(words)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("size", "leaf", "unit"), [(2, 1024, 1024), (2, 8, 32), (5, 1024, 1024)])
def test_near_duplicates(spark, size, leaf, unit):
    data = cases.rows()
    data += [(5000 + k, t) for k, t in enumerate(crowd(1, 120, 14))]
    data += [(data[0][0], "another text of the same id " + data[5][1]), (data[0][0], None)]
    got = minhash_paths.near_duplicates(cases.frame(spark, data), size=size, leaf=leaf, unit=unit).collect()
    assert multiset(brute_groups(data, size)) == multiset((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def test_near_duplicates_at_the_threshold(spark):
    texts = crowd(5, 300, 11)
    full = [minhash_paths.shingle_set(t, 2) for t in texts]
    sims = [len(a & b) / len(a | b) for x, a in enumerate(full) for b in full[:x]]
    assert sum(0.78 <= s <= 0.82 for s in sims) > 1000
    data = list(enumerate(texts))
    for leaf, unit in ((1024, 1024), (16, 64)):
        got = minhash_paths.near_duplicates(cases.frame(spark, data), size=2, leaf=leaf, unit=unit).collect()
        assert multiset(brute_groups(data, 2)) == multiset((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def test_trees_reach_the_recall():
    for threshold in (0.8, 0.9):
        assert (1 - minhash_paths.tree_recall(threshold)) ** minhash_paths.trees_for(threshold) <= 1 - minhash_paths.RECALL
    assert 0.74 < minhash_paths.tree_recall(0.8) < 0.76


def test_shared_counts_and_forest():
    r = random.Random(3)
    sets = [np.unique(np.array([r.randrange(40 + 400 * (k % 2)) for _ in range(r.randint(0, 60))], np.uint64)) for k in range(50)]
    got = minhash_paths.shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(50) for j in range(50) if i != j)
    near = got >= 8
    np.fill_diagonal(near, False)
    for label in (np.arange(50), np.arange(50) // 3):
        links = minhash_paths.forest(near, label)
        whole, part = Sets(), Sets()
        for i in range(50):
            for j in range(50):
                if label[i] == label[j]:
                    whole.join(i, j)
                    part.join(i, j)
                if near[i, j]:
                    whole.join(i, j)
        before = len({part.root(k) for k in range(50)})
        for i, j in links:
            assert near[i, j]
            part.join(i, j)
        assert [part.root(k) for k in range(50)] == [whole.root(k) for k in range(50)]
        assert len(links) < 50 and (label[1] == 0 or len(links) == before - len({whole.root(k) for k in range(50)}))


def test_components(spark):
    r = random.Random(6)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(160)] + [(400 + k, 401 + k) for k in range(60)] + [(None, 3), (5, 5)]
    sets = Sets()
    for a, b in links:
        if a is not None and a != b:
            sets.join(a, b)
    for chunk in (1 << 19, 20):
        got = components(spark.createDataFrame(links, "a long, b long").repartition(40), chunk=chunk).collect()
        assert {r.id: r.component for r in got} == {k: sets.root(k) for k in sets.parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(spark):
    none = cases.frame(spark, [(1, "x")]).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert brown.score_texts(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0
    assert licenses.scan_licenses(none).count() == 0
    assert pieces.encode_texts(none).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert paragraphs.duplicate_paragraphs(none).count() == 0
    assert smallworld.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert decontaminate.find_leaks(none, items).count() == 0
    assert quality.score_quality(none, quality.fit(none, labels)).count() == 0
    assert minhash_paths.near_duplicates(none).count() == 0


# 11
def brute_runs(w, least=6, exponent=4):
    """All stretches of period q that nothing extends, by plain scanning; only smallest periods count."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, n = i, j + q - i
            if j > i and n >= max(least, exponent * q) and not any(w[s + d : s + n] == w[s : s + n - d] for d in range(1, q)):
                out.append((s, n, q))
            i = j + 1
    return sorted(out)


def loop_words(doc_id, w):
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 or not w:
        return w
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def collapsed(w, found):
    dropped = {k for s, n, q in found for k in range(s + q, s + n)}
    return b" ".join(x for k, x in enumerate(w) if k not in dropped)


def spaced(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (4, 3)])
def test_runs(spark, least, exponent):
    r = random.Random(6)
    data = cases.rows(n=20)
    for k in range(300):
        w = [r.choice("abcdefg"[: r.choice([1, 2, 2, 3, 5])]) for _ in range(r.randint(0, 50))]
        a, p = r.randint(0, len(w)), r.randint(1, 6)
        data.append((5000 + k, " ".join(w[:a] + [w[a + i % p] if a + i % p < len(w) else "z" for i in range(r.randint(0, 30))])))
    got = runs.find_runs(cases.frame(spark, data), least, exponent).collect()
    want = []
    for i, t in data:
        w = spaced(t)
        found = brute_runs(w, least, exponent)
        want.append((i, len(w), found, collapsed(w, found).decode()))
    assert multiset(want) == multiset([(x.doc_id, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in got])


def test_runs_of_a_long_periodic_text(spark):
    text = " ".join(["a"] * 40_000 + ["b", "c"] * 20_000 + ["d"])
    x = runs.find_runs(cases.frame(spark, [(1, text)])).first()
    assert [tuple(y) for y in x.runs] == [(0, 40_000, 1), (40_000, 40_000, 2)] and x.collapsed == "a b c d"
    assert runs.find_runs(cases.frame(spark, [])).count() == 0


def test_runs_query(spark, tmp_path):
    data = [(i, t) for i, t in cases.rows(seed=8, n=80)] + [(9000 + k, "x y " * k) for k in range(30)]
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_runs(spark, str(tmp_path)).collect()
    want = []
    for i, t in data:
        w = loop_words(i, spaced(t))
        found = brute_runs(w)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want.append((i, len(found), *best, found and 1000 * best[1] // best[2] or None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, found)).hexdigest()))
    assert multiset(want) == multiset([tuple(x) for x in got])


# 12
def test_shards_hold_all_rows_evenly_in_shuffled_order(spark):
    data = cases.rows(n=200)
    docs = cases.frame(spark, data).withColumns({"slot": F.lit("old"), "row": F.lit("r"), "place": F.lit(3), "tags": F.create_map(F.lit("a"), F.lit(1))})
    got = sharding.shuffle_shards(docs, shards=7, bucket_bytes=20_000).collect()
    assert multiset([(x.doc_id, x.text, x.row, x.place, x.tags) for x in got]) == multiset([(i, t, "r", 3, {"a": 1}) for i, t in data])
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
    assert sorted(slots) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    by_place = [x.doc_id or 0 for x in sorted(got, key=lambda x: (x.shard, x.slot))]
    n = len(by_place)
    assert abs(np.corrcoef(np.arange(n), by_place)[0, 1]) < 0.3  # in no order of ids


def test_shards_follow_the_seed_not_the_files(spark):
    data = [(i, t) for i, t in dict(cases.rows(n=150)).items()]
    place = lambda seed, parts: {x.doc_id: (x.shard, x.slot) for x in sharding.shuffle_shards(cases.frame(spark, data).repartition(parts), seed=seed, bucket_bytes=10_000).collect()}
    one = place(1, 1)
    assert one == place(1, 6) and one != place(2, 1)


def test_rows_that_repeat_each_other_leave_one_bucket(spark):
    rows = sharding.scatter(cases.frame(spark, [(1, "same text " * 20)] * 900 + cases.rows(n=20)), bucket_bytes=20_000)
    sizes = [x["count"] for x in rows.groupBy("bucket").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 250
    got = sharding.shuffle_shards(cases.frame(spark, [(1, "same")] * 100 + [(None, None)] * 50), shards=4, bucket_bytes=1000).collect()
    assert Counter((x.doc_id, x.text) for x in got) == {(1, "same"): 100, (None, None): 50}
    assert sharding.shuffle_shards(cases.frame(spark, [])).count() == 0


def test_written_shards(spark, tmp_path):
    sharding.write_shards(cases.frame(spark, cases.rows(n=30)), f"{tmp_path}/out", shards=3, folder=f"{tmp_path}/buckets", bucket_bytes=5000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert multiset([(x.doc_id, x.text) for x in back.collect()]) == multiset(cases.rows(n=30)) and back.select("shard").distinct().count() == 3


# 13
def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, fanout):
    """(doc_id, leaf, subroot, root, siblings joined, root folded from the leaf with one more character), by plain lists."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: hashed("".join(map(field, (r[0], r[1], r[2], n, r[4]))))

    def build(nodes):
        grid = [nodes]
        while len(grid[-1]) > 1:
            grid.append([hashed("".join(grid[-1][i : i + fanout])) for i in range(0, len(grid[-1]), fanout)])
        return grid

    def path(grid, i):
        out = []
        for level in grid[:-1]:
            h = i - i % fanout
            out.append(("".join(level[h:i]), "".join(level[i + 1 : h + fanout])))
            i //= fanout
        return out

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {t: sorted((r for r in rows if r[2] == t), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3]))) for t in langs}
    grids = {t: build([leaf(r, r[3]) for r in own[t]]) for t in langs}
    top = build([grids[t][-1][0] for t in langs])
    out = []
    for k, t in enumerate(langs):
        for i, r in enumerate(own[t]):
            sides = path(grids[t], i) + path(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h = leaf(r, r[3] + tampered if r[3] is not None else None)
            for a, b in sides:
                h = hashed(a + h + b)
            out.append((r[0], grids[t][0][i], grids[t][-1][0], top[-1][0], "".join(a + b for a, b in sides), h))
    return out


def manifest_rows(n):
    r, langs = random.Random(9), ["en", "de", "", "é", None, "one"]
    rows = [(10 * k, r.choice(["s", None, ""]), langs[0 if k % 2 else r.randrange(5)], r.choice([None, k]), t) for k, (_, t) in enumerate(cases.rows(n=n))]
    rows += [(2**60 + 1, "s", "one", 5, "alone"), (None, "s", "en", 1, "no id"), (None, None, None, None, None), rows[3], rows[3]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("fanout", "levels"), [(2, 12), (2, 2), (3, 1), (5, 2)])
def test_manifest(spark, fanout, levels):
    rows = manifest_rows(60)
    docs = spark.createDataFrame([(*x, "node", 1) for x in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, at int").repartition(5)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, {"changed": F.when(tampered, merkle.leaf(n_chars=F.col("n_chars") + 1))}, fanout, levels)
    got = got.withColumn("folded", merkle.folded(F.coalesce("changed", "leaf"), F.col("lefts"), F.col("rights"))).collect()
    mine = [(x.doc_id, x.leaf, x.subroot, x.root, "".join(a + b for a, b in zip(x.lefts, x.rights, strict=True)), x.folded) for x in got]
    assert multiset(mine) == multiset(brute_manifest(rows, fanout))
    assert any(x.folded != x.root for x in got)


def test_manifest_query_equals_its_sql(spark, tmp_path):
    spark.createDataFrame(manifest_rows(40), "doc_id long, source string, lang string, n_chars long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op13_manifest(spark, str(tmp_path))
    want = con.sql(queries.OP13_SQL)
    assert got.columns == want.columns and multiset(tuple(r) for r in got.collect()) == multiset(want.fetchall())


def test_manifest_of_few_rows(spark):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], kind)).count() == 0
    x = merkle.manifest(spark.createDataFrame([(1, None, None, None, None)], kind)).first()
    assert x.leaf == x.subroot == x.root == hashed("1:1----") and x.lefts == [] and x.at == 0

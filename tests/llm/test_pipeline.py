import corpus_pipeline
from placeforge.llm import minhash_paths
from tests.llm import cases


def test_stages_take_effect_and_keep_columns(spark, tmp_path):
    import random

    r, words = random.Random(2), cases.vocabulary()
    item = cases.prose(r, words, 40)
    shared = cases.prose(r, words, 120)
    data = [(k, cases.prose(r, words, 80)) for k in range(60)]
    data += [(100 + k, " | ".join([r.choice(words)] * 60)) for k in range(30)]
    data += [(200, data[1][1]), (201, data[2][1] + " " + item), (202, data[3][1] + "\n" + shared), (203, cases.prose(r, words, 70) + "\n" + shared), (204, None), (204, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100)) for i, _ in data if i < 200], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "repeats", "leaks", "pieces"]
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {x.doc_id: x.text for x in now.collect()} if k < 5 else {}
        now = stage(spark, now, str(tmp_path))
        if name != "pieces":
            assert now.columns == docs.columns
            after = {x.doc_id: x.text for x in now.collect()}
            if name == "quality":
                assert not any(100 <= i < 130 for i in after) and sum(i < 60 for i in after) >= 58
            if name == "near_copies":
                assert 200 not in after and 1 in after
                assert sum(len(minhash_paths.shingle_set(t, 5)) for t in after.values()) > 0
            if name == "repeats":
                assert shared[5:200] not in after[203] and len(after[203]) < len(before[203]) and after[5] == before[5]
            if name == "leaks":
                assert 201 not in after and set(before) - set(after) == {201}
    rows = now.collect()
    assert rows and all(x.round_trip and x.n_ids == len(x.ids) for x in rows)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, x.ids) for x in whole if x.doc_id) == sorted((x.doc_id, x.ids) for x in rows if x.doc_id)


def test_repeats_catch_a_passage_of_51_words_and_leave_one_of_50(spark):
    import random

    r, words = random.Random(8), [w for w in cases.vocabulary() if 2 <= len(w) <= 4]
    passage, tiny, near = " ".join(r.choice(words) for _ in range(51)), " ".join(r.choice("abcdefgh") for _ in range(51)), " ".join(r.choice(words) for _ in range(50))
    assert len(passage.encode()) < 270 and len(tiny) == 101
    other = cases.vocabulary(9)
    own = [cases.prose(r, other, 70) for _ in range(6)]
    data = [(2 * k + j, f"{own[2 * k + j]} {j}x {p} {j + 3}y") for k, p in enumerate((passage, tiny, near)) for j in (0, 1)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x.doc_id: x for x in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    for i, t in data:
        assert got[i].n_chars == len(got[i].text)
        assert got[i].text.startswith(own[i])
        if i < 4:
            assert len(got[i].text.split()) <= len(t.split()) - 51
        else:
            assert got[i].text == t


def test_repeats_of_400_bytes_with_few_words_go(spark):
    import random

    r = random.Random(4)
    letters = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    shared = letters(400)
    data = [(k, letters(300) + shared + letters(300)) for k in range(2)] + [(2, letters(900)), (3, letters(300) + shared[:399] + "z" + letters(9))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x.doc_id: x.text for x in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    assert all(shared[5:395] not in got[k] and len(got[k]) <= 600 for k in (0, 1)) and got[2] == data[2][1]


CLASHES = ("row", "uid", "kept", "spans", "leaks", "quality_ok", "quality_score", "one", "text_key", "alone", "removed", "node", "label", "runs", "ids")


def edge_tables(spark, path, empty=False):
    import random

    r, words = random.Random(7), cases.vocabulary()
    long = cases.prose(r, words, 30_000)
    data = [(k, cases.prose(r, words, 70)) for k in range(40)]
    data += [(100, data[0][1]), (101, data[0][1]), (5, data[5][1]), (5, cases.prose(r, words, 70)), (46, None), (47, ""), (None, data[1][1]), (None, data[1][1]), (None, None), (200, long), (201, long + " end"), (202, "x" * 200_000)]
    rows = [(i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else "s", None if k % 9 == 0 else len(t or ""), *[f"{c}{k}" for c in CLASHES]) for k, (i, t) in enumerate(data)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    if empty:
        docs = docs.where("false")
    spark.createDataFrame([(i, 1) for i, _ in data if i is not None] + [(None, 1), (3, None)], "doc_id long, quality int").where("false" if empty else "true").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, cases.prose(r, words, 40)), (None, None), (2, "")], "item_id long, text string").where("false" if empty else "true").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_stages_take_nulls_long_texts_repeats_and_clashing_columns(spark, tmp_path):
    docs = edge_tables(spark, tmp_path)
    before = [x.asDict() for x in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        after = [x.asDict() for x in out.collect()]
        mark = {x["row"]: x for x in before}
        assert all({c: x[c] for c in ("doc_id", "lang", "source", *CLASHES)} == {c: mark[x["row"]][c] for c in ("doc_id", "lang", "source", *CLASHES)} for x in after), name
        if name in ("quality", "leaks"):
            assert len(after) == len(before) and sorted(map(repr, after)) == sorted(map(repr, before)), name
        if name == "near_copies":
            ids = [x["doc_id"] for x in after]
            assert 100 not in ids and 101 not in ids and 201 not in ids and 200 in ids and ids.count(5) == 2 and ids.count(None) == 3 and 46 in ids and 47 in ids
        if name == "repeats":
            by = {x["doc_id"]: x["text"] for x in after}
            assert len(after) == len(before) and len(by[200]) < 1000 and by[202] == "" and by[46] is None and by[47] == "" and by[3] == {x["doc_id"]: x["text"] for x in before}[3]
    out = corpus_pipeline.to_pieces(spark, docs, str(tmp_path))
    rows = out.collect()
    assert len(rows) == len(before) and all(x.round_trip and x.n_ids == len(x.ids) for x in rows)


def test_stages_take_empty_tables(spark, tmp_path):
    docs = edge_tables(spark, tmp_path, empty=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "pieces" or out.columns == docs.columns), name


def test_repeats_by_brute_force(spark):
    """All bytes of every repeated window of 51 words go, and none goes that no repeated string of PASSAGE bytes covers."""
    import random
    from collections import Counter

    r, words = random.Random(12), cases.vocabulary(5)
    shared = [cases.prose(r, words, n).replace("\n", " ") for n in (51, 52, 60, 90, 45, 30)]
    data = []
    for k in range(40):
        parts = [cases.prose(r, words, r.randint(5, 60)) for _ in range(3)]
        parts.insert(r.randint(0, 3), r.choice(shared))
        data.append((k, r.choice([" ", "\n"]).join(parts)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.suffixes.remove_repeats(corpus_pipeline.packed(docs), length=corpus_pipeline.PASSAGE, least_words=corpus_pipeline.WORDS, always=400)
    got = {x.doc_id: [(s.start, s.end) for s in x.spans] for x in found.collect()}
    import re

    spots = {i: [m.span() for m in re.finditer(rb"\S+", t.encode())] for i, t in data}
    raw = {i: t.encode() for i, t in data}
    window = Counter(raw[i][w[k][0] : w[k + 50][1]] for i, w in spots.items() for k in range(len(w) - 50))
    length = corpus_pipeline.PASSAGE
    string = Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    must_all = 0
    for i, w in spots.items():
        must, may = set(), set()
        for k in range(len(w) - 50):
            if window[raw[i][w[k][0] : w[k + 50][1]]] > 1:
                must |= set(range(w[k][0], w[k + 50][1]))
        for k in range(len(raw[i]) - length + 1):
            if string[raw[i][k : k + length]] > 1:
                may |= set(range(k, k + length))
        gone = {x for s, e in got[i] for x in range(s, e)}
        must_all += len(must)
        assert must <= gone <= may, i
        assert all(len(raw[i][s:e].split()) >= 51 or e - s >= 400 for s, e in got[i])
    assert must_all > 5000

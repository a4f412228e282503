"""Small texts that hold the awkward cases: nulls, empty and long texts, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, node long, ids string, spans string"


def vocabulary(seed=1, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghiklmnoprstuvé") for _ in range(r.randint(2, 9))) for _ in range(n)]


def prose(r, words, n):
    out = []
    while len(out) < n:
        out += [r.choice(words).capitalize(), *(r.choice(words) for _ in range(r.randint(4, 12)))]
        out[-1] += "."
        if r.random() < 0.2:
            out[-1] += "\n"
    return " ".join(out[:n])


def rows(seed=3, n=60):
    """(doc_id, text): fresh texts, exact and near copies, shared passages, a long one, and empty ones."""
    r, words = random.Random(seed), vocabulary()
    passage = prose(r, words, 90)
    texts = [prose(r, words, r.randint(1, 300)) for _ in range(n)]
    for k in range(0, n, 6):
        near = texts[k].split(" ")
        near[len(near) // 2] = "changed"
        texts += [texts[k], " ".join(near)]
    for k in range(1, n, 9):
        texts[k] += "\n" + passage
    texts += [prose(r, words, 6000), "", " \n\t ", None, None, "one", "One", "a b", "A\tB", "x" * 3000, "ab" * 700, "é▁ \U0001f600 ｗ"]
    order = list(range(len(texts)))
    r.shuffle(order)
    out = [(10 * k + 7, texts[i]) for k, i in enumerate(order)]
    return out + [out[3], out[3], (None, texts[0]), (None, None)]


def frame(spark, data=None):
    data = rows() if data is None else data
    full = [(i, t, "en", "s", len(t or ""), 0.5, "k", 1, "i", "s") for i, t in data]
    return spark.createDataFrame(full, SCHEMA).repartition(5)

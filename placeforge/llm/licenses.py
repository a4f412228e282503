"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.llm.runtime import cut

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: the phrases and labels of the contract
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# fixed values: short names of licences, with the method's labels
NAMES = (
    ("cc by nc", "cc-by-nc"), ("cc by sa", "cc-by-sa"), ("cc by nd", "cc-by-nd"), ("creative commons attribution", "cc-by"), ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"), ("mozilla public license", "mpl"), ("eclipse public license", "epl"), ("isc license", "isc"), ("bsd 3 clause", "bsd"), ("bsd 2 clause", "bsd"),
)
# fixed values: public wordings of licences and of the notices that name them, as lower-case words
_AS_IS = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
_NO_WARRANTY = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
NOTICES = (
    (f"{_MIT} {_NO_WARRANTY}", "mit"), (_MIT, "mit"), ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    (f"{_BSD} {_AS_IS}", "bsd"), (_BSD, "bsd"), ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "zlib"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "unlicense"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "apache"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", "mpl"),
)
LONG_WORDS = 8  # templates from this length on vote by LONG_GRAM words and may match in part; others by two words, whole
LONG_GRAM = 4
COVER = 0.7
DRIFT = 2
MASK = 62  # template positions that one number holds
SIEVE = 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _templates(spark, templates) -> tuple[DataFrame, int]:
    """t, at, gram words, grams, label, base and size of every template position, and the number of masks that the longest needs."""
    rows, most = [], 1
    for t, (phrase, label, base) in enumerate(templates):
        parts = phrase.split()
        k = LONG_GRAM if len(parts) >= LONG_WORDS else 2
        most = max(most, len(parts) - k + 1)
        rows += [(t, i, k, " ".join(parts[i : i + k]), len(parts) - k + 1, label, base, len(parts)) for i in range(len(parts) - k + 1)]
    frame = spark.createDataFrame(rows, "t int, at int, k int, ws string, grams int, label string, base boolean, size int")
    return frame.withColumn("gram", F.xxhash64("ws")), -(-most // MASK)


def _sieve(fixed: DataFrame) -> Column:
    """A bit for each value of the low bits of the templates' grams (a table fixed in the code), as an array of longs."""
    words = [0] * (SIEVE // 64)
    for r in fixed.select(F.pmod("gram", F.lit(SIEVE)).alias("bit")).distinct().collect():
        words[r["bit"] // 64] |= 1 << (r["bit"] % 64)
    return F.array(*(F.lit(w - (1 << 64) if w >> 63 else w).cast("long") for w in words))


def _hits(words: Column, k: int, sieve: Column) -> Column:
    """(pos, k, gram, ws) of the word k-grams whose hash passes the sieve."""
    text = lambda i: F.array_join(F.slice(words, i, F.lit(k)), " ")
    rolled = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(1))), lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(text(i)).alias("gram"), i.alias("i")))
    bit = lambda g: F.pmod(g, F.lit(SIEVE)).cast("int")
    passed = F.filter(rolled, lambda x: F.call_function("shiftrightunsigned", F.element_at(sieve, F.call_function("shiftright", bit(x["gram"]), F.lit(6)) + 1), F.pmod(bit(x["gram"]), F.lit(64))).bitwiseAND(F.lit(1).cast("long")) == 1)
    return F.transform(passed, lambda x: F.struct(x["pos"].alias("pos"), x["gram"].alias("gram"), text(x["i"]).alias("ws")))


def scan_licenses(docs: DataFrame, base=BASE, notices=(*NAMES, *NOTICES), cover: float = COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row for each row of `docs`.

    All rolling word grams of a text (four words for templates of LONG_WORDS or
    more, else two) are joined with the template positions (a table fixed in the
    code), votes are added up by template and diagonal (word minus template
    position), and spans are verified on the words themselves. A short template
    must match whole; a long one also counts where neighbouring diagonals (at
    most DRIFT apart, within its length) together hold `cover` of its grams.
    score is the best share of a template's grams. Null and empty texts have no
    words and no labels (empty strings), and null places; very long texts are
    scanned whole. Ties of labels and places need no rule: all are listed or
    counted. Repeated rows give repeated results; rows of one id with different
    texts stay apart; null ids stand for themselves; an empty table gives an
    empty one; other columns are not read.
    """
    spark = docs.sparkSession
    templates, masks = _templates(spark, [(p, x, True) for p, x in base] + [(p, x, False) for p, x in notices])
    sieve = _sieve(templates)
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    # the words stand in a row of their own, so that no later step splits the text again
    found = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))).alias("w"))
    marker = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("gram"), F.size("w").cast("string").alias("ws")))
    rows = found.select("doc_id", "text_key", F.explode(F.concat(marker, _hits(F.col("w"), 2, sieve), _hits(F.col("w"), LONG_GRAM, sieve))).alias("p")).select("doc_id", "text_key", "p.*")
    fixed = F.broadcast(templates.select("gram", "t", "at", F.col("ws").alias("tw"), "grams", "label", "base", "size"))
    hits = rows.join(fixed, "gram", "left").where("pos < 0 or ws = tw")
    # one row for each document, template and diagonal; the marker (no template) counts the document itself
    at = lambda m: F.when(F.col("at").between(m * MASK, m * MASK + MASK - 1), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") - m * MASK)).otherwise(0)
    seen = [f"seen{m}" for m in range(masks)]
    diagonal = hits.groupBy("doc_id", "text_key", "t", (F.col("pos") - F.col("at")).alias("d"), "grams", "label", "base", "size").agg(
        F.count("*").alias("copies"), *(F.bit_or(at(m)).alias(seen[m]) for m in range(masks)), F.max(F.when(F.col("pos") < 0, F.col("ws"))).cast("long").alias("n_words")
    )
    diagonal = cut(diagonal)  # both what matches whole and what matches in part is read from it: texts are split once
    votes = sum((F.bit_count(c) for c in seen), F.lit(0))
    whole = F.col("grams") == votes
    near = Window.partitionBy("doc_id", "text_key", "t").orderBy("d")
    far = (F.col("d") - F.coalesce(F.lag("d").over(near), F.lit(-(1 << 40)))) > DRIFT
    partial = diagonal.where(F.col("t").isNotNull() & ~whole & (F.col("size") >= LONG_WORDS))
    partial = partial.withColumn("chain", F.sum(far.cast("long")).over(near.rowsBetween(Window.unboundedPreceding, 0)))
    partial = partial.groupBy("doc_id", "text_key", "t", "chain", "grams", "label").agg(*(F.bit_or(c).alias(c) for c in seen))
    partial = partial.select("doc_id", "text_key", "label", (votes / F.col("grams")).alias("share")).where(F.col("share") >= cover)
    columns = ["doc_id", "text_key", "label", "share", "place", "rows", "n_words"]
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    exact = diagonal.where(F.col("t").isNull() | whole)
    known = F.col("t").isNotNull()
    exact = exact.select(
        "doc_id", "text_key", "label", F.when(known, F.lit(1.0)).alias("share"), F.when(F.col("base"), F.col("d").cast("long")).alias("place"), F.when(~known, F.col("copies")).alias("rows"), "n_words",
    )
    every = exact.unionByName(partial.select("doc_id", "text_key", "label", "share", none("long", "place"), none("long", "rows"), none("long", "n_words")).select(columns))
    # no two phrases of the contract share a place and a label, so places may simply be counted
    out = every.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.count("place").alias("n_base"), F.min("place").alias("first_word"), F.max("place").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("place").isNotNull(), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"), F.max("rows").alias("rows"),
    )
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

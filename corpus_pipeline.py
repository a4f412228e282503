"""The corpus pipeline: quality filter, near-dedup, substring dedup, decontamination, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import decontaminate, minhash_paths, pieces, quality, suffixes
from placeforge.llm.runtime import cut, load

WORDS = 51
PASSAGE = 2 * WORDS - 1


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row as one column, so that no name of the documents' columns can clash."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (ties with its bound stay), all columns as they are.

    Null and empty texts are scored as empty ones; very long texts are read
    whole; repeated rows share their fate; an empty table stays empty.
    """
    forest = quality.fit(docs, load(spark, sf_dir, "labels"))
    return quality.score_quality(packed(docs), forest).where("quality_ok").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity of 0.8 or more): the smallest doc_id.

    Of rows that repeat a doc_id and its text one stays; unlike texts of one id
    are judged each on its own. Rows without an id are compared with none and
    stay, and so do null and blank texts; very long texts are read whole; an
    empty table stays empty.
    """
    groups = minhash_paths.grouped(docs, size=5, percent=80)
    first = (F.col("one.doc_id") == F.col("doc_id")) & (F.col("one.text_key") == F.col("text_key"))
    gone = groups.where(F.col("one").isNotNull() & ~first).select("doc_id", "text_key").distinct()
    rows = packed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), "row")
    kept = rows.join(gone, ["doc_id", "text_key"], "left_anti")
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return kept.withColumn("alone", alone).dropDuplicates(["doc_id", "text_key", "alone"]).select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of repeated bytes that hold over 50 words or 400 bytes; a cut character goes whole.

    Windows of 51 words (and of 400 bytes, for texts with few spaces) meet by their minimal grams. No 51 words are
    shorter than PASSAGE bytes (words of one byte), so all that repeat byte for byte are caught, in rows without an
    id too; all of equal passages go. Null, empty and short texts stay as they are; very long texts are read whole;
    texts of repeated rows repeat each other; an empty table stays empty. n_chars, if there, follows the text.
    """
    cut_texts = suffixes.remove_repeats(packed(docs), length=PASSAGE, least_words=WORDS, always=400)
    same = F.size("spans") == 0
    text = F.coalesce(F.try_validate_utf8("kept"), F.replace(F.make_valid_utf8("kept"), F.lit("\ufffd"), F.lit("")))
    own = lambda c: F.col("row")[c]
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut_texts.select(*(F.when(same, own(c)).otherwise(new[c].cast(docs.schema[c].dataType)).alias(c) if c in new else own(c).alias(c) for c in docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, all columns as they are.

    Null, empty and short texts hold none; very long texts are read whole;
    repeated rows share their fate; an empty table stays empty.
    """
    return decontaminate.find_leaks(packed(docs), load(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select("row.*")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the text's ids, and whether they decode to it; other columns end here.

    Null and empty texts have no ids; very long texts are encoded whole;
    repeated rows get equal ids; an empty table gives an empty one.
    """
    return pieces.encode_texts(docs.select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("leaks", drop_leaks),
    ("pieces", to_pieces),
]
# the stages' models and bit-level joins are not expressible in SQL; tests/llm compares them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs

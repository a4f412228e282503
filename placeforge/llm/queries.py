"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import brown, decontaminate, licenses, merkle, minhash_paths, paragraphs, pieces, quality, runs, sharding, smallworld, suffixes, urls
from placeforge.llm.runtime import load, split_of


def op1_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(load(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"), length=400, report_words=51)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    # beside the contract's columns: passages of over 50 words that stand twice, which 400 bytes may not reach
    total = F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    passages = F.size("passages").cast("long").alias("n_passages"), total.alias("passage_bytes")
    return cut.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), *passages)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(load(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_texts(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(load(spark, sf_dir, "pages")).withColumn("purity", F.round("purity", 6))


OP5_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(u, '://') > 0 THEN substring(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{urls.UPPER}', '{urls.LOW}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/' WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts),
base AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled,
  list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: CASE WHEN regexp_matches(s, '[0-9]') OR length(s) > 24 THEN '*' || regexp_extract(s, '\\.[a-z]{{2,5}}$', 0) ELSE s END) AS steps FROM ruled),
counted AS (SELECT host, steps, count(ruled) AS m, count(*) FILTER (WHERE ruled = 'block') AS b FROM base GROUP BY 1, 2),
wide AS (SELECT host, list(depth) AS wild FROM (SELECT host, depth, count(DISTINCT step) AS k FROM (SELECT host, unnest(range(1, len(steps) + 1)) AS depth, unnest(steps) AS step FROM counted) GROUP BY 1, 2) WHERE k > {urls.BRANCHES} GROUP BY 1),
tree AS (SELECT c.*, CASE WHEN wild IS NULL THEN steps ELSE list_transform(steps, lambda s, i: CASE WHEN list_contains(wild, i) THEN '*' ELSE s END) END AS template FROM counted c LEFT JOIN wide w ON c.host = w.host),
nodes AS (SELECT host, template, len(template) AS depth, CASE WHEN len(template) > 0 THEN template[1:len(template) - 1] ELSE template END AS parent, sum(m) AS m, sum(b) AS b FROM tree GROUP BY 1, 2),
pooled AS (SELECT *, sum(m) OVER (PARTITION BY host, parent, depth) AS pm, sum(b) OVER (PARTITION BY host, parent, depth) AS pb FROM nodes),
merged AS (SELECT *, m > 0 AND abs(b / m - (pb + 1) / (pm + 2)) / sqrt((pb + 1) / (pm + 2) * (1 - (pb + 1) / (pm + 2)) / m) <= {urls.ALIKE} AS alike FROM (SELECT * REPLACE (CAST(m AS DOUBLE) AS m, CAST(b AS DOUBLE) AS b, CAST(pm AS DOUBLE) AS pm, CAST(pb AS DOUBLE) AS pb) FROM pooled)),
shares AS (SELECT *, sum(m) FILTER (WHERE alike) OVER (PARTITION BY host, parent, depth) AS am, sum(b) FILTER (WHERE alike) OVER (PARTITION BY host, parent, depth) AS ab, sum(m) OVER (PARTITION BY template) AS gm, sum(b) OVER (PARTITION BY template) AS gb, sum(m) OVER () AS rm, sum(b) OVER () AS rb FROM merged),
purity AS (SELECT host, template, ((CASE WHEN alike THEN ab ELSE b END) + {urls.SMOOTH} * (gb + {urls.SMOOTH} * (rb + 1) / (rm + 2)) / (gm + {urls.SMOOTH})) / ((CASE WHEN alike THEN am ELSE m END) + {urls.SMOOTH}) AS purity FROM shares)
SELECT base.page_id, base.host, base.path, base.rule, coalesce(base.ruled, CASE WHEN purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, '/' || array_to_string(tree.template, '/') AS template, round(purity, 6) AS purity
FROM base JOIN tree ON base.host = tree.host AND base.steps = tree.steps JOIN purity ON tree.host = purity.host AND tree.template = purity.template
"""


def op6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.duplicate_paragraphs(load(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", "n_paragraphs", "n_removed", "removed_bytes", spans.alias("spans"))


def op7_smallworld(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallworld.near_vectors(load(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.array_distinct(F.col("leaks.item_id"))), ",")
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_leaks"), ids.alias("item_ids"), F.array_min("leaks.start").alias("first_start"), F.array_min("leaks.edits").alias("least_edits"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    forest = quality.fit(docs, load(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), forest)
    return scored.select("doc_id", (split_of("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_ok").cast("int").alias("predicted"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_paths.near_duplicates(load(spark, sf_dir, "documents"), size=2, percent=80)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(runs.looped(load(spark, sf_dir, "documents"))).withColumn("best", runs.longest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_shards(load(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(load(spark, sf_dir, "documents"), {"changed": F.when(tampered, merkle.leaf(n_chars=F.try_add("n_chars", F.lit(1))))})
    proof = F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), "")
    found = found.select("doc_id", "lang", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), merkle.folded(F.coalesce("changed", "leaf"), F.col("lefts"), F.col("rights")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


# crc: the table of crc32; nodes, tops: all levels of the languages' trees and of the one above; low, high: from a leaf to its subroot, and on to the root
OP13_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
docs AS (SELECT doc_id, lang, n_chars, {_field('doc_id')} || {_field('source')} || {_field('lang')} AS head, {_field('text')} AS tail, doc_id IS NOT NULL AND xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 7 = 0 AS tampered FROM documents, crc),
hashed AS (SELECT *, sha256(head || {_field('n_chars')} || tail) AS leaf, sha256(head || {_field('(n_chars + 1)')} || tail) AS changed FROM docs),
leaves AS (SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, leaf, CASE WHEN tampered THEN changed ELSE leaf END AS start, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes AS (SELECT tree, place, n, 0 AS level, leaf AS node FROM leaves UNION ALL SELECT tree, place // 2, (n + 1) // 2, level + 1, sha256(string_agg(node, '' ORDER BY place)) FROM nodes WHERE n > 1 GROUP BY tree, place // 2, n, level),
subs AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT place, n, 0 AS level, subroot AS node FROM subs UNION ALL SELECT place // 2, (n + 1) // 2, level + 1, sha256(string_agg(node, '' ORDER BY place)) FROM tops WHERE n > 1 GROUP BY place // 2, n, level),
low AS (SELECT tree, place AS own, place, n, 0 AS level, start AS h, '' AS proof FROM leaves UNION ALL SELECT p.tree, p.own, p.place // 2, (p.n + 1) // 2, p.level + 1, sha256(CASE WHEN p.place % 2 = 1 THEN s.node || h ELSE h || coalesce(s.node, '') END), proof || coalesce(s.node, '') FROM low p LEFT JOIN nodes s ON s.tree = p.tree AND s.level = p.level AND s.place = xor(p.place, 1) WHERE p.n > 1),
high AS (SELECT low.tree, own, subs.place, subs.n, 0 AS level, h, proof FROM low JOIN subs ON low.tree = subs.tree WHERE low.n = 1 UNION ALL SELECT p.tree, p.own, p.place // 2, (p.n + 1) // 2, p.level + 1, sha256(CASE WHEN p.place % 2 = 1 THEN s.node || h ELSE h || coalesce(s.node, '') END), proof || coalesce(s.node, '') FROM high p LEFT JOIN tops s ON s.level = p.level AND s.place = xor(p.place, 1) WHERE p.n > 1)
SELECT l.doc_id, l.lang, l.leaf, subs.subroot, tops.node AS root, sha256(high.proof) AS proof_sha256, high.h AS folded_root, high.h = tops.node AS verified
FROM leaves l JOIN subs ON l.tree = subs.tree JOIN high ON high.n = 1 AND high.tree = l.tree AND high.own = l.place JOIN tops ON tops.n = 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_brown, op2_suffixes, op3_licenses, op4_sentencepiece, op5_urls, op6_paragraphs, op7_smallworld, op8_decontaminate, op9_quality, op10_minhash, op11_runs, op12_shards, op13_manifest)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_urls": OP5_SQL, "op13_manifest": OP13_SQL}

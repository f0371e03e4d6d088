"""Matching descriptions to codes: vocabulary, leave-one-out votes, fuzzy and vector search, calibrated tiers, samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions.matching import ABBREVIATIONS, PREFIXES, UNITS, allowed_outside, code_family, normalize_text
from quillstone.functions.wratio import Scorer
from quillstone.plans.pricefacts import PRICE, STANDARD_CODES, read
from quillstone.plans.registry import query
from quillstone.plans.store import prices

REFERENCE_BIT = 1 << 40
#: Texts that a task scores at once: asked ones, and ones of the vocabulary.
ASKED_BLOCK, VOCABULARY_BLOCK = 16, 50_000
# Codes that stand for many unlike items.
CATCH_ALL = ("J3490", "J8499", "J9999", "J7999", "C1713", "C1776", "C1769", "C1725", "C1876", "C1889", "C1887", "C1767", "C1781", "C1789", "C1768", "C2617", "V2632", "V2787", "V2788", "A4649")
PER_CODE, POOL, NEIGHBOURS, TOP = 6, 25, 60, 10
TARGET, GRID, SUPPORT = 0.95, (0.7, 0.75, 0.8, 0.85, 0.9, 0.92, 0.95, 0.97, 1.0), 30
#: Bytes up to which a search's query side is sent to every task.
QUERY_BYTES = 32 << 20


def raw_text() -> Column:
    """Descriptions with prefixes, units and abbreviations, out of part."""
    k = F.col("p_partkey") % 5
    start = F.when(k == 0, "HC MRI ").when(k == 1, "PR HB ").when(k == 2, "CT W/O ").when(k == 3, "INJ w/dye ").otherwise("")
    return F.concat(start, F.col("p_name"), F.lit(", "), F.col("p_size").cast("string"), F.when(k == 1, "mg").otherwise(""))


_MAP = "MAP {" + ", ".join("'{}': '{}'".format(a.replace("'", "''"), b) for a, b in ABBREVIATIONS.items()) + "}"


def normalized_sql(column: str, table: str, keep: str = "*") -> str:
    """DuckDB text of normalize_text(column) as a chain of subqueries over table: keep columns and text."""
    prefixes = ", ".join(f"'{p}'" for p in PREFIXES)
    return f"""(SELECT {keep}, array_to_string(list_transform(parts, lambda w: coalesce({_MAP}[w], w)), ' ') AS text FROM (
      SELECT *, list_filter(string_split(array_to_string(list_transform(list_slice(words, coalesce(list_position(list_transform(words, lambda w: w NOT IN ({prefixes})), true), len(words) + 1), len(words)),
        lambda w: regexp_replace(w, '^([0-9]+)({"|".join(UNITS)})$', '\\1 \\2')), ' '), ' '), lambda w: w <> '') AS parts FROM (
        SELECT *, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(lower(coalesce({column}, '')), '\\bw/o\\b', ' without ', 'g'), '\\bw/([\\sa-z]|$)', ' with \\1', 'g'), '[^a-z0-9'']+'), lambda w: w <> '') AS words FROM {table})))"""


RAW = """
WITH raw AS (SELECT p_partkey, p_brand AS code, concat(CASE p_partkey % 5 WHEN 0 THEN 'HC MRI ' WHEN 1 THEN 'PR HB ' WHEN 2 THEN 'CT W/O ' WHEN 3 THEN 'INJ w/dye ' ELSE '' END, p_name, ', ', p_size, CASE p_partkey % 5 WHEN 1 THEN 'mg' ELSE '' END) AS raw FROM part)"""


@query("normalize_text", RAW + f" SELECT * FROM {normalized_sql('raw', 'raw', 'p_partkey, raw')}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", raw_text().alias("raw")).withColumn("text", normalize_text(F.col("raw")))


@query("code_family", """
WITH c AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '99213' WHEN 1 THEN '470' WHEN 2 THEN ' j1885' WHEN 3 THEN 'C1713' WHEN 4 THEN 'ZZ' ELSE NULL END AS code FROM part)
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'cpt_numeric' WHEN 1 THEN 'ms_drg' WHEN 2 THEN 'drug_J' WHEN 3 THEN 'device_or_other_hcpcs' ELSE 'other' END AS family FROM c""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    code = F.when(k == 0, "99213").when(k == 1, "470").when(k == 2, " j1885").when(k == 3, "C1713").when(k == 4, "ZZ")
    return read(spark, sf_dir, "part").select("p_partkey", code_family(code).alias("family"))


def hospital_bit(slug: Column) -> Column:
    """1 shifted by the hospital's number, here the one in its name; bit 40 is that of the references, so numbers from 40 on are one higher. 62 hospitals fit."""
    number = F.substring(slug, 2, 9).cast("int")
    place = F.when(number < 40, number).when(number < 62, number + 1).otherwise(F.raise_error(F.lit("a mask has room for 62 hospitals")).cast("int"))
    return F.pow(F.lit(2.0), place).cast("long")


def hospital_items(facts: DataFrame) -> DataFrame:
    rows = facts.where(F.col("code_type").isin(*STANDARD_CODES)).select("hospital_slug", "code", "code_type", "description").distinct()
    return rows.withColumn("text", normalize_text(F.col("description"))).where(F.length("text") >= 3)


def entries(items: DataFrame) -> DataFrame:
    """code, text, mask of the hospitals that use them, and their number."""
    return items.groupBy("code", "text").agg(F.bit_or(hospital_bit(F.col("hospital_slug"))).alias("mask"), F.count_distinct("hospital_slug").alias("n_hosp"))


def top_entries(vocab: DataFrame, most: int = PER_CODE) -> DataFrame:
    order = Window.partitionBy("code").orderBy(F.desc("n_hosp"), F.length("text"), "text")
    return vocab.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= most).drop("rn")


def reference_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference descriptions, here those of part; they are allowed for every hospital."""
    rows = read(spark, sf_dir, "part").select(F.col("p_brand").alias("code"), normalize_text(raw_text()).alias("text")).where(F.length("text") >= 3)
    return rows.select("code", "text", F.lit(REFERENCE_BIT).alias("mask"), F.lit(0).cast("long").alias("n_hosp"), F.lit("reference").alias("source")).dropDuplicates(["code", "text", "source"])


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = top_entries(entries(hospital_items(prices(spark, sf_dir)))).withColumn("source", F.lit("hospital"))
    return own.unionByName(reference_entries(spark, sf_dir))


VOCAB = PRICE + RAW.replace("\nWITH raw", ",\nraw") + f""",
it0 AS (SELECT DISTINCT hospital_slug, code, code_type, description FROM price WHERE code_type IN ('CPT', 'HCPCS', 'MS-DRG')),
it AS (SELECT * FROM {normalized_sql('description', 'it0', 'hospital_slug, code, code_type, description')} WHERE length(text) >= 3),
ent AS (SELECT code, text, bit_or(1::BIGINT << substr(hospital_slug, 2)::INT) AS mask, count(DISTINCT hospital_slug)::BIGINT AS n_hosp FROM it GROUP BY code, text),
six AS (SELECT code, text, mask, n_hosp FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n_hosp DESC, length(text), text) AS rn FROM ent) WHERE rn <= 6),
refs AS (SELECT DISTINCT code, text, 1099511627776::BIGINT AS mask, 0::BIGINT AS n_hosp, 'reference' AS source FROM {normalized_sql('raw', 'raw', 'code')} WHERE length(text) >= 3),
vocab AS (SELECT *, 'hospital' AS source FROM six UNION ALL SELECT * FROM refs)"""


@query("vocab_mask", VOCAB + " SELECT * FROM ent")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(hospital_items(prices(spark, sf_dir)))


@query("vocab_top6", VOCAB + " SELECT * FROM six")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_entries(entries(hospital_items(prices(spark, sf_dir))))


@query("vocab_union", VOCAB + " SELECT code, text, source FROM vocab")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(spark, sf_dir).select("code", "text", "source")


@query("vocab_build", VOCAB + " SELECT code, text, mask, n_hosp, source FROM vocab")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(spark, sf_dir).select("code", "text", "mask", "n_hosp", "source")


@query("loo_mask", VOCAB + " SELECT code, text, mask & ~(1::BIGINT << 3) <> 0 AS allowed FROM vocab")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(spark, sf_dir).select("code", "text", allowed_outside(F.col("mask"), F.lit(8).cast("long")).alias("allowed"))


def exact_votes(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """hospital_slug, text and the code of most votes (1 + hospitals) among equal texts known outside the hospital; ties: least code."""
    asked = items.select("hospital_slug", "text").distinct()
    hits = asked.join(vocab.select("text", "code", "mask", "n_hosp"), "text").where(allowed_outside(F.col("mask"), hospital_bit(F.col("hospital_slug"))))
    votes = hits.groupBy("hospital_slug", "text", "code").agg(F.sum(1 + F.col("n_hosp")).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("minus"), "code"))
    return votes.groupBy("hospital_slug", "text").agg(best.alias("b")).select("hospital_slug", "text", F.col("b.code").alias("code"), (-F.col("b.minus")).alias("votes"))


_VOTES = """,
votes AS (SELECT hospital_slug, text, v.code, sum(1 + n_hosp)::BIGINT AS votes FROM (SELECT DISTINCT hospital_slug, text FROM it) i JOIN vocab v USING (text) WHERE mask & ~(1::BIGINT << substr(hospital_slug, 2)::INT) <> 0 GROUP BY ALL),
best AS (SELECT hospital_slug, text, code, votes FROM (SELECT *, row_number() OVER (PARTITION BY hospital_slug, text ORDER BY votes DESC, code) AS rn FROM votes) WHERE rn = 1)"""


@query("exact_match_vote", VOCAB + _VOTES + " SELECT * FROM best")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_votes(hospital_items(prices(spark, sf_dir)), vocabulary(spark, sf_dir))


def in_blocks(rows: DataFrame, asked: DataFrame, key: str, row_bytes: int) -> DataFrame:
    """Every row of rows beside every row of asked, a stated query set: asked is broadcast if its counted rows are few.

    Else it is dealt out by a salt of key, so that no task holds it whole.
    """
    n = asked.count()
    if n * row_bytes <= QUERY_BYTES:
        return rows.join(F.broadcast(asked))
    blocks = max(1, n * row_bytes // QUERY_BYTES)
    spread = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return spread.join(asked.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")), "block").drop("block")


def fuzzy_candidates(asked: DataFrame, vocab: DataFrame, pool: int = POOL) -> DataFrame:
    """The pool best texts of the whole vocabulary for each asked text by Levenshtein ratio; each task's rows are cut to pool a text before the ranks are compared."""
    pairs = in_blocks(vocab.select(F.col("text").alias("found")).distinct(), asked.select("text").distinct(), "text", 256)
    longest = F.greatest(F.length("text"), F.length("found"))
    scored = pairs.select("text", "found", F.round(1 - F.levenshtein("text", "found") / longest, 6).alias("score"))
    order = Window.partitionBy("text").orderBy(F.desc("score"), "found")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pool)


def composite_candidates(asked: DataFrame, vocab: DataFrame, pool: int = POOL) -> DataFrame:
    """As fuzzy_candidates, by the composite ratio (0 to 1) of functions.wratio; blocks of asked texts meet blocks of the vocabulary, one pair of blocks a task."""
    texts, found = asked.select("text").distinct(), vocab.select(F.col("text").alias("found")).distinct()
    parts, blocks = max(1, texts.count() // ASKED_BLOCK), 1 + found.count() // VOCABULARY_BLOCK
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = texts.withColumn("part", dealt("text", parts)).withColumn("block", every(blocks)).groupBy("part", "block")
    right = found.withColumn("block", dealt("found", blocks)).withColumn("part", every(parts)).groupBy("part", "block")

    def score(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        names = sorted(theirs["found"])
        scorer, rows = Scorer(names), []
        for text in mine["text"]:
            scores = np.round(scorer.scores(text) / 100, 6)
            best = np.lexsort((np.arange(len(names)), -scores))[:pool]
            rows += [(text, names[i], float(scores[i])) for i in best]
        return pd.DataFrame(rows, columns=["text", "found", "score"])

    scored = left.cogroup(right).applyInPandas(score, "text string, found string, score double")
    order = Window.partitionBy("text").orderBy(F.desc("score"), "found")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pool)


_FUZZY = """,
prs AS (SELECT text, found FROM (SELECT DISTINCT text FROM it) CROSS JOIN (SELECT DISTINCT text AS found FROM vocab)),
scored AS (SELECT text, found, round(1 - levenshtein(text, found)::DOUBLE / greatest(length(text), length(found)), 6) AS score FROM prs),
fz AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, found)::INT AS place FROM scored) WHERE place <= 25)"""


@query("fuzzy_topk", VOCAB + _FUZZY + " SELECT text, found, score, place FROM fz")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_candidates(hospital_items(prices(spark, sf_dir)), vocabulary(spark, sf_dir)).select("text", "found", "score", "place")


def fuzzy_match(items: DataFrame, vocab: DataFrame, candidates: Callable[[DataFrame, DataFrame], DataFrame] = fuzzy_candidates) -> DataFrame:
    """hospital_slug, text, code, score and method: an exact vote, else the first allowed of the candidates, else none."""
    asked = items.select("hospital_slug", "text").distinct()
    exact = exact_votes(items, vocab).select("hospital_slug", "text", F.col("code").alias("exact_code"))
    near = candidates(items, vocab).join(vocab.select(F.col("text").alias("found"), "code", "mask"), "found")
    allowed = asked.join(near, "text").where(allowed_outside(F.col("mask"), hospital_bit(F.col("hospital_slug"))))
    first = allowed.groupBy("hospital_slug", "text").agg(F.min(F.struct("place", "code", "score")).alias("f"))
    joined = asked.join(exact, ["hospital_slug", "text"], "left").join(first, ["hospital_slug", "text"], "left")
    has = F.col("exact_code").isNotNull()
    method = F.when(has, "exact").when(F.col("f").isNotNull(), "fuzzy").otherwise("none")
    return joined.select("hospital_slug", "text", F.coalesce("exact_code", "f.code").alias("code"), F.when(has, 1.0).otherwise(F.coalesce("f.score", F.lit(0.0))).alias("score"), method.alias("method"))


@query("match_fuzzy", VOCAB + _VOTES + _FUZZY + """,
near AS (SELECT i.hospital_slug, i.text, fz.place, v.code, fz.score FROM (SELECT DISTINCT hospital_slug, text FROM it) i JOIN fz USING (text) JOIN vocab v ON v.text = fz.found WHERE mask & ~(1::BIGINT << substr(hospital_slug, 2)::INT) <> 0),
fst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hospital_slug, text ORDER BY place, code) AS rn FROM near) WHERE rn = 1)
SELECT i.hospital_slug, i.text, coalesce(b.code, f.code) AS code, CASE WHEN b.code IS NOT NULL THEN 1.0 ELSE coalesce(f.score, 0) END::DOUBLE AS score, CASE WHEN b.code IS NOT NULL THEN 'exact' WHEN f.code IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS method
FROM (SELECT DISTINCT hospital_slug, text FROM it) i LEFT JOIN best b USING (hospital_slug, text) LEFT JOIN fst f USING (hospital_slug, text)""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_match(hospital_items(prices(spark, sf_dir)), vocabulary(spark, sf_dir))


@query("composite_topk")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite_candidates(hospital_items(prices(spark, sf_dir)), vocabulary(spark, sf_dir)).select("text", "found", "score", "place")


@query("match_composite")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_match(hospital_items(prices(spark, sf_dir)), vocabulary(spark, sf_dir), composite_candidates)


@query("in_vocab", VOCAB + " SELECT DISTINCT hospital_slug, it.code, EXISTS (SELECT 1 FROM vocab v WHERE v.code = it.code AND mask & ~(1::BIGINT << substr(hospital_slug, 2)::INT) <> 0) AS known FROM it")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = hospital_items(prices(spark, sf_dir)).select("hospital_slug", "code").distinct()
    codes = vocabulary(spark, sf_dir).groupBy("code").agg(F.bit_or("mask").alias("mask"))
    own = hospital_bit(F.col("hospital_slug"))
    return asked.join(codes, "code", "left").select("hospital_slug", "code", F.coalesce(allowed_outside(F.col("mask"), own), F.lit(False)).alias("known"))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def nearest(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, label, sim, place: the k nearest of all vectors for each asked one (query_id, query), by cosine.

    The stated query set meets all rows in blocks. Its size is checked; a larger one is dealt out by a salt instead of broadcast, so that
    no task holds it whole. Each task's rows are cut to k a query before the ranks are compared.
    """
    normed = vectors.withColumn("norm", F.sqrt(dot("embedding", "embedding"))).where("norm > 0")
    asked = asked.withColumn("query_norm", F.sqrt(dot("query", "query"))).where("query_norm > 0")
    pairs = in_blocks(normed, asked, "query_id", 1024)
    kept = [c for c in ("mask", "own") if c in pairs.columns]
    scored = pairs.select("query_id", "vec_id", "label", *kept, F.round(dot("query", "embedding") / (F.col("norm") * F.col("query_norm")), 6).alias("sim"))
    order = Window.partitionBy("query_id").orderBy(F.desc("sim"), "vec_id")
    return scored.where("query_id <> vec_id").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def queries_of(vectors: DataFrame) -> DataFrame:
    return vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


SIMS = """
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS query FROM embeddings WHERE vec_id % 100 = 0), v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT query_id, vec_id, label, round(list_dot_product(query, e) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(query, query))), 6) AS sim FROM q CROSS JOIN v WHERE query_id <> vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id)::INT AS place FROM s)"""


@query("embedding_topk", SIMS + " SELECT query_id, vec_id, label, sim, place FROM r WHERE place <= 10")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, queries_of(vectors), TOP)


def match_vectors(vectors: DataFrame, asked: DataFrame, k: int = NEIGHBOURS, top: int = TOP) -> DataFrame:
    """query_id, label, sim, place: the best labels of the k nearest vectors that are known outside the query's own hospital.

    vectors also has mask, the bits of the hospitals that an entry is known from, and asked has own, the query's bit (0: anything is allowed).
    """
    allowed = nearest(vectors, asked, k).where(allowed_outside(F.col("mask"), F.col("own")))  # cut to the neighbours first, then to what is allowed
    best = allowed.groupBy("query_id", "label").agg(F.max("sim").alias("sim"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "label"))).where(F.col("place") <= top)


@query("embedding_topk_by_label", SIMS + """,
l AS (SELECT query_id, label, max(sim) AS sim FROM r WHERE place <= 60 AND ((1::BIGINT << (vec_id % 4)) | CASE WHEN vec_id % 3 = 0 THEN 16 ELSE 0 END) & ~(1::BIGINT << (query_id // 100 % 4)) <> 0 GROUP BY ALL)
SELECT query_id, label, sim, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, label)::INT AS place FROM l) WHERE place <= 10""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    bit = lambda n: F.pow(F.lit(2.0), n).cast("long")
    known = vectors.withColumn("mask", bit(F.col("vec_id") % 4).bitwiseOR(F.when(F.col("vec_id") % 3 == 0, 16).otherwise(0).cast("long")))
    return match_vectors(known, queries_of(vectors).withColumn("own", bit(F.floor(F.col("query_id") / 100) % 4)))


def scored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the answers and scores of three matchers, out of part."""
    k = F.col("p_partkey")
    right = lambda when: F.when(when, F.col("p_brand")).otherwise("none")
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("code"), right((k % 37 > 1) | (k % 41 < 30)).alias("a_code"), ((60 + k % 41) / 100.0).alias("a_score"), right((k % 29 > 2) | (k % 31 < 20)).alias("b_code"),
        ((70 + k % 31) / 100.0).alias("b_sim"), right(k % 2 == 0).alias("llm_code"), F.when(k % 3 == 0, "high").otherwise("low").alias("llm_conf"),
    )


SCORED = """
WITH items AS (
  SELECT p_partkey, p_brand AS code, CASE WHEN p_partkey % 37 > 1 OR p_partkey % 41 < 30 THEN p_brand ELSE 'none' END AS a_code, (60 + p_partkey % 41) / 100.0::DOUBLE AS a_score, CASE WHEN p_partkey % 29 > 2 OR p_partkey % 31 < 20 THEN p_brand ELSE 'none' END AS b_code,
    (70 + p_partkey % 31) / 100.0::DOUBLE AS b_sim, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'none' END AS llm_code, CASE WHEN p_partkey % 3 = 0 THEN 'high' ELSE 'low' END AS llm_conf FROM part),
tiers AS (SELECT *, CASE WHEN a_score >= 0.92 THEN 'exact_fuzzy' WHEN b_sim >= 0.95 THEN 'embedding' WHEN llm_conf = 'high' THEN 'llm' ELSE 'human_review' END AS tier FROM items),
answers AS (SELECT *, CASE tier WHEN 'exact_fuzzy' THEN a_code WHEN 'embedding' THEN b_code WHEN 'llm' THEN llm_code END AS pred FROM tiers)"""


def assign_tiers(items: DataFrame, fuzzy_from: float | None, vector_from: float | None) -> DataFrame:
    """tier and pred: the first tier whose score reaches its threshold (None: never); the language model's only if it is sure."""
    never = F.lit(False)
    first = never if fuzzy_from is None else F.col("a_score") >= fuzzy_from
    second = never if vector_from is None else F.col("b_sim") >= vector_from
    tier = F.when(first, "exact_fuzzy").when(second, "embedding").when(F.col("llm_code").isNotNull() & (F.col("llm_conf") == "high"), "llm").otherwise("human_review")
    answered = items.withColumn("tier", tier)
    pred = F.when(F.col("tier") == "exact_fuzzy", F.col("a_code")).when(F.col("tier") == "embedding", F.col("b_code")).when(F.col("tier") == "llm", F.col("llm_code"))
    return answered.withColumn("pred", pred)


@query("tier_assign", SCORED + " SELECT p_partkey, tier, pred FROM answers")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_tiers(scored_items(spark, sf_dir), 0.92, 0.95).select("p_partkey", "tier", "pred")


@query("tier_summary", SCORED + " SELECT tier, count(*)::BIGINT AS items, CASE WHEN tier <> 'human_review' THEN round(avg((pred = code)::INT), 6) END AS precision FROM answers GROUP BY tier")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = assign_tiers(scored_items(spark, sf_dir), 0.92, 0.95)
    right = F.round(F.avg((F.col("pred") == F.col("code")).cast("int")), 6)
    return answered.groupBy("tier").agg(F.count("*").alias("items"), right.alias("p")).select("tier", "items", F.when(F.col("tier") != "human_review", F.col("p")).alias("precision"))


def annotated(items: DataFrame, catch_all: tuple[str, ...] = CATCH_ALL, suspects: Column | None = None) -> DataFrame:
    """items with catch_all (its code stands for many unlike items) and suspect (its label is doubted)."""
    return items.withColumns({"catch_all": F.coalesce(F.col("code").isin(*catch_all), F.lit(False)), "suspect": F.lit(False) if suspects is None else F.coalesce(suspects, F.lit(False))})


def tier_report(answered: DataFrame) -> DataFrame:
    """subset, n, answered, precision (of what is answered) and recall (of all) of annotated answers: all, without suspects, specific and catch-all codes."""
    subsets = {"all": F.lit(True), "excl_suspect": ~F.col("suspect"), "specific_codes": ~F.col("suspect") & ~F.col("catch_all"), "catch_all_codes": F.col("catch_all")}
    rows = answered.withColumn("subset", F.explode(F.array(*[F.when(c, name) for name, c in subsets.items()]))).where("subset is not null")
    given = F.col("tier") != "human_review"
    right = given & F.coalesce(F.col("pred") == F.col("code"), F.lit(False))
    return rows.groupBy("subset").agg(
        F.count("*").alias("n"), F.count_if(given).alias("answered"), F.round(F.avg(F.when(given, right.cast("int"))), 6).alias("precision"), F.round(F.avg(right.cast("int")), 6).alias("recall")
    )


@query("tier_report", SCORED + """,
a AS (SELECT *, code IN ('Brand#11', 'Brand#12') AS catch_all, p_partkey % 50 = 0 AS suspect, tier <> 'human_review' AS given, (pred IS NOT DISTINCT FROM code AND tier <> 'human_review')::INT AS hit FROM answers),
s AS (SELECT 'all' AS subset, * FROM a UNION ALL SELECT 'excl_suspect', * FROM a WHERE NOT suspect UNION ALL SELECT 'specific_codes', * FROM a WHERE NOT suspect AND NOT catch_all UNION ALL SELECT 'catch_all_codes', * FROM a WHERE catch_all)
SELECT subset, count(*)::BIGINT AS n, count(*) FILTER (given)::BIGINT AS answered, round(avg(hit) FILTER (given), 6) AS precision, round(avg(hit), 6) AS recall FROM s GROUP BY subset""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = annotated(scored_items(spark, sf_dir), ("Brand#11", "Brand#12"), F.col("p_partkey") % 50 == 0)
    return tier_report(assign_tiers(items, 0.92, 0.95))


def threshold_table(items: DataFrame, code: str, score: str) -> DataFrame:
    """threshold, n and precision at each step of the grid."""
    steps = items.withColumn("threshold", F.explode(F.array(*map(F.lit, GRID)))).where(F.col(score) >= F.col("threshold"))
    return steps.groupBy("threshold").agg(F.count("*").alias("n"), F.avg((F.col(code) == F.col("code")).cast("int")).alias("precision"))


def calibrate(items: DataFrame, code: str, score: str, target: float = TARGET, support: int = SUPPORT) -> float | None:
    """The lowest threshold of enough support whose precision reaches the target."""
    return threshold_table(items, code, score).where((F.col("n") >= support) & (F.col("precision") >= target)).agg(F.min("threshold")).first()[0]


STAGES = {"exact_fuzzy": ("a_code", "a_score"), "embedding": ("b_code", "b_sim")}


def calibrate_in_order(items: DataFrame, order: tuple[str, ...]) -> dict[str, float | None]:
    """The threshold of each stage, on what the stages before leave."""
    found: dict[str, float | None] = {}
    for name in order:
        code, score = STAGES[name]
        found[name] = calibrate(items, code, score)
        items = items if found[name] is None else items.where(F.col(score) < found[name])
    return found


@query("threshold_calibration", SCORED + """,
grid(threshold) AS (SELECT unnest([0.7, 0.75, 0.8, 0.85, 0.9, 0.92, 0.95, 0.97, 1.0]::DOUBLE[])),
a AS (SELECT threshold, count(*) AS n, avg((a_code = code)::INT) AS p FROM items JOIN grid ON a_score >= threshold GROUP BY 1), ta AS (SELECT min(threshold) AS t FROM a WHERE n >= 30 AND p >= 0.95),
rest AS (SELECT * FROM items, ta WHERE t IS NULL OR a_score < t), b AS (SELECT threshold, count(*) AS n, avg((b_code = code)::INT) AS p FROM rest JOIN grid ON b_sim >= threshold GROUP BY 1),
c AS (SELECT threshold, count(*) AS n, avg((b_code = code)::INT) AS p FROM items JOIN grid ON b_sim >= threshold GROUP BY 1), tc AS (SELECT min(threshold) AS t FROM c WHERE n >= 30 AND p >= 0.95),
rest2 AS (SELECT * FROM items, tc WHERE t IS NULL OR b_sim < t), d AS (SELECT threshold, count(*) AS n, avg((a_code = code)::INT) AS p FROM rest2 JOIN grid ON a_score >= threshold GROUP BY 1)
SELECT 'exact_fuzzy' AS first, 'exact_fuzzy' AS tier, (SELECT t FROM ta) AS threshold UNION ALL SELECT 'exact_fuzzy', 'embedding', (SELECT min(threshold) FROM b WHERE n >= 30 AND p >= 0.95)
UNION ALL SELECT 'embedding', 'embedding', (SELECT t FROM tc) UNION ALL SELECT 'embedding', 'exact_fuzzy', (SELECT min(threshold) FROM d WHERE n >= 30 AND p >= 0.95)""")
def threshold_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = scored_items(spark, sf_dir)
    rows = [(order[0], name, t) for order in (("exact_fuzzy", "embedding"), ("embedding", "exact_fuzzy")) for name, t in calibrate_in_order(items, order).items()]
    return spark.createDataFrame(rows, "first string, tier string, threshold double")


def seeded_order(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary"))


@query("seeded_sample", "SELECT p_partkey FROM part ORDER BY md5(p_partkey || 'seed7'), p_partkey LIMIT 100")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").orderBy(seeded_order("p_partkey", "seed7"), "p_partkey").limit(100).select("p_partkey")


@query("stratified_sample", "SELECT p_partkey, p_type FROM (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY md5(p_partkey || 'strata'), p_partkey) AS rn FROM part WHERE length(p_name) >= 8) WHERE rn <= 12")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("p_type").orderBy(seeded_order("p_partkey", "strata"), "p_partkey")
    return read(spark, sf_dir, "part").where(F.length("p_name") >= 8).withColumn("rn", F.row_number().over(order)).where("rn <= 12").select("p_partkey", "p_type")


QUOTAS = {"cpt_numeric": 25, "ms_drg": 20, "drug_J": 15, "device_or_other_hcpcs": 10, "other": 5}


def stratified_items(items: DataFrame, quotas: dict[str, int], seed: str) -> DataFrame:
    """Of the distinct (hospital_slug, text) of items, each with its first family, as many a family as its quota, by a seeded hash."""
    distinct = items.groupBy("hospital_slug", "text").agg(F.min("family").alias("family"))
    order = Window.partitionBy("family").orderBy(F.md5(F.concat_ws("|", "hospital_slug", "text", F.lit(seed)).cast("binary")), "hospital_slug", "text")
    quota = F.lit(0)
    for family, n in quotas.items():
        quota = F.when(F.col("family") == family, n).otherwise(quota)
    return distinct.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= quota).drop("rn")


@query("stratified_families", RAW + f""",
n AS (SELECT * FROM {normalized_sql('raw', 'raw', 'p_partkey')}),
d AS (SELECT 'h' || (p_partkey % 25) AS hospital_slug, text, min(CASE p_partkey % 6 WHEN 0 THEN 'cpt_numeric' WHEN 1 THEN 'ms_drg' WHEN 2 THEN 'drug_J' WHEN 3 THEN 'device_or_other_hcpcs' ELSE 'other' END) AS family FROM n GROUP BY 1, 2)
SELECT hospital_slug, text, family FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY md5(hospital_slug || '|' || text || '|dev'), hospital_slug, text) AS rn FROM d)
WHERE rn <= CASE family WHEN 'cpt_numeric' THEN 25 WHEN 'ms_drg' THEN 20 WHEN 'drug_J' THEN 15 WHEN 'device_or_other_hcpcs' THEN 10 ELSE 5 END""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    code = F.when(k % 6 == 0, "99213").when(k % 6 == 1, "470").when(k % 6 == 2, " j1885").when(k % 6 == 3, "C1713").when(k % 6 == 4, "ZZ")
    items = read(spark, sf_dir, "part").select(F.concat(F.lit("h"), (k % 25).cast("string")).alias("hospital_slug"), normalize_text(raw_text()).alias("text"), code_family(code).alias("family"))
    return stratified_items(items, QUOTAS, "dev")


@query("exclude_train_ids", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM part ORDER BY md5(p_partkey || 'train'), p_partkey LIMIT 50)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey")
    return part.join(part.orderBy(seeded_order("p_partkey", "train"), "p_partkey").limit(50), "p_partkey", "left_anti")

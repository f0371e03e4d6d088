"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key -ln(u) / q, where u is a uniform number hashed from its id and q its
quality weight: ascending keys are a weighted random order without replacement. A source's target is met by whole
passes over all its documents (epochs), then by the documents of smallest key whose sizes, summed in key order,
come nearest to what is left.

The order is never sorted as a whole. Keys fall in a fixed number of bins; the sums by (source, bin) find each
source's boundary bin, and only that bin's rows are sorted by a window. What is left is one cut-off key for each
source, so documents are marked by a join with one row a source, however many documents a source holds.

Defined results: a null text has size 0; null sources form one source, sorted last; a document of size 0 is taken 0
times; rows that repeat a doc_id have the same key and are taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, free_name, let, small_side, table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most so many times.
MAX_EPOCHS = 3
SEED = "mix-1"
#: Bins of the key order; a boundary bin holds about 1/BINS of its source.
BINS = 4096


def size_of(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Quality weight in [0.25, 1]: 1 at six characters a word (space included), less as the mean departs from it."""
    mean = F.coalesce(F.length(text), F.lit(0)).cast("double") / size.cast("double")
    return F.when(size > 0, F.greatest(F.lit(0.25), F.lit(1.0) - F.abs(mean - F.lit(6.0)) / F.lit(12.0))).otherwise(F.lit(0.25))


def key_of(doc_id: Column, quality: Column, seed: str = SEED) -> Column:
    """-ln(u) / quality with u in (0, 1) from 52 bits of an MD5 of the id."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / quality


def source_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, bins: int = BINS) -> tuple[DataFrame, int]:
    """source, source_size, target, epochs, cut_bin, cut_key of each source of sized (source, size, mix_key); and their number.

    Water filling: a target is min(max_epochs * source_size, level * weight), where level is such that targets add up
    to share of all sizes: with the sources in the order of cap / weight and the first j at their caps it is what is left over the weights left,
    and the greatest such level that lets source j stay under its cap is the one. Documents in bins before cut_bin, and with keys up to cut_key, are taken once more than epochs
    (nulls: none is).
    """
    by_bin = cut(
        sized.withColumn("bin", F.floor((F.lit(1.0) - F.exp(-F.col("mix_key"))) * F.lit(bins)).cast("int"))
        .groupBy("source", "bin")
        .agg(F.sum("size").alias("bin_size"))
    )
    totals = by_bin.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    capped = totals.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levelled = capped.withColumn("level", level)
    levelled = levelled.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything))
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double"))
    plan = levelled.withColumn("target", target).withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0)).cast("long"))
    plan = cut(plan.select("source", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("left")))

    n = plan.count()
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    before = F.sum("bin_size").over(Window.partitionBy("source").orderBy("bin")) - F.col("bin_size")
    bound = (
        by_bin.withColumn("bin_before", before).alias("b").join(small_side(plan, n, 256).alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        .where((F.col("bin_before") < F.col("left")) & (F.col("bin_before") + F.col("bin_size") >= F.col("left")))
        .select(F.col("b.source").alias("source"), "bin", "bin_before", "left")
    )
    rows = sized.withColumn("bin", F.floor((F.lit(1.0) - F.exp(-F.col("mix_key"))) * F.lit(bins)).cast("int"))
    rows = rows.join(small_side(bound, n, 256), rows["source"].eqNullSafe(bound["source"]) & (rows["bin"] == bound["bin"])).select(rows["source"], "size", "mix_key", "bin_before", "left")
    upto = F.col("bin_before") + F.sum("size").over(Window.partitionBy("source").orderBy("mix_key"))
    near = rows.withColumn("upto", upto).withColumn("own", F.sum("size").over(Window.partitionBy("source", "mix_key")))
    chosen = near.where(F.col("upto") - F.col("own") / 2 <= F.col("left")).groupBy("source").agg(F.max("mix_key").alias("cut_key"))
    edge = bound.alias("e").join(chosen.alias("c"), F.col("e.source").eqNullSafe(F.col("c.source")), "left").select(F.col("e.source").alias("source"), F.col("bin").alias("cut_bin"), "cut_key")
    out = plan.alias("p").join(edge.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
    return cut(out.select(F.col("p.source").alias("source"), "source_size", "target", "epochs", "cut_bin", "cut_key")), n


def times_of(key: Column, plan: Column, bins: int = BINS) -> Column:
    """How often a document of that key is taken by its source's plan (a struct of epochs, cut_bin, cut_key)."""
    own = F.floor((F.lit(1.0) - F.exp(-key)) * F.lit(bins)).cast("int")
    extra = (own < plan["cut_bin"]) | (key <= plan["cut_key"])
    return (plan["epochs"] + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)).cast("long")


def sized_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and mix_key of each document."""
    size = docs.select("doc_id", "source", "text", size_of(F.col("text")).alias("size"))
    return size.select("doc_id", "source", "size", key_of(F.col("doc_id"), quality_of(F.col("text"), F.col("size")), seed).alias("mix_key"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, times and taken (times * size) of each document."""
    sized = cut(sized_documents(docs, seed))
    plan, n = source_plan(sized, weights, share, max_epochs)
    marked = sized.join(small_side(plan, n, 256), sized["source"].eqNullSafe(plan["source"]))
    times = F.when(F.col("size") > 0, times_of(F.col("mix_key"), F.struct("epochs", "cut_bin", "cut_key"))).otherwise(F.lit(0).cast("long"))
    return marked.select("doc_id", sized["source"], "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of docs, each as often as the mix takes it (0 times: not at all), with the columns of docs, whatever their names."""
    sized = cut(sized_documents(docs, seed))
    plan, n = source_plan(sized, weights, share, max_epochs)
    of, held, copy = (free_name(docs, c) for c in ("mix_source", "mix_plan", "mix_copy"))
    plan = plan.select(F.col("source").alias(of), F.struct("epochs", "cut_bin", "cut_key").alias(held))
    joined = docs.join(small_side(plan, n, 256), F.col("source").eqNullSafe(F.col(of)))
    text = F.col("text")
    times = lambda size: F.when(size > 0, let(key_of(F.col("doc_id"), quality_of(text, size), seed), lambda key: times_of(key, F.col(held)))).otherwise(F.lit(0).cast("long"))
    copies = F.explode(F.array_repeat(F.lit(1), let(size_of(text), times).cast("int")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias(copy)).drop(copy)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, coalesce(length(text), 0) AS chars
  FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix-1'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / CASE WHEN size > 0 THEN greatest(0.25, 1.0 - abs(chars::DOUBLE / size::DOUBLE - 6.0::DOUBLE) / 12.0::DOUBLE) ELSE 0.25::DOUBLE END AS mix_key
  FROM sized),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
capped AS (
  SELECT *, ([5, 2, 1])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight, source_size * 3 AS cap FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM capped),
level AS (SELECT max(level) AS level FROM levels WHERE level <= cap::DOUBLE / weight),
plan AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, l.level * weight), cap::DOUBLE) AS target FROM capped CROSS JOIN level l),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END AS epochs FROM plan),
ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS left_over,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.mix_key)::DOUBLE AS upto, sum(k.size) OVER (PARTITION BY k.source, k.mix_key)::DOUBLE AS own
  FROM keyed k JOIN parts p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN upto - own / 2 <= left_over THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM ordered
"""

QUERIES = {"op8_source_mix": op8_source_mix}
ORACLES = {"op8_source_mix": ORACLE_SQL}

"""SCD2 history: staging, snapshot diff, merge, point-in-time reads and the synthetic second version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.plans.pricefacts import ATTRIBUTES, KEY, STAGED, row_hash, row_id, stage
from quillstone.plans.registry import query
from quillstone.plans.store import current, prices

HISTORY = ("row_id", "key_hash", *KEY, "dup_seq", *ATTRIBUTES, "row_hash", "first_source_sha256", "effective_from", "effective_to", "is_current", "closed_by_source_sha256", "change_reason")
T1, T2 = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def initial(staged: DataFrame, version: str, moment: str) -> DataFrame:
    """A first snapshot: every row is current."""
    none = lambda kind: F.lit(None).cast(kind)
    return staged.withColumns({
        "row_id": row_id(version), "first_source_sha256": F.lit(version), "effective_from": at(moment), "effective_to": none("timestamp_ntz"),
        "is_current": F.lit(True), "closed_by_source_sha256": none("string"), "change_reason": none("string"),
    }).select(*HISTORY)


def diff(history: DataFrame, staged: DataFrame, version: str, moment: str, *carry: str, columns: tuple[str, ...] = HISTORY) -> DataFrame:
    """The current rows of a history and the rows of a new snapshot as the history will hold them: columns, carry and action (keep, close, insert).

    One full outer join on the key: a changed key gives its closed and its new row. carry: further columns of history, null for new rows.
    columns: those of HISTORY that are asked for; others that the comparison doesn't need are not shuffled.
    """
    both = history.where("is_current").alias("c").join(staged.alias("s"), F.col("c.key_hash") == F.col("s.key_hash"), "full_outer")
    gone, new = F.col("s.key_hash").isNull(), F.col("c.key_hash").isNull()
    differs = gone | new | (F.col("s.row_hash") != F.col("c.row_hash"))
    none = lambda kind: F.lit(None).cast(kind)
    closing = {
        "effective_to": F.when(differs, at(moment)), "is_current": ~differs, "closed_by_source_sha256": F.when(differs, F.lit(version)),
        "change_reason": F.when(gone, "removed").when(differs, "changed"), "action": F.when(differs, "close").otherwise("keep"),
    }
    opening = {
        "row_id": F.md5(F.concat("s.key_hash", F.lit("|" + version)).cast("binary")), "first_source_sha256": F.lit(version), "effective_from": at(moment), "effective_to": none("timestamp_ntz"),
        "is_current": F.lit(True), "closed_by_source_sha256": none("string"), "change_reason": none("string"), "action": F.lit("insert"),
    } | {c: none(history.schema[c].dataType) for c in carry}
    row = lambda side, made: F.struct(*[made.get(c, F.col(f"{side}.{c}")).alias(c) for c in (*columns, *carry, "action")])
    pair = F.array(F.when(~new, row("c", closing)), F.when(~gone & differs, row("s", opening)))
    return both.select(F.explode(pair).alias("r")).where("r is not null").select("r.*")


def changes(history: DataFrame, staged: DataFrame, version: str, moment: str) -> DataFrame:
    """Closing and inserted rows of a new snapshot, with action close or insert."""
    return diff(history, staged, version, moment).where("action <> 'keep'")


def merge(history: DataFrame, staged: DataFrame, version: str, moment: str, columns: tuple[str, ...] = HISTORY) -> DataFrame:
    """columns of history after a new snapshot: closed rows replaced, new rows added, all others as they are."""
    return diff(history, staged, version, moment, columns=columns).drop("action").unionByName(history.where("not is_current").select(*columns))


def as_of(history: DataFrame, moment: str) -> DataFrame:
    """Rows in force at a moment."""
    return history.where((F.col("effective_from") <= at(moment)) & (F.col("effective_to").isNull() | (F.col("effective_to") > at(moment))))


def hash_part(modulus: int) -> Column:
    """A number below modulus from the key's hash, the same in every engine."""
    return F.conv(F.substring("key_hash", 1, 6), 16, 10).cast("long") % modulus


def second_version(staged: DataFrame) -> DataFrame:
    """2 % of the rows cost a tenth more, 1 % are gone, 1 % come again as new items."""
    part = hash_part(100)
    kept = staged.where(part != 2).withColumn("amount", F.when(part < 2, (F.col("amount") * F.lit(1.1).cast("decimal(2,1)")).cast("decimal(14,4)")).otherwise(F.col("amount")))
    kept = kept.withColumn("row_hash", row_hash())
    again = staged.where(part == 3).withColumn("description", F.concat("description", F.lit(" (new)"))).withColumn("key_hash", F.md5(F.concat("key_hash", F.lit("new")).cast("binary")))
    return kept.unionByName(again)


def both_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    staged = current(spark, sf_dir).drop("row_id")
    return initial(staged, "v1", T1), second_version(staged)


V2 = STAGED + """,
part AS (SELECT *, ('0x' || substr(key_hash, 1, 6))::BIGINT % 100 AS p FROM staged),
kept AS (SELECT * REPLACE (CASE WHEN p < 2 THEN (amount * 1.1)::DECIMAL(14,4) ELSE amount END AS amount) FROM part WHERE p <> 2),
v2 AS MATERIALIZED (
  SELECT * EXCLUDE (p) REPLACE (md5(concat_ws(chr(31), amount::VARCHAR, coalesce(methodology, ''), coalesce(modifiers, ''), coalesce(alt_codes, ''))) AS row_hash) FROM kept
  UNION ALL BY NAME SELECT * EXCLUDE (p) REPLACE (description || ' (new)' AS description, md5(key_hash || 'new') AS key_hash) FROM part WHERE p = 3),
h1 AS (SELECT *, 'v1' AS first_source_sha256, TIMESTAMP '2026-01-01' AS effective_from FROM cur),
closing AS MATERIALIZED (
  SELECT c.row_id, c.key_hash, c.hospital_slug, c.amount, c.effective_from, TIMESTAMP '2026-02-01' AS effective_to, false AS is_current,
    CASE WHEN s.key_hash IS NULL THEN 'removed' ELSE 'changed' END AS change_reason, 'close' AS action
  FROM h1 c LEFT JOIN v2 s ON s.key_hash = c.key_hash WHERE s.key_hash IS NULL OR s.row_hash <> c.row_hash),
inserts AS MATERIALIZED (
  SELECT md5(s.key_hash || '|v2') AS row_id, s.key_hash, s.hospital_slug, s.amount, TIMESTAMP '2026-02-01' AS effective_from, NULL::TIMESTAMP AS effective_to, true AS is_current, NULL::VARCHAR AS change_reason, 'insert' AS action
  FROM v2 s LEFT JOIN h1 c ON s.key_hash = c.key_hash WHERE c.key_hash IS NULL OR c.row_hash <> s.row_hash),
chg AS (SELECT * FROM closing UNION ALL SELECT * FROM inserts),
h2 AS (
  SELECT row_id, key_hash, hospital_slug, amount, effective_from, NULL::TIMESTAMP AS effective_to, true AS is_current, NULL::VARCHAR AS change_reason FROM h1 WHERE NOT EXISTS (SELECT 1 FROM closing c WHERE c.row_id = h1.row_id)
  UNION ALL SELECT * EXCLUDE (action) FROM chg)"""
SHORT = ("row_id", "key_hash", "hospital_slug", "amount", "effective_from", "effective_to", "is_current", "change_reason")


@query("stage_keys", STAGED + " SELECT hospital_slug, description, code, price_type, amount, dup_seq, key_hash, row_hash FROM staged")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(prices(spark, sf_dir)).select("hospital_slug", "description", "code", "price_type", "amount", "dup_seq", "key_hash", "row_hash")


@query("stage_dup_seq", STAGED + " SELECT dup_seq, count(*)::BIGINT AS n FROM staged GROUP BY dup_seq")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(prices(spark, sf_dir)).groupBy("dup_seq").agg(F.count("*").alias("n"))


@query("stage_stats", STAGED + " SELECT (SELECT count(*) FROM price)::BIGINT AS rows_in, count(*)::BIGINT AS staged_rows, ((SELECT count(*) FROM price) - count(*))::BIGINT AS collapsed, count(*) FILTER (dup_seq > 0)::BIGINT AS key_conflicts FROM staged")
def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = prices(spark, sf_dir)
    rows_in = facts.agg(F.count("*").alias("rows_in"))
    staged = stage(facts).agg(F.count("*").alias("staged_rows"), F.count_if(F.col("dup_seq") > 0).alias("key_conflicts"))
    return rows_in.join(staged, how="inner").select("rows_in", "staged_rows", (F.col("rows_in") - F.col("staged_rows")).alias("collapsed"), "key_conflicts")


@query("scd2_initial", V2 + " SELECT row_id, key_hash, hospital_slug, amount, effective_from, NULL::TIMESTAMP AS effective_to, true AS is_current, NULL::VARCHAR AS change_reason FROM h1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_versions(spark, sf_dir)[0].select(*SHORT)


@query("synthetic_v2", V2 + " SELECT key_hash, description, amount, row_hash FROM v2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_versions(spark, sf_dir)[1].select("key_hash", "description", "amount", "row_hash")


@query("scd2_changes", V2 + " SELECT * FROM chg")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    return changes(first, second, "v2", T2).select(*SHORT, "action")


@query("scd2_unchanged", V2 + " SELECT h1.hospital_slug, count(*)::BIGINT AS n FROM h1 JOIN v2 USING (key_hash) WHERE h1.row_hash = v2.row_hash GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    same = first.select("key_hash", "row_hash", "hospital_slug").join(second.select("key_hash", "row_hash"), ["key_hash", "row_hash"])
    return same.groupBy("hospital_slug").agg(F.count("*").alias("n"))


@query("scd2_counts", V2 + " SELECT action, coalesce(change_reason, 'new') AS reason, count(*)::BIGINT AS n FROM chg GROUP BY 1, 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    return changes(first, second, "v2", T2).groupBy("action", F.coalesce("change_reason", F.lit("new")).alias("reason")).agg(F.count("*").alias("n"))


@query("scd2_merge", V2 + " SELECT * FROM h2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    return merge(first, second, "v2", T2).select(*SHORT)


@query("scd2_current", V2 + " SELECT row_id, key_hash, amount FROM h2 WHERE is_current")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    return merge(first, second, "v2", T2, ("row_id", "key_hash", "amount", "is_current")).where("is_current").drop("is_current")


@query("scd2_as_of", V2 + " SELECT row_id, amount FROM h2 WHERE effective_from <= TIMESTAMP '2026-01-15' AND (effective_to IS NULL OR effective_to > TIMESTAMP '2026-01-15')")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = both_versions(spark, sf_dir)
    return as_of(merge(first, second, "v2", T2), "2026-01-15 00:00:00").select("row_id", "amount")


@query("replace_projection", STAGED + " SELECT * REPLACE ((amount * 2)::DECIMAL(14,4) AS amount) FROM (SELECT key_hash, amount, price_type FROM staged)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(spark, sf_dir).select("key_hash", "amount", "price_type").withColumn("amount", (F.col("amount") * 2).cast("decimal(14,4)"))


@query("hash_sample", STAGED + " SELECT key_hash, hospital_slug FROM staged WHERE ('0x' || substr(key_hash, 1, 6))::BIGINT % 1000 < 50")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(spark, sf_dir).where(hash_part(1000) < 50).select("key_hash", "hospital_slug")

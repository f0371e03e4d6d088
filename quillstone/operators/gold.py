"""Star schema, comparison marts, quality scores, data checks and reports over the current price facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.peers import GROUPS, flags, group_medians, median
from quillstone.plans.pricefacts import STANDARD_CODES, read
from quillstone.plans.registry import query
from quillstone.plans.store import current, current_table, fact, pruned, scored

DIM_CODES = (*STANDARD_CODES, "APR-DRG", "ICD-10-PCS", "NDC")
COMPONENTS = ("completeness", "validity", "consistency", "freshness")
AS_OF = "2026-10-01"
CURRENT_TEMPLATE = "3.0.0"


def unknown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("unknown")) for c in ("setting", "billing_class")})


def flagged_facts(cur: DataFrame, scored_rows: DataFrame) -> DataFrame:
    """Current prices with the flag of those that could be scored."""
    flagged = flags(scored_rows).select("row_id", F.col("any_rule").alias("is_flagged"), F.col("r1_robust_z").alias("flag_peer_outlier"))
    return unknown(cur).join(flagged, "row_id", "left")


def fact_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


def decimals(value: Column, digits: int) -> Column:
    """value rounded half up as decimals are, so that binary fractions just under a half don't round down."""
    return F.round(value.cast("decimal(30,9)"), digits).cast("double")


def parse_date(text: Column) -> Column:
    """Y-m-d, m/d/Y or Y/m/d; null for anything else."""
    found = [F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in ("yyyy-M-d", "M/d/yyyy", "yyyy/M/d")]
    return F.coalesce(*found)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a hospital: name, state and what its last run and profile say."""
    nation = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    dated = F.when(k % 4 == 0, "2026-03-01").when(k % 4 == 1, "7/1/2026").when(k % 4 == 2, "2025/1/15").otherwise("soon")
    return nation.select(
        F.concat(F.lit("h"), k.cast("string")).alias("hospital_slug"), F.col("n_name").alias("hospital_name"), F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
        (k * 7).cast("long").alias("rejects"), F.lit(1000).cast("long").alias("rows_out"), dated.alias("last_updated_on"), F.when(k % 3 == 0, "3.0.0").otherwise("2.0.0").alias("declared_version"),
    )


def items(cur: DataFrame) -> DataFrame:
    """Which price types an item has, and its median gross, min and max."""
    na = lambda c: F.coalesce(F.col(c), F.lit("na")).alias(c)
    has = lambda kind: F.bool_or(F.col("price_type") == kind).alias(f"has_{kind}")
    mid = lambda kind: median(F.when(F.col("price_type") == kind, F.col("amount").cast("double"))).alias(f"med_{kind}")
    grouped = cur.groupBy("hospital_slug", "code", "description", na("setting"), na("billing_class"))
    return grouped.agg(F.min("code_type").alias("code_type"), *[has(k) for k in ("gross", "cash", "min", "max", "negotiated")], *[mid(k) for k in ("gross", "min", "max")])


def share(c: Column, where: Column | None = None) -> Column:
    """Mean of a boolean as 0 or 1; nulls, and rows outside where, are not counted."""
    value = c.cast("int")
    return F.avg(value if where is None else F.when(where, value))


def row_rates(cur: DataFrame) -> DataFrame:
    """Violation rates of each hospital's rows against their items; a comparison with a missing bound that does not fail is not counted."""
    na = lambda c: F.coalesce(F.col(c), F.lit("na")).alias(c)
    rows = cur.select("hospital_slug", "code", "description", na("setting"), na("billing_class"), "price_type", F.col("amount").cast("double").alias("amount"), F.col("amount").cast("string").alias("digits"))
    joined = rows.join(items(cur).drop("code_type"), ["hospital_slug", "code", "description", "setting", "billing_class"])
    a, kind, gross, mn, mx = F.col("amount"), F.col("price_type"), F.col("med_gross"), F.col("med_min"), F.col("med_max")
    sentinel = ((a == 1) & kind.isin("negotiated", "cash") & (gross >= 100)) | ((a >= 99999) & F.col("digits").rlike("^9{5,}"))
    return joined.groupBy("hospital_slug").agg(
        F.count("*").alias("price_rows"),
        share(a > 1.10 * gross, (kind == "negotiated") & gross.isNotNull()).alias("neg_gt_gross"),
        share((a < 0.9 * mn) | (a > 1.1 * mx), (kind == "negotiated") & (mn.isNotNull() | mx.isNotNull())).alias("out_of_range"),
        share(a > 1.10 * gross, (kind == "cash") & gross.isNotNull()).alias("cash_gt_gross"),
        share(sentinel).alias("sentinel"),
    )


def item_rates(cur: DataFrame) -> DataFrame:
    has = [share(F.col(f"has_{k}")).alias(f"has_{k}") for k in ("gross", "cash", "min", "max", "negotiated")]
    both = F.col("med_min").isNotNull() & F.col("med_max").isNotNull()
    standard = share(F.col("code_type").isin(*DIM_CODES[:3])).alias("standard")
    return items(cur).groupBy("hospital_slug").agg(F.count("*").alias("items"), *has, standard, share(F.col("med_min") > F.col("med_max"), both).alias("min_gt_max"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four components and the score (mean, times 100) of each hospital; what cannot be evaluated counts as no violation."""
    cur = current(spark, sf_dir)
    joined = item_rates(cur).join(row_rates(cur), "hospital_slug").join(registry(spark, sf_dir), "hospital_slug")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    reject = F.col("rejects") / F.greatest(F.col("rows_out") + F.col("rejects"), F.lit(1))
    days = F.datediff(F.lit(AS_OF).cast("date"), parse_date(F.col("last_updated_on")))
    recent = F.coalesce(F.greatest(F.lit(0.0), 1 - days / 365), F.lit(0.0))
    template = (F.col("declared_version") == CURRENT_TEMPLATE).cast("double")
    found = joined.withColumns({
        "completeness": (F.col("has_gross") + F.col("has_cash") + F.col("has_min") + F.col("has_max") + F.col("has_negotiated")) / 5,
        "validity": ((1 - reject) + (1 - z("sentinel")) + F.col("standard")) / 3,
        "consistency": ((1 - z("neg_gt_gross")) + (1 - z("out_of_range")) + (1 - z("cash_gt_gross")) + (1 - z("min_gt_max"))) / 4,
        "freshness": (recent + template) / 2,
        "days_since_update": days,
    })
    mean = (F.col("completeness") + F.col("validity") + F.col("consistency") + F.col("freshness")) / 4
    return found.withColumns({"quality_score": decimals(mean * 100, 1), **{c: decimals(F.col(c), 4) for c in COMPONENTS}})


def band(score: Column) -> Column:
    return F.when(score >= 90, "good").when(score >= 75, "fair").otherwise("needs review")


def dim_hospital(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospitals with their latest quality row; here each has a run of AS_OF and one of a year before."""
    runs = quality(spark, sf_dir).select("hospital_slug", "quality_score", *COMPONENTS, "days_since_update", F.explode(F.array(F.lit(AS_OF), F.lit("2025-10-01"))).alias("as_of"))
    latest = runs.withColumn("rn", F.row_number().over(Window.partitionBy("hospital_slug").orderBy(F.desc("as_of")))).where("rn = 1").drop("rn")
    return registry(spark, sf_dir).select("hospital_slug", "hospital_name", "state").join(latest, "hospital_slug", "left")


def dim_procedure_code(cur: DataFrame) -> DataFrame:
    rows = cur.where(F.col("code_type").isin(*DIM_CODES))
    return rows.groupBy("code", "code_type").agg(F.min("description").alias("example_description"), F.count_distinct("hospital_slug").alias("hospital_count"), F.count("*").alias("price_row_count"))


def price_comparison(facts: DataFrame, at_most: int | None = None) -> DataFrame:
    """Spread of each (code, price type) over hospitals and payers. at_most: the number of facts, if known."""
    keys = ("code", "code_type", "price_type")
    rows = facts.where(F.col("code_type").isin(*STANDARD_CODES)).withColumn("price", F.col("amount").cast("double"))
    out = rows.groupBy(*keys).agg(
        F.min("description").alias("example_description"), F.count("*").alias("n_prices"), F.count_distinct("hospital_slug").alias("n_hospitals"), F.count_distinct("payer").alias("n_payers"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), decimals(F.stddev_pop("price"), 2).alias("stddev_amount"), F.count_if(F.coalesce("is_flagged", F.lit(False))).alias("n_flagged"),
    )
    medians = group_medians(rows, keys, "price", "median", at_most)
    return out.where(F.col("n_hospitals") >= 2).join(medians, [*keys]).withColumn("median_amount", decimals(F.col("median"), 2)).drop("median")


def price_spread(facts: DataFrame, cur: DataFrame, code: str | None = None, at_most: int | None = None) -> DataFrame:
    """Comparison rows with ratios; of one code, or of all."""
    rows = price_comparison(facts if code is None else facts.where(F.col("code") == code), at_most)
    dims = dim_procedure_code(cur).select("code", "code_type", F.col("example_description").alias("example"))
    lowest, highest = F.col("min_amount").cast("double"), F.col("max_amount").cast("double")
    ratio = F.when(F.col("min_amount") > 0, decimals(highest / lowest, 1))
    return rows.join(dims, ["code", "code_type"]).select("code", "code_type", "example", "price_type", "n_hospitals", "n_payers", "n_prices", "min_amount", "median_amount", "max_amount", ratio.alias("max_to_min_ratio"), decimals(100.0 * F.col("n_flagged") / F.col("n_prices"), 2).alias("pct_flagged"))


def hospital_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fact_price(spark, sf_dir).groupBy("hospital_slug").agg(F.count("row_id").alias("total_prices"), F.count_if(F.coalesce("is_flagged", F.lit(False))).alias("flagged_prices"))
    joined = dim_hospital(spark, sf_dir).join(facts, "hospital_slug", "left").fillna(0, ["total_prices", "flagged_prices"])
    return joined.withColumn("pct_flagged", decimals(F.try_divide(100.0 * F.col("flagged_prices"), F.nullif("total_prices", F.lit(0))), 2)).withColumn("quality_band", band(F.col("quality_score")))


REG = """,
reg AS (
  SELECT concat('h', n_nationkey) AS hospital_slug, n_name AS hospital_name, concat('S', n_regionkey) AS state, (n_nationkey * 7)::BIGINT AS rejects, 1000::BIGINT AS rows_out,
    CASE n_nationkey % 4 WHEN 0 THEN DATE '2026-03-01' WHEN 1 THEN DATE '2026-07-01' WHEN 2 THEN DATE '2025-01-15' END AS updated, (n_nationkey % 3 = 0)::INT::DOUBLE AS template FROM nation),
kinds AS MATERIALIZED (
  SELECT hospital_slug, code, description, ifnull(setting, 'na') AS s, ifnull(billing_class, 'na') AS b, price_type, min(code_type) AS code_type, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS middle FROM cur GROUP BY ALL),
item AS MATERIALIZED (
  SELECT hospital_slug, code, description, s, b, min(code_type) AS code_type, list_contains(list(price_type), 'gross') AS has_gross, list_contains(list(price_type), 'cash') AS has_cash, list_contains(list(price_type), 'min') AS has_min,
    list_contains(list(price_type), 'max') AS has_max, list_contains(list(price_type), 'negotiated') AS has_negotiated, max(CASE price_type WHEN 'gross' THEN middle END) AS gross, max(CASE price_type WHEN 'min' THEN middle END) AS mn,
    max(CASE price_type WHEN 'max' THEN middle END) AS mx FROM kinds GROUP BY hospital_slug, code, description, s, b),
ishare AS (
  SELECT hospital_slug, count(*)::BIGINT AS items, sum(has_gross::INT) / count(*) AS has_gross, sum(has_cash::INT) / count(*) AS has_cash, sum(has_min::INT) / count(*) AS has_min, sum(has_max::INT) / count(*) AS has_max,
    sum(has_negotiated::INT) / count(*) AS has_negotiated, sum(list_contains(['HCPCS', 'MS-DRG', 'CPT'], code_type)::INT) / count(*) AS standard, sum((mn > mx)::INT) / nullif(count(mn - mx), 0) AS min_gt_max FROM item GROUP BY hospital_slug),
against AS (
  SELECT c.hospital_slug, c.price_type, CAST(c.amount AS DOUBLE) AS a, starts_with(CAST(c.amount AS VARCHAR), '99999') AS nines, i.gross, i.mn, i.mx
  FROM cur c JOIN item i ON (i.hospital_slug, i.code, i.description, i.s, i.b) = (c.hospital_slug, c.code, c.description, ifnull(c.setting, 'na'), ifnull(c.billing_class, 'na'))),
judged AS (
  SELECT hospital_slug, CASE price_type WHEN 'negotiated' THEN (a > gross * 1.1::DOUBLE)::INT END AS above, CASE price_type WHEN 'cash' THEN (a > gross * 1.1::DOUBLE)::INT END AS cash_above,
    CASE WHEN price_type = 'negotiated' AND coalesce(mn, mx) IS NOT NULL THEN (a < mn * 0.9::DOUBLE OR a > mx * 1.1::DOUBLE)::INT END AS outside,
    ((gross >= 100 AND a = 1 AND list_contains(['cash', 'negotiated'], price_type)) OR (nines AND a >= 99999))::INT AS placeholder FROM against),
rrate AS (SELECT hospital_slug, count(*)::BIGINT AS price_rows, avg(above) AS neg_gt_gross, avg(outside) AS out_of_range, avg(cash_above) AS cash_gt_gross, avg(placeholder) AS sentinel FROM judged GROUP BY hospital_slug),
comp AS (
  SELECT *, (has_gross + has_cash + has_min + has_max + has_negotiated) / 5 AS c1, (rows_out / greatest(rows_out + rejects, 1) + 1 - ifnull(sentinel, 0) + standard) / 3 AS c2,
    1 - (ifnull(neg_gt_gross, 0) + ifnull(out_of_range, 0) + ifnull(cash_gt_gross, 0) + ifnull(min_gt_max, 0)) / 4 AS c3, date_diff('day', updated, DATE '2026-10-01') AS days_since_update,
    (ifnull(greatest(0.0::DOUBLE, 1 - date_diff('day', updated, DATE '2026-10-01') / 365.0::DOUBLE), 0) + template) / 2 AS c4
  FROM ishare JOIN rrate USING (hospital_slug) JOIN reg USING (hospital_slug)),
qual AS MATERIALIZED (
  SELECT *, round(((c1 + c2 + c3 + c4) / 4 * 100)::DECIMAL(30,9), 1)::DOUBLE AS quality_score, round(c1::DECIMAL(30,9), 4)::DOUBLE AS completeness, round(c2::DECIMAL(30,9), 4)::DOUBLE AS validity, round(c3::DECIMAL(30,9), 4)::DOUBLE AS consistency,
    round(c4::DECIMAL(30,9), 4)::DOUBLE AS freshness FROM comp),
dimh AS (SELECT reg.hospital_slug, reg.hospital_name, reg.state, '2026-10-01' AS as_of, quality_score, completeness, validity, consistency, freshness, days_since_update FROM reg LEFT JOIN qual USING (hospital_slug)),
fact AS MATERIALIZED (SELECT c.* REPLACE (ifnull(c.setting, 'unknown') AS setting, ifnull(c.billing_class, 'unknown') AS billing_class), f.any_rule AS is_flagged, f.r1_robust_z AS flag_peer_outlier FROM cur c LEFT JOIN flagged f USING (row_id)),
dimp AS (
  SELECT code, code_type, min(description) AS example_description, count(DISTINCT hospital_slug)::BIGINT AS hospital_count, count(*)::BIGINT AS price_row_count FROM cur
  WHERE code_type IN ('NDC', 'ICD-10-PCS', 'APR-DRG', 'MS-DRG', 'HCPCS', 'CPT') GROUP BY ALL),
mart AS (
  SELECT * FROM (
    SELECT code, code_type, price_type, min(description) AS example_description, count(*)::BIGINT AS n_prices, count(DISTINCT hospital_slug)::BIGINT AS n_hospitals, count(DISTINCT payer)::BIGINT AS n_payers, min(amount) AS min_amount,
      round(quantile_cont(CAST(amount AS DOUBLE), 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_amount, max(amount) AS max_amount, round(stddev_pop(CAST(amount AS DOUBLE))::DECIMAL(30,9), 2)::DOUBLE AS stddev_amount,
      sum(ifnull(is_flagged, false)::INT)::BIGINT AS n_flagged FROM fact WHERE list_contains(['HCPCS', 'MS-DRG', 'CPT'], code_type) GROUP BY ALL) WHERE n_hospitals > 1),
hq AS (
  SELECT d.*, ifnull(total_prices, 0)::BIGINT AS total_prices, ifnull(flagged_prices, 0)::BIGINT AS flagged_prices, round((100.0::DOUBLE * flagged_prices / nullif(total_prices, 0))::DECIMAL(30,9), 2)::DOUBLE AS pct_flagged,
    CASE WHEN quality_score < 75 OR quality_score IS NULL THEN 'needs review' WHEN quality_score < 90 THEN 'fair' ELSE 'good' END AS quality_band
  FROM dimh d LEFT JOIN (SELECT hospital_slug, count(*) AS total_prices, sum(ifnull(is_flagged, false)::INT) AS flagged_prices FROM fact GROUP BY hospital_slug) USING (hospital_slug))"""
GOLD = GROUPS + REG


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _r(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


@query("item_presence", GOLD + " SELECT hospital_slug, code, description, s AS setting, b AS billing_class, code_type, has_gross, has_cash, has_min, has_max, has_negotiated FROM item")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(current(spark, sf_dir)).drop("med_gross", "med_min", "med_max")


@query("quality_row_rates", GOLD + f" SELECT hospital_slug, price_rows, {_r('neg_gt_gross', 'out_of_range', 'cash_gt_gross', 'sentinel')} FROM rrate")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(row_rates(current(spark, sf_dir)), "neg_gt_gross", "out_of_range", "cash_gt_gross", "sentinel")


@query("quality_components", GOLD + f" SELECT hospital_slug, items, {', '.join(COMPONENTS)} FROM qual")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, sf_dir).select("hospital_slug", "items", *COMPONENTS)


@query("quality_score", GOLD + " SELECT hospital_slug, price_rows, quality_score, days_since_update FROM qual")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, sf_dir).select("hospital_slug", "price_rows", "quality_score", F.col("days_since_update").cast("long").alias("days_since_update"))


@query("fact_price", GOLD + " SELECT row_id, hospital_slug, code, code_type, setting, billing_class, price_type, amount, is_flagged, flag_peer_outlier FROM fact")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_price(spark, sf_dir).select("row_id", "hospital_slug", "code", "code_type", "setting", "billing_class", "price_type", "amount", "is_flagged", "flag_peer_outlier")


@query("dim_hospital", GOLD + " SELECT hospital_slug, hospital_name, state, as_of, quality_score, days_since_update FROM dimh")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_hospital(spark, sf_dir).select("hospital_slug", "hospital_name", "state", F.coalesce("as_of", F.lit(AS_OF)).alias("as_of"), "quality_score", F.col("days_since_update").cast("long").alias("days_since_update"))


@query("dim_procedure_code", GOLD + " SELECT * FROM dimp")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_procedure_code(current(spark, sf_dir))


@query("mart_price_comparison", GOLD + " SELECT * FROM mart")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_comparison(fact_price(spark, sf_dir), current_table(spark, sf_dir).rows())


@query("mart_hospital_quality", GOLD + " SELECT hospital_slug, hospital_name, state, quality_score, total_prices, flagged_prices, pct_flagged FROM hq")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hospital_quality(spark, sf_dir).select("hospital_slug", "hospital_name", "state", "quality_score", "total_prices", "flagged_prices", "pct_flagged")


@query("hospital_quality_band", GOLD + " SELECT hospital_slug, quality_score, quality_band FROM hq ORDER BY quality_score DESC, hospital_slug")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hospital_quality(spark, sf_dir).select("hospital_slug", "quality_score", "quality_band").orderBy(F.desc("quality_score"), "hospital_slug")


@query("price_spread", GOLD + """ SELECT m.code, m.code_type, d.example_description AS example, m.price_type, n_hospitals, n_payers, n_prices, min_amount, median_amount, max_amount,
  CASE WHEN min_amount > 0 THEN round((max_amount::DOUBLE / min_amount::DOUBLE)::DECIMAL(30,9), 1)::DOUBLE END AS max_to_min_ratio, round((100.0::DOUBLE * n_flagged / n_prices)::DECIMAL(30,9), 2)::DOUBLE AS pct_flagged FROM mart m JOIN dimp d ON d.code = m.code AND d.code_type = m.code_type""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_spread(fact_price(spark, sf_dir), current(spark, sf_dir), at_most=current_table(spark, sf_dir).rows())


@query("compare_codes", GOLD + """ SELECT code, code_type, price_type, median_amount, (max_amount - min_amount)::DECIMAL(15,4) AS spread, rank() OVER (PARTITION BY price_type ORDER BY median_amount)::INT AS place
FROM mart WHERE code IN ('Brand#11', 'Brand#12', 'Brand#13') ORDER BY price_type, place, code, code_type""")
def compare_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = price_comparison(fact_price(spark, sf_dir).where(F.col("code").isin("Brand#11", "Brand#12", "Brand#13")), current_table(spark, sf_dir).rows())
    place = F.rank().over(Window.partitionBy("price_type").orderBy("median_amount"))
    out = rows.select("code", "code_type", "price_type", "median_amount", (F.col("max_amount") - F.col("min_amount")).cast("decimal(15,4)").alias("spread"), place.alias("place"))
    return out.orderBy("price_type", "place", "code", "code_type")


@query("procedure_search", GOLD + " SELECT * FROM dimp WHERE example_description LIKE '%' || 'a' || '%' ORDER BY hospital_count DESC, code, code_type LIMIT 20")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(dim_procedure_code(current(spark, sf_dir)), "a", 20)


def search(codes: DataFrame, text: str, limit: int) -> DataFrame:
    """Codes whose description contains text (case-sensitive; % and _ match anything), most hospitals first."""
    return codes.where(F.col("example_description").like(f"%{text}%")).orderBy(F.desc("hospital_count"), "code", "code_type").limit(limit)


@query("price_spread_report", GROUPS + """ SELECT code, code_type, price_type, count(DISTINCT hospital_slug)::BIGINT AS hospitals, count(*)::BIGINT AS prices, min(amount) AS lowest, round(quantile_cont(CAST(amount AS DOUBLE), 0.5)::DECIMAL(30,9), 4)::DOUBLE AS median, max(amount) AS highest
FROM cur WHERE code IN ('Brand#11', 'Brand#23') AND price_type IN ('cash', 'negotiated') GROUP BY ALL ORDER BY code, code_type, price_type""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(pruned(spark, sf_dir, codes=["Brand#11", "Brand#23"]), ("Brand#11", "Brand#23"), ("cash", "negotiated"))


def report(rows: DataFrame, codes: tuple[str, ...], price_types: tuple[str, ...]) -> DataFrame:
    chosen = rows.where(F.col("code").isin(*codes) & F.col("price_type").isin(*price_types))
    return chosen.groupBy("code", "code_type", "price_type").agg(F.count_distinct("hospital_slug").alias("hospitals"), F.count("*").alias("prices"), F.min("amount").alias("lowest"), decimals(median(F.col("amount").cast("double")), 4).alias("median"), F.max("amount").alias("highest")).orderBy("code", "code_type", "price_type")


@query("top_codes", GROUPS + " SELECT code, count(*)::BIGINT AS n FROM cur GROUP BY code HAVING count(DISTINCT hospital_slug) >= 15 ORDER BY n DESC, code LIMIT 20")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = current(spark, sf_dir).groupBy("code").agg(F.count("*").alias("n"), F.count_distinct("hospital_slug").alias("h"))
    return g.where("h >= 15").select("code", "n").orderBy(F.desc("n"), "code").limit(20)


@query("cash_spread_by_hospital", GOLD + """,
per AS (SELECT code, hospital_slug, round(median(amount::DOUBLE), 6) AS price FROM fact JOIN dimh USING (hospital_slug) WHERE price_type = 'cash' AND amount > 0 AND NOT coalesce(is_flagged, false) GROUP BY ALL)
SELECT code, count(*)::BIGINT AS hospitals, min(price) AS lowest, round(median(price), 6) AS median, max(price) AS highest, first(hospital_slug ORDER BY price, hospital_slug) AS cheapest, first(hospital_slug ORDER BY price DESC, hospital_slug DESC) AS dearest FROM per GROUP BY code""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cash_spread(fact_price(spark, sf_dir), registry(spark, sf_dir))


def cash_spread(facts: DataFrame, hospitals: DataFrame, state: str | None = None) -> DataFrame:
    """Spread of each code's unflagged cash price, a median a hospital, over the hospitals of a state or of all."""
    hospitals = hospitals if state is None else hospitals.where(F.col("state") == state)
    rows = facts.where((F.col("price_type") == "cash") & (F.col("amount") > 0) & ~F.coalesce("is_flagged", F.lit(False)))
    per = rows.join(hospitals.select("hospital_slug"), "hospital_slug").groupBy("code", "hospital_slug").agg(F.round(median(F.col("amount").cast("double")), 6).alias("price"))
    ends = F.struct("price", "hospital_slug")
    return per.groupBy("code").agg(F.count("*").alias("hospitals"), F.min("price").alias("lowest"), F.round(median("price"), 6).alias("median"), F.max("price").alias("highest"), F.min(ends)["hospital_slug"].alias("cheapest"), F.max(ends)["hospital_slug"].alias("dearest"))


@query("storage_q1", GROUPS + " SELECT count(*)::BIGINT AS n, min(amount) AS lowest, max(amount) AS highest FROM cur WHERE code = 'Brand#23'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned(spark, sf_dir, codes=["Brand#23"]).agg(F.count("*").alias("n"), F.min("amount").alias("lowest"), F.max("amount").alias("highest"))


@query("storage_q2", GROUPS + " SELECT code, count(*)::BIGINT AS n, round(avg(amount::DOUBLE), 6) AS mean FROM cur WHERE hospital_slug = 'h3' AND price_type = 'negotiated' AND code IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21', 'Brand#22') GROUP BY code")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pruned(spark, sf_dir, ["h3"], ["Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#22"]).where(F.col("price_type") == "negotiated")
    return rows.groupBy("code").agg(F.count("*").alias("n"), F.round(F.avg(F.col("amount").cast("double")), 6).alias("mean"))


@query("storage_q3", GROUPS + " SELECT code, count(*)::BIGINT AS n, sum(amount)::DECIMAL(24,4) AS total FROM cur GROUP BY code ORDER BY total DESC, code LIMIT 5")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(spark, sf_dir).groupBy("code").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(24,4)").alias("total")).orderBy(F.desc("total"), "code").limit(5)


@query("stg_views", GROUPS + " SELECT row_id, key_hash, hospital_slug, coalesce(setting, 'unknown') AS setting, coalesce(billing_class, 'unknown') AS billing_class, amount::DECIMAL(14,4) AS amount FROM cur")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown(current(spark, sf_dir)).select("row_id", "key_hash", "hospital_slug", "setting", "billing_class", F.col("amount").cast("decimal(14,4)").alias("amount"))


@query("fk_check", GOLD + " SELECT hospital_slug, count(*)::BIGINT AS n FROM fact WHERE hospital_slug NOT IN (SELECT hospital_slug FROM dimh WHERE state <> 'S0') GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = registry(spark, sf_dir).where(F.col("state") != "S0").select("hospital_slug")
    return current(spark, sf_dir).join(dims, "hospital_slug", "left_anti").groupBy("hospital_slug").agg(F.count("*").alias("n"))


@query("orphan_anti_join", GOLD + " SELECT row_id FROM flagged f WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.row_id = f.row_id AND c.hospital_slug <> 'h5')")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = current(spark, sf_dir)
    return scored(spark, sf_dir).select("row_id").join(cur.where(F.col("hospital_slug") != "h5").select("row_id"), "row_id", "left_anti")


@query("min_gt_max", GOLD + """ SELECT a.hospital_slug, a.code, a.amount AS mn, b.amount AS mx FROM (SELECT * FROM fact WHERE price_type = 'min') a JOIN (SELECT * FROM fact WHERE price_type = 'max') b
  USING (hospital_slug, code, description, setting, billing_class) WHERE a.amount > b.amount""")
def min_gt_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unknown(current(spark, sf_dir)).select("hospital_slug", "code", "description", "setting", "billing_class", "price_type", "amount")
    side = lambda kind, name: rows.where(F.col("price_type") == kind).drop("price_type").withColumnRenamed("amount", name)
    both = side("min", "mn").join(side("max", "mx"), ["hospital_slug", "code", "description", "setting", "billing_class"])
    return both.where("mn > mx").select("hospital_slug", "code", "mn", "mx")


def checks(
    df: DataFrame, unique: tuple[str | tuple[str, ...], ...] = (), not_null: tuple[str, ...] = (), accepted: dict[str, tuple] | None = None,
    ranges: dict[str, tuple[float | None, float | None]] | None = None, relationships: dict[str, tuple[DataFrame, str]] | None = None, warn: tuple[str, ...] = (),
) -> DataFrame:
    """check, severity (warn or error), failures and status (pass, warn, fail).

    One pass serves all row checks; a unique key (a column or a combination of several) takes one aggregation, a relationship (column: the
    frame and column that must hold its values) one anti join. A null passes all but not_null. An open end of a range is None. Checks named in
    warn do not fail.
    """
    holds = lambda c, low, high: F.coalesce(F.lit(True) if low is None else F.col(c) >= low, F.lit(True)) & F.coalesce(F.lit(True) if high is None else F.col(c) <= high, F.lit(True))
    bad = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    bad |= {f"accepted:{c}": ~F.col(c).isin(*values) for c, values in (accepted or {}).items()}
    bad |= {f"range:{c}": ~holds(c, *limits) for c, limits in (ranges or {}).items()}
    found = []
    if bad:
        counted = df.agg(*[F.count_if(c).alias(n) for n, c in bad.items()])
        found.append(counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in bad])).alias("c")).select("c.*"))
    for key in unique:
        columns = (key,) if isinstance(key, str) else key
        whole = F.lit(True)
        for c in columns:
            whole = whole & F.col(c).isNotNull()
        twice = df.where(whole).groupBy(*columns).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("failures"))
        found.append(twice.select(F.lit("unique:" + ",".join(columns)).alias("check"), "failures"))
    for c, (other, column) in (relationships or {}).items():
        orphans = df.where(F.col(c).isNotNull()).select(F.col(c).alias("k")).join(other.select(F.col(column).alias("k")), "k", "left_anti")
        found.append(orphans.agg(F.count("*").alias("failures")).select(F.lit(f"relationship:{c}").alias("check"), "failures"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    severity = F.when(F.col("check").isin(*warn), "warn").otherwise("error") if warn else F.lit("error")
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return out.withColumn("severity", severity).withColumn("status", status).select("check", "severity", "failures", "status")


@query("dq_checks", GROUPS + """,
c("check", failures) AS (
  SELECT 'not_null:row_id', count(*) FILTER (row_id IS NULL)::BIGINT FROM cur UNION ALL SELECT 'not_null:payer', count(*) FILTER (payer IS NULL) FROM cur
  UNION ALL SELECT 'accepted:price_type', count(*) FILTER (price_type NOT IN ('gross', 'cash', 'negotiated', 'min')) FROM cur UNION ALL SELECT 'range:amount', count(*) FILTER (amount < 1 OR amount > 50000) FROM cur
  UNION ALL SELECT 'range:dup_seq', count(*) FILTER (dup_seq < 0) FROM cur UNION ALL SELECT 'unique:row_id', count(*) FROM (SELECT row_id FROM cur GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'unique:code', count(*) FROM (SELECT code FROM cur GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'unique:key_hash,dup_seq', count(*) FROM (SELECT key_hash, dup_seq FROM cur GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'relationship:hospital_slug', count(*) FROM cur WHERE hospital_slug NOT IN (SELECT concat('h', n_nationkey) FROM nation WHERE n_regionkey <> 0))
SELECT "check", CASE WHEN "check" IN ('unique:code', 'not_null:payer') THEN 'warn' ELSE 'error' END AS severity, failures, CASE WHEN failures = 0 THEN 'pass' WHEN "check" IN ('unique:code', 'not_null:payer') THEN 'warn' ELSE 'fail' END AS status FROM c""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    hospitals = registry(spark, sf_dir).where(F.col("state") != "S0")
    return checks(
        current(spark, sf_dir), unique=("row_id", "code", ("key_hash", "dup_seq")), not_null=("row_id", "payer"), accepted={"price_type": ("gross", "cash", "negotiated", "min")},
        ranges={"amount": (1, 50000), "dup_seq": (0, None)}, relationships={"hospital_slug": (hospitals, "hospital_slug")}, warn=("unique:code", "not_null:payer"),
    )


@query("stg_history_view", GROUPS + " SELECT row_id, hospital_slug, code, coalesce(setting, 'unknown') AS setting, coalesce(billing_class, 'unknown') AS billing_class, amount, true AS is_current FROM cur")
def stg_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown(current(spark, sf_dir)).select("row_id", "hospital_slug", "code", "setting", "billing_class", "amount", F.lit(True).alias("is_current"))


@query("stg_quality_view", GOLD + " SELECT hospital_slug, as_of, quality_score, completeness, validity, consistency, freshness FROM dimh")
def stg_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_hospital(spark, sf_dir).select("hospital_slug", F.coalesce("as_of", F.lit(AS_OF)).alias("as_of"), "quality_score", *COMPONENTS)


@query("stg_flags_view", GOLD + " SELECT row_id, hospital_slug, code, price_type, r1_robust_z AS flag_peer_outlier, r2_neg_gt_gross AS flag_negotiated_above_gross, r3_out_of_range AS flag_negotiated_outside_min_max, r4_cash_gt_gross AS flag_cash_above_gross, r5_placeholder AS flag_placeholder_value FROM flagged")
def stg_anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {"r1_robust_z": "flag_peer_outlier", "r2_neg_gt_gross": "flag_negotiated_above_gross", "r3_out_of_range": "flag_negotiated_outside_min_max", "r4_cash_gt_gross": "flag_cash_above_gross", "r5_placeholder": "flag_placeholder_value"}
    return flags(scored(spark, sf_dir)).select("row_id", "hospital_slug", "code", "price_type", *[F.col(a).alias(b) for a, b in named.items()])

"""Parsing price files to canonical rows and rejects: amounts, codes, items, melting of wide and nested layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import parsing
from quillstone.plans.pricefacts import read
from quillstone.plans.registry import query

GENERIC = {"gross": "gross_charge", "cash": "discounted_cash", "min": "minimum", "max": "maximum"}


def melt(rows: DataFrame, keys: tuple[str, ...], cells: dict[tuple[str | None, str | None, str], Column]) -> DataFrame:
    """One row a (payer, plan, price type) cell of cells that is not blank: keys, payer, plan, price_type, raw."""
    made = [F.struct(F.lit(payer).cast("string").alias("payer"), F.lit(plan).cast("string").alias("plan"), F.lit(kind).alias("price_type"), c.cast("string").alias("raw")) for (payer, plan, kind), c in cells.items()]
    out = rows.select(*keys, F.explode(F.array(*made)).alias("cell")).select(*keys, "cell.*")
    return out.where(F.trim(F.coalesce("raw", F.lit(""))) != "")


def priced(cells: DataFrame, limit: float = parsing.AMOUNT_MAX) -> DataFrame:
    """cells with amount and reason of their raw text; cells that hold nothing are left out."""
    raw = F.col("raw")
    out = cells.withColumns({"amount": parsing.amount_value(raw, limit), "reason": parsing.amount_reason(raw, limit)})
    return out.where(F.col("amount").isNotNull() | F.col("reason").isNotNull())


def raw_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of every kind out of lineitem: prices, currency text, blanks and junk."""
    price = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 13
    raw = F.when(k == 0, F.concat(F.lit("$"), price)).when(k == 1, "").when(k == 2, "N/A").when(k == 3, "-4").when(k == 4, "1e12").when(k == 5, " 1,234.50 ").when(k == 6, "null").when(k == 7, F.lit(None)).when(k == 8, "_").when(k == 9, "_null").when(k == 10, "1_0\u00a05").when(k == 11, "\u0661\u0662").otherwise(price)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))


RAW = """
WITH cells AS (
  SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 13 WHEN 0 THEN '$' || l_extendedprice::DECIMAL(14,2) WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN '-4' WHEN 4 THEN '1e12'
    WHEN 5 THEN ' 1,234.50 ' WHEN 6 THEN 'null' WHEN 7 THEN NULL WHEN 8 THEN '_' WHEN 9 THEN '_null' WHEN 10 THEN '1_0' || chr(160) || '5' WHEN 11 THEN chr(1633) || chr(1634) ELSE (l_extendedprice::DECIMAL(14,2))::VARCHAR END AS raw FROM lineitem),
stripped AS (SELECT *, regexp_replace(raw, '[,$\\s' || chr(160) || ']', '', 'g') AS bare FROM cells),
texts AS (SELECT *, translate(replace(bare, '_', ''), chr(1632) || chr(1633) || chr(1634) || chr(1635), '0123') AS t FROM stripped),
parsed AS (
  SELECT *, CASE WHEN raw IS NULL OR bare = '' OR lower(bare) IN ('null', 'none') THEN NULL WHEN NOT regexp_matches(t, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN 'non_numeric_amount'
    WHEN try_cast(t AS DOUBLE) <= 0 THEN 'non_positive_amount' WHEN try_cast(t AS DOUBLE) > 100000000 THEN 'above_plausible_max' END AS reason FROM texts),
amounts AS (SELECT *, CASE WHEN reason IS NULL THEN try_cast(t AS DECIMAL(14,4)) END AS amount FROM parsed)"""


@query("parse_amount", RAW + " SELECT l_orderkey, l_linenumber, raw, amount, reason FROM amounts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_amounts(spark, sf_dir).withColumns({"amount": parsing.amount_value(F.col("raw")), "reason": parsing.amount_reason(F.col("raw"))})


@query("reject_summary", RAW + " SELECT 'price' AS kind, reason, count(*)::BIGINT AS n FROM amounts WHERE reason IS NOT NULL GROUP BY reason")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = priced(raw_amounts(spark, sf_dir)).where(F.col("reason").isNotNull())
    return rejects.groupBy(F.lit("price").alias("kind"), "reason").agg(F.count("*").alias("n"))


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of every kind out of part: spelled code types, blank fields and unknown settings."""
    k, size = F.col("p_partkey"), F.col("p_size")
    one = F.when(k % 6 == 0, "cpt").when(k % 6 == 1, " CPT-4").when(k % 6 == 2, "msdrg").when(k % 6 == 3, "foo").when(k % 6 == 4, "NDC").otherwise(F.lit(None))
    two = F.when(k % 4 == 0, "hcpcs").when(k % 4 == 1, "CDM").when(k % 4 == 2, "RC").otherwise("eapg")
    setting = F.when(k % 5 == 0, "Outpatient").when(k % 5 == 1, " inpatient ").when(k % 5 == 2, "").when(k % 5 == 3, F.lit(None)).otherwise(F.when(size % 3 == 0, "weird").otherwise("both"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.when(size % 10 == 0, " ").otherwise(F.col("p_name")).alias("description"), setting.alias("setting"), F.when(size % 11 == 0, "clinic").otherwise("facility").alias("billing_class"),
        F.when(size % 7 == 0, "").otherwise(F.concat(F.lit(" "), F.col("p_brand"))).alias("code_1"), one.alias("type_1"), F.when(size % 4 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("code_2"), two.alias("type_2"),
    )


ITEMS = """
WITH items AS (
  SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN ' ' ELSE p_name END AS description,
    CASE p_partkey % 5 WHEN 0 THEN 'Outpatient' WHEN 1 THEN ' inpatient ' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE CASE WHEN p_size % 3 = 0 THEN 'weird' ELSE 'both' END END AS setting,
    CASE WHEN p_size % 11 = 0 THEN 'clinic' ELSE 'facility' END AS billing_class, CASE WHEN p_size % 7 = 0 THEN '' ELSE ' ' || p_brand END AS code_1,
    CASE p_partkey % 6 WHEN 0 THEN 'cpt' WHEN 1 THEN ' CPT-4' WHEN 2 THEN 'msdrg' WHEN 3 THEN 'foo' WHEN 4 THEN 'NDC' END AS type_1, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS code_2,
    CASE p_partkey % 4 WHEN 0 THEN 'hcpcs' WHEN 1 THEN 'CDM' WHEN 2 THEN 'RC' ELSE 'eapg' END AS type_2 FROM part),
codes AS (SELECT p_partkey, 0 AS place, code_1 AS code, type_1 AS raw FROM items UNION ALL SELECT p_partkey, 1, code_2, type_2 FROM items),
typed AS (
  SELECT p_partkey, place, trim(code) AS code, CASE upper(trim(coalesce(raw, ''))) WHEN 'CPT' THEN 'CPT' WHEN 'CPT-4' THEN 'CPT' WHEN 'HCPCS' THEN 'HCPCS' WHEN 'MSDRG' THEN 'MS-DRG' WHEN 'NDC' THEN 'NDC' WHEN 'CDM' THEN 'CDM' WHEN 'RC' THEN 'RC' ELSE 'OTHER' END AS type FROM codes),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY list_position(['CPT', 'HCPCS', 'MS-DRG', 'APR-DRG', 'ICD-10-PCS', 'NDC', 'CDM', 'RC', 'LOCAL', 'OTHER'], type), place) AS rn FROM typed WHERE code <> ''),
picked AS (
  SELECT i.*, (SELECT code FROM ranked r WHERE r.p_partkey = i.p_partkey AND rn = 1) AS code, (SELECT type FROM ranked r WHERE r.p_partkey = i.p_partkey AND rn = 1) AS code_type,
    coalesce((SELECT string_agg(type || ':' || code, '|' ORDER BY rn) FROM ranked r WHERE r.p_partkey = i.p_partkey AND rn > 1), '') AS alt_codes FROM items i)"""


def with_codes(items: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.col(f"code_{i}").alias("code"), F.col(f"type_{i}").alias("raw_type")) for i in (1, 2)])
    ordered = items.withColumn("ordered", parsing.ordered_codes(pairs))
    best = F.col("ordered")
    return ordered.withColumns({"code": parsing.primary_code(best), "code_type": parsing.primary_type(best), "alt_codes": parsing.alternative_codes(best)}).drop("ordered")


@query("code_type_alias", ITEMS + " SELECT type, count(*)::BIGINT AS n FROM typed WHERE place = 0 GROUP BY type")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_items(spark, sf_dir).groupBy(parsing.code_type(F.col("type_1")).alias("type")).agg(F.count("*").alias("n"))


@query("pick_codes", ITEMS + " SELECT p_partkey, code, code_type, alt_codes FROM picked")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_codes(raw_items(spark, sf_dir)).select("p_partkey", "code", "code_type", "alt_codes")


@query("item_validate", ITEMS + """ SELECT p_partkey, CASE WHEN trim(description) = '' THEN 'missing_description' WHEN code IS NULL THEN 'no_code'
  WHEN trim(setting) <> '' AND lower(trim(setting)) NOT IN ('inpatient', 'outpatient', 'both') THEN 'invalid_setting' WHEN billing_class NOT IN ('facility', 'professional', 'both') THEN 'invalid_billing_class' END AS reason FROM picked""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_codes(raw_items(spark, sf_dir)).select("p_partkey", parsing.item_reason(F.col("description"), F.col("code"), F.col("setting"), F.col("billing_class")).alias("reason"))


@query("melt_price_types", """
SELECT p_partkey, price_type, amount FROM (
  SELECT p_partkey, unnest([{'t': 'gross', 'v': p_retailprice::DECIMAL(14,4)}, {'t': 'cash', 'v': (p_retailprice * 0.5)::DECIMAL(14,4)}, {'t': 'min', 'v': CASE WHEN p_size % 2 = 0 THEN p_size::DECIMAL(14,4) END}, {'t': 'max', 'v': (p_size * 100)::DECIMAL(14,4)}], recursive := true) FROM part) x(p_partkey, price_type, amount)
WHERE amount IS NOT NULL""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    cells = {"gross": price, "cash": price * 0.5, "min": F.when(size % 2 == 0, size), "max": size * 100}
    made = F.explode(F.array(*[F.struct(F.lit(k).alias("price_type"), c.cast("decimal(14,4)").alias("amount")) for k, c in cells.items()]))
    return read(spark, sf_dir, "part").select("p_partkey", made.alias("c")).select("p_partkey", "c.*").where(F.col("amount").isNotNull())


@query("wide_melt", """
SELECT p_partkey, payer, plan, amount FROM (
  SELECT p_partkey, 'Acme' AS payer, 'Gold' AS plan, CASE WHEN p_size % 3 <> 0 THEN p_size::DECIMAL(14,4) END AS amount FROM part UNION ALL SELECT p_partkey, 'Beta', 'Silver', CASE WHEN p_size % 5 <> 0 THEN (p_size * 2)::DECIMAL(14,4) END FROM part) WHERE amount IS NOT NULL""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    cells = {("Acme", "Gold", "negotiated"): F.when(size % 3 != 0, size.cast("string")).otherwise(""), ("Beta", "Silver", "negotiated"): F.when(size % 5 != 0, (size * 2).cast("string"))}
    return priced(melt(read(spark, sf_dir, "part"), ("p_partkey",), cells)).select("p_partkey", "payer", "plan", "amount")


#: Layout of the nested JSON price files; amounts are read as text, so that they stay exact.
CHARGES = (
    "array<struct<setting: string, billing_class: string, gross_charge: string, discounted_cash: string, minimum: string, maximum: string, "
    "payers_information: array<struct<payer_name: string, plan_name: string, standard_charge_dollar: string, standard_charge_percentage: string, standard_charge_algorithm: string, methodology: string>>>>"
)
ITEM_SCHEMA = f"description string, billing_class string, code_information array<struct<code: string, type: string>>, standard_charges {CHARGES}"


def flatten_items(items: DataFrame, *keys: str) -> DataFrame:
    """keys, item fields and one row a price cell (payer, plan, price_type, raw, methodology, non_dollar) of nested items; first_charge marks an item's first."""
    charged = items.select(*keys, "description", "code_information", F.col("billing_class").alias("item_class"), F.posexplode("standard_charges").alias("n", "c"))
    own_class = F.coalesce(F.nullif("c.billing_class", F.lit("")), F.col("item_class"))
    text = lambda v: v.cast("string")
    cell = lambda payer, plan, kind, raw, how, other=F.lit(False): F.struct(text(payer).alias("payer"), text(plan).alias("plan"), F.lit(kind).alias("price_type"), text(raw).alias("raw"), text(how).alias("methodology"), other.alias("non_dollar"))
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    none = F.lit(None)
    generic = F.array(*[cell(none, none, k, F.col(f"c.{c}"), none) for k, c in GENERIC.items()])
    paid = F.transform(F.coalesce("c.payers_information", F.array().cast(CHARGES.split("payers_information: ")[1][:-2])), lambda p: cell(p["payer_name"], p["plan_name"], "negotiated", p["standard_charge_dollar"], p["methodology"], given(p["standard_charge_percentage"]) | given(p["standard_charge_algorithm"])))
    cells = charged.select(*keys, "description", "code_information", F.col("c.setting").alias("setting"), own_class.alias("billing_class"), (F.col("n") == 0).alias("first_charge"), F.explode(F.concat(generic, paid)).alias("cell"))
    return cells.select(*keys, "description", "code_information", "setting", "billing_class", "first_charge", "cell.*")


@query("json_nested_flatten", """
SELECT p_partkey, price_type, payer, amount FROM (
  SELECT p_partkey, 'gross' AS price_type, NULL AS payer, p_retailprice::DECIMAL(14,2)::DECIMAL(14,4) AS amount FROM part UNION ALL SELECT p_partkey, 'min', NULL, p_size::DECIMAL(14,4) FROM part
  UNION ALL SELECT p_partkey, 'negotiated', 'Acme', (p_size * 3)::DECIMAL(14,4) FROM part WHERE p_size % 2 = 0)""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("p_retailprice").cast("decimal(14,2)").cast("string"), F.col("p_size").cast("string")
    dollar = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(', "standard_charge_dollar": "'), (F.col("p_size") * 3).cast("string"), F.lit('"'))).otherwise("")
    body = F.concat(F.lit('{"description": "x", "code_information": [{"code": "1", "type": "CPT"}], "standard_charges": [{"setting": "both", "gross_charge": '), price, F.lit(', "minimum": "'), size, F.lit('", "payers_information": [{"payer_name": "Acme", "plan_name": "Gold"'), dollar, F.lit("}]}]}"))
    nested = read(spark, sf_dir, "part").select("p_partkey", F.from_json(body, ITEM_SCHEMA).alias("j")).select("p_partkey", "j.*")
    return priced(flatten_items(nested, "p_partkey")).select("p_partkey", "price_type", "payer", "amount")

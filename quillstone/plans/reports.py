"""Reports of the phases out of their logs, as one Markdown text, and a small made-up gold folder to run the marts on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.sources import registry

#: Rows that a report's table shows, at most; the totals above it are of all.
SHOWN = 200


def fetch_report(manifest: DataFrame) -> DataFrame:
    """slug, fetches, failures and stored bytes of each source."""
    return manifest.groupBy("slug").agg(F.count("*").alias("fetches"), F.count_if(F.col("outcome") == "failed").alias("failures"), F.sum(F.when(F.col("outcome") == "stored", F.col("size_bytes")).otherwise(0)).alias("stored_bytes"))


def parse_report(runs: DataFrame) -> DataFrame:
    """slug, rows, rejects, reject rate and seconds of each source's parses."""
    g = runs.groupBy("slug").agg(F.sum("rows_out").alias("rows"), F.sum("rejects").alias("rejects"), F.round(F.sum("duration_s"), 1).alias("seconds"))
    return g.withColumn("reject_rate", F.round(F.col("rejects") / F.greatest(F.col("rows") + F.col("rejects"), F.lit(1)), 4))


def load_report(ledger: DataFrame) -> DataFrame:
    """slug, loads, rows inserted, closed and unchanged, and seconds of each source's loads."""
    sums = [F.sum(c).alias(c) for c in ("rows_inserted", "rows_closed", "rows_unchanged")]
    return ledger.groupBy("slug").agg(F.count("*").alias("loads"), *sums, F.round(F.sum("duration_s"), 1).alias("seconds"))


def markdown(title: str, rows: DataFrame) -> str:
    """A table of rows by slug, with the sums of its numbers in front."""
    numbers = [f.name for f in rows.schema.fields if f.dataType.typeName() in ("long", "integer", "double") and not f.name.endswith("rate")]
    totals = rows.agg(F.count("*").alias("sources"), *[F.sum(c).alias(c) for c in numbers]).first().asDict()
    lines = [f"## {title}", "", ", ".join(f"{k} {0 if v is None else v:,}" for k, v in totals.items()), "", "| " + " | ".join(rows.columns) + " |", "|" + "-|" * len(rows.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.orderBy("slug").limit(SHOWN).collect()]
    return "\n".join(lines) + "\n"


def phase_reports(manifest: DataFrame, runs: DataFrame, ledger: DataFrame) -> str:
    return "\n".join([markdown("Fetched", fetch_report(manifest)), markdown("Parsed", parse_report(runs)), markdown("Loaded", load_report(ledger))])


def write_gold_fixture(spark: SparkSession, path: str, hospitals: int = 3, codes: int = 4, payers: int = 3) -> dict[str, int]:
    """prices, quality, flags (Parquet) and registry.csv under path: one price a hospital, code and payer (the last payer is null); rows of each."""
    n = hospitals * codes * payers
    h, c, p = (F.col("id") / (codes * payers)).cast("int"), F.pmod((F.col("id") / payers).cast("int"), F.lit(codes)), F.col("id") % payers
    slug = F.concat(F.lit("made-up-"), h.cast("string"))
    payer = F.when(p < payers - 1, F.concat(F.lit("payer "), p.cast("string")))
    kind: Column = F.when(payer.isNull(), "gross").otherwise("negotiated")
    prices = spark.range(n).select(
        F.md5(F.col("id").cast("string").cast("binary")).alias("row_id"), slug.alias("hospital_slug"), F.concat(F.lit("item "), c.cast("string")).alias("description"), F.concat(F.lit("C"), F.lpad(c.cast("string"), 4, "0")).alias("code"), F.lit("HCPCS").alias("code_type"),
        payer.alias("payer"), kind.alias("price_type"), (100 + 10 * c + h + p).cast("decimal(14,4)").alias("amount"),
    )
    quality = spark.range(hospitals).select(F.concat(F.lit("made-up-"), F.col("id").cast("string")).alias("hospital_slug"), F.lit("2026-01-01").cast("date").alias("as_of"), (90 - 5 * F.col("id")).cast("double").alias("quality_score"))
    flags = prices.select("row_id", "hospital_slug", "code", "price_type", (F.col("amount") > 130).alias("any_rule"))
    for name, rows in (("prices", prices), ("quality", quality), ("flags", flags)):
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    listed = registry.export([{"slug": f"made-up-{i}", "name": f"Made-up Hospital {i}", "state": "ZZ"} for i in range(hospitals)], f"{path}/registry.csv")
    return {"prices": n, "quality": hospitals, "flags": n, "registry": listed}

"""What the API answers: search, spread, quality, comparison and health, with the checks of their arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators import gold
from quillstone.plans.store import current, current_table


class NotFound(LookupError):
    """Nothing answers the request."""


class Serving:
    """The marts of one data folder, built once and read by every request."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        cur, fact = current(spark, sf_dir), gold.fact_price(spark, sf_dir)
        self.codes = gold.dim_procedure_code(cur).persist()
        self.spreads = gold.price_spread(fact, cur, at_most=current_table(spark, sf_dir).rows()).persist()
        self.hospitals = gold.hospital_quality(spark, sf_dir).persist()

    def views(self, spark: SparkSession) -> list[str]:
        """Temporary views of what is served, for SQL clients of the session."""
        named = {"procedure_codes": self.codes, "price_spreads": self.spreads, "hospital_quality": self.hospitals}
        for name, rows in named.items():
            rows.createOrReplaceTempView(name)
        return list(named)

    def search(self, text: str, limit: int = 20) -> DataFrame:
        if len(text) < 2:
            raise ValueError("q needs two characters")
        if not 1 <= limit <= 100:
            raise ValueError("limit must be between 1 and 100")
        return gold.search(self.codes, text, limit)

    def price_spread(self, code: str) -> DataFrame:
        found = self.spreads.where(F.col("code") == code).orderBy("price_type", "code_type")
        if not found.limit(1).count():
            raise NotFound(code)
        return found

    def hospital_quality(self, slug: str | None = None) -> DataFrame:
        if slug is None:
            return self.hospitals.orderBy(F.desc("quality_score"), "hospital_slug")
        found = self.hospitals.where(F.col("hospital_slug") == slug)
        if not found.limit(1).count():
            raise NotFound(slug)
        return found

    def compare(self, codes: list[str]) -> tuple[DataFrame, list[str]]:
        """Spreads of 2 to 10 codes, ranked by median within each price type, and the codes that are not known."""
        wanted = list(dict.fromkeys(codes))
        if not 2 <= len(wanted) <= 10:
            raise ValueError("between 2 and 10 different codes")
        found = self.spreads.where(F.col("code").isin(*wanted))
        known = {r["code"] for r in found.select("code").distinct().collect()}
        place = F.rank().over(Window.partitionBy("price_type").orderBy("median_amount"))
        spread = F.round((F.col("max_amount") - F.col("min_amount")).cast("double"), 2)
        return found.withColumns({"spread": spread, "place": place}).orderBy("price_type", "place", "code", "code_type"), [c for c in wanted if c not in known]

    def health(self) -> dict:
        return {"status": "healthy", "backend": "spark", "codes": self.codes.count(), "hospitals": self.hospitals.count()}

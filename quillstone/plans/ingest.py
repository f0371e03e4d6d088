"""One price file to canonical rows and rejects: header check, parse, quarantine or promotion."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import parsing
from quillstone.operators.silver import ITEM_SCHEMA, flatten_items
from quillstone.plans.contract import GENERIC_COLUMNS, Contract, split_wide_header, validate_header
from quillstone.sources.pricefile import header_of, layout_of, profiles, read_items, read_rows

# The columns of canonical rows and of rejects.
CANONICAL = (
    "hospital_slug", "source_sha256", "source_row", "description", "code", "code_type", "alt_codes", "setting", "billing_class", "payer", "plan", "price_type", "amount",
    "methodology", "modifiers", "template_version", "contract_version",
)
REJECT = ("hospital_slug", "source_sha256", "source_row", "kind", "reason", "field", "raw")


@dataclass
class Outcome:
    outcome: str
    reasons: list[str]
    warnings: list[str]
    rows_out: int = 0
    rejects: int = 0
    reject_reasons: dict[str, int] = field(default_factory=dict)
    #: rows_in, non_dollar_negotiated (payers with a percentage or an algorithm only), recoded (bytes read as cp1252), payer_plan_columns, ignored_payer_columns
    counters: dict[str, int] = field(default_factory=dict)


def parse(spark: SparkSession, path: str, contract: Contract, sha: str, version: str | None, counted: Observation | None = None) -> DataFrame:
    """Every price cell and every unusable row of the file: canonical columns, and kind, reason, field, raw of rejects (null kind: a row).

    counted gets rows_in, non_dollar_negotiated and recoded of the first pass over the result.
    """
    cells = _json_cells(spark, path) if contract.layout == "json" else _csv_cells(spark, path)
    item_reason = F.coalesce(F.col("row_reason"), parsing.item_reason(F.col("description"), F.col("code"), F.col("setting"), F.col("billing_class"), contract.allowed_settings, contract.allowed_billing_classes))
    checked = cells.withColumn("item_reason", item_reason)
    # one reject for an unusable row; its cells are not looked at
    raw = F.col("raw")
    checked = checked.where(F.col("item_reason").isNull() | (F.col("place") == 0))
    priced = checked.withColumns({"amount": F.when(F.col("item_reason").isNull(), parsing.amount_value(raw, contract.amount_max)), "price_reason": F.when(F.col("item_reason").isNull(), parsing.amount_reason(raw, contract.amount_max))})
    if counted is not None:
        no_dollar = F.col("non_dollar") & F.col("item_reason").isNull() & F.col("price_reason").isNull() & F.col("amount").isNull()
        first = F.col("first")
        priced = priced.observe(counted, F.count_if(first).alias("rows_in"), F.count_if(no_dollar).alias("non_dollar_negotiated"), F.coalesce(F.sum(F.when(first, F.col("recoded"))), F.lit(0)).alias("recoded"))
    kept = priced.where(F.col("item_reason").isNotNull() | F.col("price_reason").isNotNull() | F.col("amount").isNotNull())
    kind = F.when(F.col("item_reason").isNotNull(), "row").when(F.col("price_reason").isNotNull(), "price")
    empty = lambda c: F.nullif(c, F.lit(""))
    return kept.select(
        F.lit(contract.source).alias("hospital_slug"), F.lit(sha).alias("source_sha256"), "source_row", F.trim("description").alias("description"), "code", "code_type", "alt_codes", parsing.enum_value(F.col("setting")).alias("setting"),
        parsing.enum_value(F.col("billing_class")).alias("billing_class"), "payer", "plan", "price_type", "amount", empty("methodology").alias("methodology"), empty("modifiers").alias("modifiers"), F.lit(version).cast("string").alias("template_version"),
        F.lit(contract.contract_version).alias("contract_version"), kind.alias("kind"), F.coalesce("item_reason", "price_reason").alias("reason"), F.when(kind == "price", F.col("field")).alias("field"),
        F.when(kind == "price", F.substring("raw", 1, 40)).otherwise(F.substring("row_raw", 1, 80)).alias("raw"),
    )


def canonical(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("kind").isNull()).select(*CANONICAL)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("kind").isNotNull()).select(*REJECT)


def _csv_cells(spark: SparkSession, path: str) -> DataFrame:
    columns, _, layout = header_of(path)
    place = {c: i for i, c in enumerate(columns)}
    cell = lambda c: F.trim(F.get("cells", F.lit(place[c]))) if c in place else F.lit("")
    pairs = F.array(*[F.struct(cell(f"code|{k}").alias("code"), cell(f"code|{k}|type").alias("raw_type")) for k in range(1, 10) if f"code|{k}" in place])
    text = lambda v: v.cast("string")

    def priced(payer: Column, plan: Column, kind: str, column: str, how: Column, other: Column | None = None) -> Column:
        named = {"payer": text(payer), "plan": text(plan), "price_type": F.lit(kind), "raw": cell(column), "field": F.lit(column), "methodology": text(how), "non_dollar": F.lit(False) if other is None else other}
        return F.struct(*[c.alias(n) for n, c in named.items()])

    none, blank = F.lit(None), F.lit("")
    made = [priced(none, none, kind, column, blank) for kind, column in GENERIC_COLUMNS.items() if column in place]
    if layout == "csv_tall":
        payer = F.nullif(cell("payer_name"), blank)
        dollar = priced(payer, F.nullif(cell("plan_name"), blank), "negotiated", "standard_charge|negotiated_dollar", cell("standard_charge|methodology"), (cell("standard_charge|negotiated_percentage") != "") | (cell("standard_charge|negotiated_algorithm") != ""))
        made += [F.when(payer.isNotNull(), dollar)] if "standard_charge|negotiated_dollar" in place else []
    else:
        groups: dict[tuple[str, str], dict[str, str]] = {}
        for c in columns:
            if (parts := split_wide_header(c)) and parts[0] == "standard_charge" and parts[3] in ("negotiated_dollar", "methodology"):
                groups.setdefault(parts[1:3], {})[parts[3]] = c
        made += [priced(F.lit(p), F.lit(n), "negotiated", g["negotiated_dollar"], cell(g["methodology"]) if "methodology" in g else blank) for (p, n), g in groups.items() if "negotiated_dollar" in g]
    ragged = F.when(F.size("cells") != F.col("n_columns"), "ragged_row")
    rows = read_rows(spark, path).select(
        "source_row", ragged.alias("row_reason"), F.array_join("cells", ",").alias("row_raw"), cell("description").alias("description"), cell("setting").alias("setting"), cell("billing_class").alias("billing_class"),
        cell("modifiers").alias("modifiers"), "recoded", parsing.ordered_codes(pairs).alias("ordered"), F.array(*(made or [priced(none, none, "none", "", blank)])).alias("made"),
    )
    return _coded(rows.select("*", F.posexplode("made").alias("place", "cell")).drop("made").withColumn("first", F.col("place") == 0))


def _json_cells(spark: SparkSession, path: str) -> DataFrame:
    read = read_items(spark, path).select("source_row", "recoded", F.from_json("item", f"struct<{', '.join(_struct_fields(ITEM_SCHEMA))}>").alias("i"))
    flat = flatten_items(read.select("source_row", "recoded", "i.*"), "source_row", "recoded")
    pairs = F.transform(F.coalesce("code_information", F.array().cast("array<struct<code: string, type: string>>")), lambda c: F.struct(c["code"].alias("code"), c["type"].alias("raw_type")))
    cell = F.struct("payer", "plan", "price_type", "raw", F.col("price_type").alias("field"), "methodology", "non_dollar")
    none = F.lit(None).cast("string")
    place = (F.col("price_type") != "gross").cast("int")
    rows = flat.select(
        "source_row", none.alias("row_reason"), F.col("description").alias("row_raw"), "description", "setting", "billing_class", F.lit("").alias("modifiers"), "recoded", parsing.ordered_codes(pairs).alias("ordered"), place.alias("place"),
        cell.alias("cell"), ((place == 0) & F.col("first_charge")).alias("first"),
    )
    return _coded(rows)


def _struct_fields(ddl: str) -> list[str]:
    """Fields of a DDL schema with colons, for use inside struct<>."""
    out, depth, part = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            part = ""
        else:
            part += ch
    return out


def _coded(rows: DataFrame) -> DataFrame:
    best = F.col("ordered")
    coded = rows.withColumns({"code": parsing.primary_code(best), "code_type": parsing.primary_type(best), "alt_codes": parsing.alternative_codes(best)})
    return coded.select("source_row", "row_reason", "row_raw", "description", "setting", "billing_class", "modifiers", "recoded", "first", "code", "code_type", "alt_codes", "place", "cell.*")


class _Files:
    """Small files beside Spark's, on any store that Spark writes to."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path = spark, spark._jvm.org.apache.hadoop.fs.Path

    def _store(self, path: str):
        return self.path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(self, path: str) -> str | None:
        if not self._store(path).exists(self.path(path)):
            return None
        stream = self._store(path).open(self.path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        out = self._store(path).create(self.path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def delete(self, path: str) -> None:
        self._store(path).delete(self.path(path), True)


def ingest(spark: SparkSession, path: str, contract: Contract, sha: str, out: str) -> Outcome:
    """Parse a file into out/rows and out/rejects; a file that breaks its contract, or has no row or too many rejects, leaves nothing.

    What has been promoted whole is marked by out/promoted.json, written last; such a file is not parsed again (skipped_already_done).
    """
    files = _Files(spark)
    if (done := files.read(f"{out}/promoted.json")) is not None:
        return Outcome(**json.loads(done) | {"outcome": "skipped_already_done"})
    if layout_of(path) == "json":
        found = profiles(spark, [path]).first().asDict()
    else:
        columns, meta, layout = header_of(path)
        found = {"layout": layout, "declared_version": next((v for k, v in meta.items() if k.lower().startswith("version")), None), "columns": columns}
    errors, warnings = validate_header(contract, found["layout"], found["declared_version"], found["columns"])
    if errors:
        return Outcome("quarantined", errors, warnings)
    counted = Observation("counters")
    parsed = parse(spark, path, contract, sha, found["declared_version"], counted).persist()
    try:
        reasons = {r["reason"]: r["n"] for r in parsed.groupBy("reason").agg(F.count("*").alias("n")).collect()}
        rows, rejects = reasons.pop(None, 0), sum(reasons.values())
        wide = [split_wide_header(c) for c in found["columns"]] if found["layout"] == "csv_wide" else []
        dollars = {p[1:3] for p in wide if p and p[0] == "standard_charge" and p[3] == "negotiated_dollar"}
        ignored = sum(1 for p in wide if p and not (p[0] == "standard_charge" and p[3] in ("negotiated_dollar", "methodology")))
        counters = dict(counted.get) | {"payer_plan_columns": len(dollars), "ignored_payer_columns": ignored}
        rate = rejects / max(rows + rejects, 1)
        if not rows or rate > contract.max_reject_rate:
            return Outcome("quarantined", [f"reject rate {rate:.4f} of {rows} rows"], warnings, rows, rejects, reasons, counters)
        canonical(parsed).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/rows")
        rejected(parsed).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/rejects")
        done = Outcome("promoted", [], warnings, rows, rejects, reasons, counters)
        files.write(f"{out}/promoted.json", json.dumps(asdict(done)))
        return done
    finally:
        parsed.unpersist()

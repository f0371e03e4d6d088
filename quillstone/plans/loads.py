"""Versioned loads: stage, first load or SCD2 merge of one hospital, ledger; and pinned reports that can be reproduced."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.gold import report
from quillstone.operators.history import HISTORY, as_of, diff, initial
from quillstone.plans.pricefacts import stage
from quillstone.sources.snapshots import SnapshotTable

LEDGER_SCHEMA = (
    "slug string, source_sha256 string, loaded_at timestamp, mode string, staged_rows bigint, rows_inserted bigint, rows_closed bigint, rows_unchanged bigint, history_version_after bigint, "
    "duration_s double, synthetic boolean"
)


class History:
    """The price history of many hospitals in a snapshot table, and the ledger of its loads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.table, self.ledger = SnapshotTable(spark, f"{path}/history"), SnapshotTable(spark, f"{path}/ledger")

    def loads(self) -> DataFrame:
        return self.ledger.read() if self.ledger.version() >= 0 else self.spark.createDataFrame([], LEDGER_SCHEMA)

    def load(self, slug: str, sha: str, facts: DataFrame, moment: str, synthetic: bool = False) -> dict:
        """Load one hospital's whole price list; a (slug, sha) that was loaded before is skipped, an unchanged one makes no version.

        A merge rewrites only the files that hold a row it closes; new rows go to files of their own.
        """
        if self.loads().where((F.col("slug") == slug) & (F.col("source_sha256") == sha)).limit(1).count():
            return {"slug": slug, "source_sha256": sha, "mode": "skipped_already_loaded"}
        began = time.monotonic()
        staged = stage(facts.where(F.col("hospital_slug") == slug))
        files = self.table.files().get(slug)
        if files is None:
            rows = initial(staged, sha, moment).persist()
            n = rows.count()
            counts = {"mode": "initial", "staged_rows": n, "rows_inserted": n, "rows_closed": 0, "rows_unchanged": 0}
            self.table.commit(slug, rows)
        else:
            history = self.table.read(partitions=[slug]).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
            rows = diff(history, staged, sha, moment, "_file").persist()
            by = {r["action"]: r["n"] for r in rows.groupBy("action").agg(F.count("*").alias("n")).collect()}
            kept, inserted, closed = (by.get(a, 0) for a in ("keep", "insert", "close"))
            counts = {"mode": "merge" if inserted or closed else "noop", "staged_rows": kept + inserted, "rows_inserted": inserted, "rows_closed": closed, "rows_unchanged": kept}
            if inserted or closed:
                touched = {r["_file"] for r in rows.where("action = 'close'").select("_file").distinct().collect()}  # a row a file of one hospital
                stay = [f for f in files if f.rsplit("/", 1)[1] not in touched]
                old = history.where("not is_current")
                again = rows.unionByName(old.withColumn("action", F.lit("old"))).where(F.col("_file").isNull() | F.col("_file").isin(*touched))
                self.table.commit(slug, again.select(*HISTORY), replace=False, keep=stay)
        rows.unpersist()
        record = {"slug": slug, "source_sha256": sha, "loaded_at": datetime.now(timezone.utc), "history_version_after": self.table.version(), "duration_s": round(time.monotonic() - began, 3), "synthetic": synthetic, **counts}
        self.ledger.commit("all", self.spark.createDataFrame([record], LEDGER_SCHEMA), replace=False)
        return record


def render(rows: DataFrame) -> bytes:
    """A report's rows as CSV bytes, amounts with four decimals."""
    buffer = io.StringIO()
    out = csv.writer(buffer, lineterminator="\n")
    out.writerow(rows.columns)
    for r in rows.collect():  # a report has one row a code, type and price type that were asked for
        out.writerow([f"{v:.4f}" if c in ("lowest", "median", "highest") else v for c, v in r.asDict().items()])
    return buffer.getvalue().encode()


def run_report(table: SnapshotTable, codes: tuple[str, ...], price_types: tuple[str, ...], version: int | None = None, moment: str | None = None) -> tuple[bytes, dict]:
    """The spread report of a version (current rows), or of the last version as of a moment."""
    version = table.version() if version is None else version
    rows = table.read(version)
    rows = rows.where("is_current") if moment is None else as_of(rows, moment)
    data = render(report(rows, codes, price_types))
    params = {"codes": list(codes), "price_types": list(price_types), "moment": moment}
    digest = hashlib.sha256(json.dumps(params, sort_keys=True).encode()).hexdigest()
    return data, {"history_version": version, "params": params, "params_sha256": digest, "output_sha256": hashlib.sha256(data).hexdigest()}


def reproduce(table: SnapshotTable, record: dict) -> bool:
    """Whether the report of a record, run again at its version, has the same bytes."""
    p = record["params"]
    _, again = run_report(table, tuple(p["codes"]), tuple(p["price_types"]), record["history_version"], p["moment"])
    return again["output_sha256"] == record["output_sha256"]


def store_quality(spark: SparkSession, path: str, scores: DataFrame) -> int:
    """Append quality rows to the log of all runs; its version."""
    return SnapshotTable(spark, f"{path}/quality").commit("all", scores, replace=False)


def store_metrics(spark: SparkSession, path: str, metrics: DataFrame) -> int:
    """Replace the consolidated run metrics, which are a view of the logs; the table's version."""
    return SnapshotTable(spark, f"{path}/run_metrics").commit("all", metrics)

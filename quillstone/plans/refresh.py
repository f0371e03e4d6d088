"""From a changed file to the history: reprocessing one event, and the incremental driver over all sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.plans.contract import Contract
from quillstone.plans.ingest import Outcome, ingest
from quillstone.plans.loads import History
from quillstone.sources.bronze import read_manifest

GOOD = ("stored", "unchanged_duplicate")


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def latest_files(manifest: DataFrame) -> DataFrame:
    """slug, sha256 and path of each source's last good fetch."""
    last = manifest.where(F.col("outcome").isin(*GOOD)).groupBy("slug").agg(F.max_by(F.struct("sha256", "path"), "fetched_at").alias("f"))
    return last.select("slug", "f.*")


@dataclass
class Refresh:
    """The manifest of fetched files, the sources' contracts, the folder of parsed files and the history, and what has been run.

    load(slug, sha) takes one file from its bytes to the history; both steps skip what is done, so it can be called again at any time.
    """

    spark: SparkSession
    manifest: str
    contracts: dict[str, Contract]
    silver: str
    history: History
    now: Callable[[], str] = _now
    runs: list[dict] = field(default_factory=list)

    def folder(self, slug: str, sha: str) -> str:
        return f"{self.silver}/hospital={slug}/source_sha256={sha}"

    def load(self, slug: str, sha: str, path: str) -> tuple[Outcome, dict | None]:
        """The outcome of parsing and, if there are rows, of loading."""
        began = datetime.now(timezone.utc)
        parsed = ingest(self.spark, path, self.contracts[slug], sha, self.folder(slug, sha))
        if parsed.outcome != "skipped_already_done":
            took = (datetime.now(timezone.utc) - began).total_seconds()
            self.runs.append({"slug": slug, "sha256": sha, "at": began.isoformat(), "source_rows_in": parsed.counters.get("rows_in", 0), "rows_out": parsed.rows_out, "rejects": parsed.rejects, "duration_s": took, "outcome": parsed.outcome, "reject_reasons": parsed.reject_reasons})
        if parsed.outcome == "quarantined":
            return parsed, None
        rows = self.spark.read.parquet(f"{self.folder(slug, sha)}/rows")
        return parsed, self.history.load(slug, sha, rows, self.now())

    def reprocess(self, slug: str, sha: str) -> dict:
        """What became of an event: skipped (not the source's current file), quarantined, already_current, reprocessed or error; it never raises."""
        answer = {"slug": slug, "sha256": sha}
        try:
            found = latest_files(read_manifest(self.spark, self.manifest)).where((F.col("slug") == slug) & (F.col("sha256") == sha)).first()
            if found is None:
                return answer | {"status": "skipped", "detail": "no such file is current"}
            parsed, loaded = self.load(slug, sha, found["path"])
            if loaded is None:
                return answer | {"status": "quarantined", "detail": "; ".join(parsed.reasons)}
            known = parsed.outcome == "skipped_already_done" and loaded["mode"] == "skipped_already_loaded"
            return answer | {"status": "already_current" if known else "reprocessed", "history_mode": loaded["mode"], "rows_inserted": loaded.get("rows_inserted", 0), "detail": loaded["mode"]}
        except Exception as failure:  # noqa: BLE001  one event's failure is a finding, not the end of the stream
            return answer | {"status": "error", "detail": f"{type(failure).__name__}: {failure}"[:200]}

    def handler(self) -> Callable[[str, str], tuple[str, str]]:
        """reprocess() as the stream calls it: (status, detail)."""

        def handle(slug: str, sha: str) -> tuple[str, str]:
            done = self.reprocess(slug, sha)
            return done["status"], done.get("detail", "")

        return handle

    def load_all(self, slugs: list[str] | None = None) -> list[dict]:
        """Every source's current file that the ledger does not know, parsed if need be, then loaded: a record a source."""
        loaded = {(r["slug"], r["source_sha256"]) for r in self.history.loads().select("slug", "source_sha256").collect()}
        records = []
        for r in latest_files(read_manifest(self.spark, self.manifest)).orderBy("slug").collect():  # a row a source
            if slugs and r["slug"] not in slugs:
                continue
            if (r["slug"], r["sha256"]) in loaded:
                records.append({"slug": r["slug"], "source_sha256": r["sha256"], "mode": "unchanged"})
                continue
            parsed, done = self.load(r["slug"], r["sha256"], r["path"])
            records.append(done or {"slug": r["slug"], "source_sha256": r["sha256"], "mode": parsed.outcome, "reasons": parsed.reasons})
        return records

    def run_log(self) -> DataFrame:
        """The parses of this object."""
        schema = "slug string, sha256 string, at string, source_rows_in bigint, rows_out bigint, rejects bigint, duration_s double, outcome string, reject_reasons map<string, bigint>"
        return self.spark.createDataFrame(self.runs, schema)

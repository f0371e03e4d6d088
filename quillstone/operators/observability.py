"""Operational logs: latest records, alerts on shrinking, failing or changing sources, and the consolidated run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators.gold import AS_OF, parse_date, registry
from quillstone.plans.pricefacts import read
from quillstone.plans.registry import query

SHRINK, STREAK, STALE_DAYS = 0.5, 3, 45
GOOD = ("stored", "unchanged_duplicate")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slug, seq (log order), outcome, size_bytes, layout and version of each fetch, out of events."""
    outcome = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "unchanged_duplicate").otherwise("stored")
    k = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("slug"), F.struct("ts", k).alias("seq"), k, outcome.alias("outcome"), (F.col("value") * 1000).cast("long").alias("size_bytes"),
        F.when(k % 17 == 0, "csv_wide").otherwise("csv_tall").alias("layout"), F.when(k % 13 == 0, "2.0.0").when(k % 11 == 0, F.lit(None)).otherwise("3.0.0").alias("version"),
    )


LOG = """
WITH log AS (
  SELECT 'u' || user_id AS slug, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'unchanged_duplicate' ELSE 'stored' END AS outcome, trunc(value * 1000)::BIGINT AS size_bytes,
    CASE WHEN event_id % 17 = 0 THEN 'csv_wide' ELSE 'csv_tall' END AS layout, CASE WHEN event_id % 13 = 0 THEN '2.0.0' WHEN event_id % 11 = 0 THEN NULL ELSE '3.0.0' END AS version FROM events),
ok AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, event_id DESC) AS rn, lag(size_bytes) OVER (PARTITION BY slug ORDER BY ts, event_id) AS prev FROM log WHERE outcome <> 'failed'),
shrink AS (SELECT slug, prev AS prev_size, size_bytes AS cur_size FROM ok WHERE rn = 1 AND prev > 0 AND size_bytes > 0 AND size_bytes < prev * 0.5::DOUBLE),
streak AS (
  SELECT slug, count(*)::BIGINT AS streak FROM log l WHERE outcome = 'failed' AND NOT EXISTS (SELECT 1 FROM log g WHERE g.slug = l.slug AND g.outcome <> 'failed' AND (g.ts, g.event_id) > (l.ts, l.event_id)) GROUP BY slug HAVING count(*) >= 3),
two AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts DESC, event_id DESC) AS rn, lag(layout) OVER (PARTITION BY slug ORDER BY ts, event_id) AS prev_layout, lag(version) OVER (PARTITION BY slug ORDER BY ts, event_id) AS prev_version, count(*) OVER (PARTITION BY slug) AS n FROM log),
shape AS (SELECT slug, prev_layout, layout, prev_version, version, layout IS DISTINCT FROM prev_layout AS layout_changed, version IS DISTINCT FROM prev_version AS version_changed FROM two WHERE rn = 1 AND n >= 2)"""


def latest(log: DataFrame) -> DataFrame:
    """The last good record of each slug: one aggregation, no sort."""
    kept = [c for c in log.columns if c not in ("slug", "seq")]
    best = log.where(F.col("outcome").isin(*GOOD)).groupBy("slug").agg(F.max_by(F.struct(*kept), "seq").alias("r"))
    return best.select("slug", "r.*")


def last_two(log: DataFrame, *columns: str) -> DataFrame:
    """slug, columns and prev_<column> of each slug's last record that has one before it."""
    order = Window.partitionBy("slug").orderBy(F.desc("seq"))
    kept = log.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    pick = lambda c, rn: F.max(F.when(F.col("rn") == rn, F.col(c)))
    return kept.groupBy("slug").agg(F.count("*").alias("n"), *[pick(c, 1).alias(c) for c in columns], *[pick(c, 2).alias(f"prev_{c}") for c in columns]).where("n = 2").drop("n")


def shrinks(log: DataFrame) -> DataFrame:
    two = last_two(log.where(F.col("outcome").isin(*GOOD)), "size_bytes")
    now, then = F.col("size_bytes"), F.col("prev_size_bytes")
    return two.where((then > 0) & (now > 0) & (now < then * SHRINK)).select("slug", then.alias("prev_size"), now.alias("cur_size"))


def failure_streaks(log: DataFrame) -> DataFrame:
    """Failures after each slug's last good record, if there are STREAK at least."""
    good = log.groupBy("slug").agg(F.max(F.when(F.col("outcome") != "failed", F.col("seq"))).alias("good"))
    after = log.where("outcome = 'failed'").join(good, "slug").where(F.col("good").isNull() | (F.col("seq") > F.col("good")))
    return after.groupBy("slug").agg(F.count("*").alias("streak")).where(F.col("streak") >= STREAK)


def shape_changes(log: DataFrame) -> DataFrame:
    two = last_two(log, "layout", "version")
    differs = lambda c: ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    return two.select("slug", "prev_layout", "layout", "prev_version", "version", differs("layout").alias("layout_changed"), differs("version").alias("version_changed"))


def freshness(profiles: DataFrame, today: str = AS_OF) -> DataFrame:
    """slug and days since the last update (null: not a date) of profiles that are stale or have no date."""
    days = F.datediff(F.lit(today).cast("date"), parse_date(F.col("last_updated_on")))
    return profiles.select(F.col("hospital_slug").alias("slug"), days.alias("days")).where(F.col("days").isNull() | (F.col("days") > STALE_DAYS))


def alerts(log: DataFrame, profiles: DataFrame) -> DataFrame:
    """severity, slug and kind of all alerts."""
    row = lambda df, severity, kind: df.select(F.lit(severity).alias("severity"), "slug", (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"))
    shape, old = shape_changes(log), freshness(profiles)
    found = [
        row(shrinks(log), "error", "shrink"), row(failure_streaks(log), "error", "repeated_failure"), row(shape.where("layout_changed"), "error", "layout_change"),
        row(shape.where("version_changed"), "warning", "version_change"), row(old, "warning", F.when(F.col("days").isNull(), "unparseable_date").otherwise("stale")),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@query("latest_per_key", LOG + " SELECT slug, event_id, outcome, size_bytes FROM ok WHERE rn = 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(manifest(spark, sf_dir)).select("slug", "event_id", "outcome", "size_bytes")


@query("manifest_latest", LOG + " SELECT slug, layout, version FROM ok WHERE rn = 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(manifest(spark, sf_dir)).select("slug", "layout", "version")


@query("shrink_alert", LOG + " SELECT * FROM shrink")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shrinks(manifest(spark, sf_dir))


@query("failure_streak", LOG + " SELECT * FROM streak")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_streaks(manifest(spark, sf_dir))


@query("shape_change", LOG + " SELECT * FROM shape WHERE layout_changed OR version_changed")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_changes(manifest(spark, sf_dir)).where("layout_changed OR version_changed")


@query("alerts_all", LOG + """, old AS (SELECT 'h' || n_nationkey AS slug, date_diff('day', CASE n_nationkey % 4 WHEN 0 THEN DATE '2026-03-01' WHEN 1 THEN DATE '2026-07-01' WHEN 2 THEN DATE '2025-01-15' END, DATE '2026-10-01') AS days FROM nation)
SELECT 'error' AS severity, slug, 'shrink' AS kind FROM shrink UNION ALL SELECT 'error', slug, 'repeated_failure' FROM streak UNION ALL SELECT 'error', slug, 'layout_change' FROM shape WHERE layout_changed
UNION ALL SELECT 'warning', slug, 'version_change' FROM shape WHERE version_changed UNION ALL SELECT 'warning', slug, CASE WHEN days IS NULL THEN 'unparseable_date' ELSE 'stale' END FROM old WHERE days IS NULL OR days > 45""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(manifest(spark, sf_dir), registry(spark, sf_dir))


METRICS = ("run_id", "stage", "slug", "started_at", "rows_in", "rows_out", "rows_rejected", "duration_s", "outcome", "est_cost_usd", "detail")


def _metric(log: DataFrame, stage: Column | str, **columns: Column | str | int | float) -> DataFrame:
    kinds = {"rows_in": "long", "rows_out": "long", "rows_rejected": "long", "duration_s": "double", "est_cost_usd": "double"}
    given = {"stage": F.lit(stage) if isinstance(stage, str) else stage, "rows_in": F.lit(0), "rows_out": F.lit(0), "rows_rejected": F.lit(0), "est_cost_usd": F.lit(0.0), "detail": F.lit("")} | columns
    return log.select(*[F.coalesce(given[c] if isinstance(given[c], Column) else F.col(given[c]), F.lit("" if c not in kinds else 0)).cast(kinds.get(c, "string")).alias(c) for c in METRICS])


def fetch_metrics(manifest: DataFrame) -> DataFrame:
    """Of a manifest: slug, fetched_at, duration_s, outcome, error."""
    return _metric(manifest, "bronze_download", run_id=F.concat_ws("-", F.lit("bronze"), "slug", "fetched_at"), slug="slug", started_at="fetched_at", duration_s="duration_s", outcome=F.coalesce("outcome", F.lit("unknown")), detail=F.substring("error", 1, 200))


def parse_metrics(runs: DataFrame) -> DataFrame:
    """Of a run log: slug, sha256, at, source_rows_in, rows_out, rejects, duration_s, outcome, reject_reasons."""
    return _metric(runs, "silver_parse", run_id=F.concat_ws("-", F.lit("silver"), "slug", F.substring("sha256", 1, 12)), slug="slug", started_at="at", rows_in="source_rows_in", rows_out="rows_out", rows_rejected="rejects", duration_s="duration_s", outcome="outcome", detail=F.substring(F.to_json("reject_reasons"), 1, 200))


def load_metrics(ledger: DataFrame) -> DataFrame:
    """Of the history's ledger."""
    closed = F.concat(F.lit("closed="), F.col("rows_closed").cast("string"), F.lit(" synthetic="), F.col("synthetic").cast("string"))
    return _metric(ledger, "history_load", run_id=F.concat_ws("-", F.lit("history"), "slug", F.substring("source_sha256", 1, 12)), slug="slug", started_at=F.col("loaded_at").cast("string"), rows_in="staged_rows", rows_out=F.col("rows_inserted") + F.col("rows_unchanged"), duration_s="duration_s", outcome="mode", detail=closed)


def check_metrics(results: DataFrame) -> DataFrame:
    """Of models and data checks that have run: kind (model, test), name, at, duration_s, status, message."""
    return _metric(results, F.concat(F.lit("dbt_"), F.col("kind")), run_id=F.concat_ws("-", F.lit("dbt"), "name", "at"), slug="name", started_at="at", duration_s="duration_s", outcome="status", detail=F.substring("message", 1, 200))


def run_metrics(fetches: DataFrame, parses: DataFrame, loads: DataFrame, results: DataFrame) -> DataFrame:
    """The logs of the four stages as one table (METRICS)."""
    return fetch_metrics(fetches).unionByName(parse_metrics(parses)).unionByName(load_metrics(loads)).unionByName(check_metrics(results))


@query("run_metrics", LOG + """, m AS (
  SELECT 'bronze-' || slug || '-' || event_id AS run_id, 'bronze_download' AS stage, slug, event_id::VARCHAR AS started_at, 0::BIGINT AS rows_in, 0::BIGINT AS rows_out, 0::BIGINT AS rows_rejected, 0.5::DOUBLE AS duration_s, outcome, CASE outcome WHEN 'failed' THEN repeat('x', 200) ELSE '' END AS detail FROM log
  UNION ALL SELECT 'silver-h' || n_nationkey || '-' || substr(md5(n_name), 1, 12), 'silver_parse', 'h' || n_nationkey, '2026-01-01', 1000 + n_nationkey * 7, 1000, n_nationkey * 7, 2.0, CASE WHEN n_nationkey * 7 > 100 THEN 'quarantined' ELSE 'promoted' END, '{"ragged_row":' || n_nationkey || '}' FROM nation
  UNION ALL SELECT 'history-h' || n_nationkey || '-' || substr(md5(n_name), 1, 12), 'history_load', 'h' || n_nationkey, '2026-02-01 00:00:00', 1000, 990, 0, 1.25, 'merge', 'closed=' || n_nationkey || ' synthetic=false' FROM nation
  UNION ALL SELECT 'dbt-' || r_name || '-2026-03-01', 'dbt_' || CASE WHEN r_regionkey < 2 THEN 'model' ELSE 'test' END, r_name, '2026-03-01', 0, 0, 0, 0.25, CASE r_regionkey WHEN 3 THEN 'warn' ELSE 'pass' END, '' FROM region)
SELECT run_id, stage, slug, started_at, rows_in, rows_out, rows_rejected, duration_s, outcome, 0.0::DOUBLE AS est_cost_usd, detail FROM m""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetches = manifest(spark, sf_dir).select("slug", F.col("event_id").cast("string").alias("fetched_at"), F.lit(0.5).alias("duration_s"), "outcome", F.when(F.col("outcome") == "failed", F.repeat(F.lit("x"), F.lit(250))).alias("error"))
    k, sha = F.substring("hospital_slug", 2, 9).cast("int"), F.md5(F.col("hospital_name").cast("binary"))
    reg = registry(spark, sf_dir).select("*", k.alias("k"), sha.alias("sha256"), F.col("hospital_slug").alias("slug"))
    done = F.when(F.col("rejects") > 100, "quarantined").otherwise("promoted")
    parses = reg.select("slug", "sha256", F.lit("2026-01-01").alias("at"), (F.col("rows_out") + F.col("rejects")).alias("source_rows_in"), "rows_out", "rejects", F.lit(2.0).alias("duration_s"), done.alias("outcome"), F.create_map(F.lit("ragged_row"), F.col("k").cast("long")).alias("reject_reasons"))
    loads = reg.select("slug", F.col("sha256").alias("source_sha256"), F.lit("2026-02-01").cast("timestamp").alias("loaded_at"), F.lit("merge").alias("mode"), F.col("rows_out").alias("staged_rows"), F.lit(90).alias("rows_inserted"), F.lit(900).alias("rows_unchanged"), F.col("k").alias("rows_closed"), F.lit(1.25).alias("duration_s"), F.lit(False).alias("synthetic"))
    r = F.col("r_regionkey")
    results = read(spark, sf_dir, "region").select(F.when(r < 2, "model").otherwise("test").alias("kind"), F.col("r_name").alias("name"), F.lit("2026-03-01").alias("at"), F.lit(0.25).alias("duration_s"), F.when(r == 3, "warn").otherwise("pass").alias("status"), F.lit(None).cast("string").alias("message"))
    return run_metrics(fetches, parses, loads, results)


@query("filter_pushdown", "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_returnflag = 'R' AND l_quantity > 20")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    return line.where((F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20)).select("l_orderkey", "l_extendedprice")


@query("from_json_props", "SELECT event_type, count(*)::BIGINT AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY event_type")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("total"))

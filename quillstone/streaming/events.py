"""File-changed events as a stream: written one JSON file each, read from a folder or Kafka, and handed to a reprocessor."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT_SCHEMA = "event_id string, slug string, sha256 string, size_bytes bigint, outcome string, detected_at string"
FILES_PER_BATCH = 10
RESULT_SCHEMA = "event_id string, slug string, sha256 string, result string, detail string"


def emit(folder: str, slug: str, sha256: str, size_bytes: int, detected_at: str, outcome: str = "stored") -> str:
    """Write one event; it appears whole. Only new content should be announced."""
    event = {"event_id": uuid.uuid4().hex, "slug": slug, "sha256": sha256, "size_bytes": size_bytes, "outcome": outcome, "detected_at": detected_at}
    os.makedirs(folder, exist_ok=True)
    hidden, final = f"{folder}/.{event['event_id']}", f"{folder}/{event['event_id']}.json"
    with open(hidden, "w", encoding="utf-8") as f:
        json.dump(event, f)
    os.replace(hidden, final)
    return event["event_id"]


def read_files(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


def parsed(value: Column) -> Column:
    """The event in a Kafka record's value."""
    return F.from_json(value.cast("string"), EVENT_SCHEMA)


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Events from Kafka; needs the connector's jar on the class path."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    for k, v in options.items():
        source = source.option(k, v)
    # a batch's events are handed over on the driver, so their number is bounded
    return source.option("maxOffsetsPerTrigger", options.get("maxOffsetsPerTrigger", str(FILES_PER_BATCH))).load().select(parsed(F.col("value")).alias("e")).select("e.*")


def latest_events(batch: DataFrame) -> DataFrame:
    """Of the events of one (slug, sha256) in a batch the last one: a batch's repeats start one reprocessing."""
    fields = [c for c in batch.columns if c not in ("slug", "sha256")]
    last = batch.groupBy("slug", "sha256").agg(F.max_by(F.struct(*fields), F.struct("detected_at", "event_id")).alias("e"))
    return last.select("slug", "sha256", "e.*")


def to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Announce events (EVENT_SCHEMA) on a topic, keyed by slug; needs the connector's jar on the class path."""
    rows = events.select(F.col("slug").alias("key"), F.to_json(F.struct(*[c.split(" ")[0] for c in EVENT_SCHEMA.split(", ")])).alias("value"))
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start(events: DataFrame, reprocess: Callable[[str, str], tuple[str, str]], results: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Reprocess each micro-batch's files, append (event, result) to results, and end when no events are left; with every (an interval), go on until stopped.

    reprocess(slug, sha256) returns (result, detail); an exception becomes the result 'error', so one bad file does not stop the stream. A
    batch has FILES_PER_BATCH events at most, so its rows are handed over on the driver, which starts the Spark jobs that do the work.
    A batch that is run again writes its results to the same folder.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = []
        for e in latest_events(batch).orderBy("detected_at", "event_id").collect():
            try:
                result, detail = reprocess(e["slug"], e["sha256"])
            except Exception as failure:  # noqa: BLE001  the contract of the handler: it never raises
                result, detail = "error", f"{type(failure).__name__}: {failure}"[:200]
            rows.append((e["event_id"], e["slug"], e["sha256"], result, detail))
        if rows:
            batch.sparkSession.createDataFrame(rows, RESULT_SCHEMA).write.mode("overwrite").parquet(f"{results}/batch={batch_id}")

    return events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if every is None else {"processingTime": every})).start()

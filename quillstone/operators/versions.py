"""Time travel: a version of the snapshot table read after later ones were committed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillstone.operators.history import T2, V2, both_versions, merge
from quillstone.plans.registry import query
from quillstone.session import shared_dir
from quillstone.sources.snapshots import SnapshotTable


@query("time_travel_version", V2 + " SELECT row_id, key_hash, amount, true AS is_current FROM h1")
def time_travel_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of a history of two, committed to the shared folder."""
    table = SnapshotTable(spark, f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}")
    first, second = both_versions(spark, sf_dir)
    table.commit("all", first)
    table.commit("all", merge(table.read(0), second, "v2", T2))
    return table.read(0).select("row_id", "key_hash", "amount", "is_current")

"""The registry of sources: a list of hospitals, kept as YAML, handed to Spark as CSV."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession

# The columns of the registry.
COLUMNS = ("slug", "name", "state", "group", "index_url", "mrf_url")


def read_yaml(path: str) -> list[dict]:
    """The hospitals of a YAML registry; needs PyYAML."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)["hospitals"]


def export(hospitals: list[dict], path: str) -> int:
    """Write hospitals as CSV, whole or not at all; how many."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(COLUMNS)
        out.writerows([h.get(c) for c in COLUMNS] for h in hospitals)
    os.replace(f"{path}.part", path)
    return len(hospitals)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"`{c}` string" for c in COLUMNS)).csv(path, header=True, escape='"', multiLine=True)


def staged(registry: DataFrame) -> DataFrame:
    """The registry as the marts name its columns."""
    return registry.withColumnsRenamed({"slug": "hospital_slug", "name": "hospital_name", "group": "hospital_group"})

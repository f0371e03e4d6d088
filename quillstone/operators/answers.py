"""Language-model answers as a pluggable scorer: strict parsing, retries, a cache that a rerun resumes from, bounded parallelism."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTEMPTS = 12
ANSWER_SCHEMA = "item_id long, llm_code string, llm_conf string, attempts int"


def parse_answer(raw: str, candidates: list[str] | None = None) -> tuple[str | None, str] | None:
    """(code or None, confidence) of an answer {"code": ..., "confidence": "high" | "medium" | "low"}; None if it is not one.

    With candidates, a code outside them is no answer.
    """
    try:
        answer = json.loads(raw)
    except (TypeError, ValueError):
        return None
    if not isinstance(answer, dict) or answer.get("confidence") not in ("high", "medium", "low"):
        return None
    code = answer.get("code")
    if code is not None and (not isinstance(code, str) or candidates and code not in candidates):
        return None
    return code, answer["confidence"]


def ask(items: DataFrame, model: Callable[[str, list[str] | None], str], parallel: int = 3, known: DataFrame | None = None) -> DataFrame:
    """item_id, llm_code, llm_conf, attempts of items (item_id, text, candidates array or null), parallel requests at a time.

    model(text, candidates) returns the raw answer. Items in known (earlier answers, ANSWER_SCHEMA) are not asked again.
    """
    todo = items if known is None else items.join(known.select("item_id"), "item_id", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item_id, text, candidates in zip(batch["item_id"], batch["text"], batch["candidates"]):
                offered = None if candidates is None else list(candidates)
                found, used = None, 0
                while found is None and used < ATTEMPTS:
                    used += 1
                    try:
                        found = parse_answer(model(text, offered), offered)
                    except Exception:  # noqa: BLE001  a failed request is tried again
                        found = None
                code, confidence = found or (None, "low")
                rows.append((item_id, code, confidence, used))
            yield pd.DataFrame(rows, columns=["item_id", "llm_code", "llm_conf", "attempts"])

    # ids cross to Python as text, since numbers beside nulls would turn to floats there
    sent = todo.select(F.col("item_id").cast("string").alias("item_id"), "text", "candidates").repartition(parallel)
    fresh = sent.mapInPandas(run, ANSWER_SCHEMA.replace("item_id long", "item_id string")).withColumn("item_id", F.col("item_id").cast("long"))
    return fresh if known is None else known.select("item_id", "llm_code", "llm_conf", "attempts").unionByName(fresh)


def with_answers(items: DataFrame, answers: DataFrame) -> DataFrame:
    """items with llm_code and llm_conf of their answers; null for items that were not asked."""
    return items.join(answers.select("item_id", "llm_code", "llm_conf"), "item_id", "left")

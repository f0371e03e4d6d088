"""The raw store: files kept once under their content's hash, the manifest of fetches, and table sinks.

Fetching is driver work, one host at a time. The session is anything with get(url, stream=True, timeout=...) as the usual HTTP
clients have it, so that this module needs none of them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

CHUNK, ATTEMPTS, BACKOFF_S, PAUSE_S = 1 << 20, 3, 5.0, 2.0
MANIFEST_SCHEMA = "slug string, url string, outcome string, sha256 string, size_bytes bigint, path string, fetched_at string, duration_s double, error string"
_NAMED = re.compile(r"filename\*?=(?:UTF-8'')?\"?([^\";]+)", re.I)


def file_name(url: str, headers: dict) -> str:
    """The name that the answer or else the URL gives, with only letters, digits, dot, dash and underscore."""
    named = _NAMED.search(headers.get("Content-Disposition") or headers.get("content-disposition") or "")
    name = named.group(1) if named else urlsplit(url).path.rpartition("/")[2]
    return re.sub(r"[^A-Za-z0-9._-]+", "_", unquote(name).strip()).lstrip(".")[-150:] or "file"


def fetch(session, slug: str, url: str, store: str, now: Callable[[], str], sleep: Callable[[float], None] = time.sleep) -> dict:
    """Fetch one file into store/slug/<sha256>/<name>, read-only; a manifest record of what came of it.

    The outcome is stored, unchanged_duplicate (this content is there) or failed (after ATTEMPTS, with growing pauses). A part file becomes
    visible only when it is whole.
    """
    began, error = time.monotonic(), ""
    record = {"slug": slug, "url": url, "fetched_at": now(), "sha256": None, "size_bytes": 0, "path": None}
    for attempt in range(1, ATTEMPTS + 1):
        part = os.path.join(store, slug, f".{os.getpid()}-{attempt}.part")
        try:
            os.makedirs(os.path.dirname(part), exist_ok=True)
            digest, size = hashlib.sha256(), 0
            answer = session.get(url, stream=True, timeout=60)
            answer.raise_for_status()
            with open(part, "wb") as out:
                for piece in answer.iter_content(CHUNK):
                    digest.update(piece)
                    size += out.write(piece)
            folder = os.path.join(store, slug, digest.hexdigest())
            path = os.path.join(folder, file_name(url, dict(answer.headers)))
            known = os.path.isdir(folder) and any(os.scandir(folder))
            if known:
                os.remove(part)
                path = os.path.join(folder, sorted(os.listdir(folder))[0])
            else:
                os.makedirs(folder, exist_ok=True)
                os.chmod(part, 0o444)
                os.replace(part, path)
            record |= {"sha256": digest.hexdigest(), "size_bytes": size, "path": path}
            return record | {"outcome": "unchanged_duplicate" if known else "stored", "error": "", "duration_s": round(time.monotonic() - began, 3)}
        except Exception as failure:  # noqa: BLE001  any failure of the transfer is a record, not a crash
            error = f"{type(failure).__name__}: {failure}"[:300]
            if os.path.exists(part):
                os.remove(part)
            if attempt < ATTEMPTS:
                sleep(BACKOFF_S * attempt)
    return record | {"outcome": "failed", "error": error, "duration_s": round(time.monotonic() - began, 3)}


def fetch_all(session, sources: list[tuple[str, str]], store: str, manifest: str, now: Callable[[], str], sleep: Callable[[float], None] = time.sleep, on_stored: Callable[[dict], None] | None = None) -> list[dict]:
    """Fetch (slug, url) one after the other with a pause between; append each record; on_stored is told of new content only."""
    records = []
    for i, (slug, url) in enumerate(sources):
        if i:
            sleep(PAUSE_S)
        records.append(fetch(session, slug, url, store, now, sleep))
        append(manifest, records[-1])
        if on_stored is not None and records[-1]["outcome"] == "stored":
            on_stored(records[-1])
    return records


def append(manifest: str, record: dict) -> None:
    os.makedirs(os.path.dirname(manifest) or ".", exist_ok=True)
    with open(manifest, "a", encoding="utf-8") as f:
        f.write(json.dumps(record) + "\n")


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(manifest)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], rows_per_insert: int = 500) -> None:
    """Overwrite a database table, truncated rather than dropped, in batches; needs the database's driver on the class path."""
    df.write.jdbc(url, table, mode="overwrite", properties=properties | {"batchsize": str(rows_per_insert), "truncate": "true"})

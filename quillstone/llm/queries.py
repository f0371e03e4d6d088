"""Every query of the corpus operators, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from . import bpe, chat, fingerprints, html, langid, licenses, media, mixing, simhash, tokencount

MODULES = (mixing, media, langid, bpe, simhash, fingerprints, html, chat, tokencount, licenses)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

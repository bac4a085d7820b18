"""Queries by name, and SQL where SQL can express them."""

from __future__ import annotations

from . import oracle, queries

LLM_QUERIES = {name: query for name, query in vars(queries).items() if name.startswith("op")}
LLM_ORACLE: dict[str, str] = {"op7_warc": oracle.WARC, "op9_near_dup": oracle.NEAR_DUP}

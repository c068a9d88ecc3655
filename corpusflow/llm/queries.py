"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("align", "decontaminate", "licenses", "mixing", "neardup", "quality", "repeats", "secrets", "simhash", "tokens", "topk", "warc", "whitening")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _m = import_module(f"corpusflow.llm.{_name}")
    QUERIES |= _m.QUERIES
    ORACLE |= _m.ORACLE

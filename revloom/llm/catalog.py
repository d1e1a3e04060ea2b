"""Registered queries of the subpackage by name, with their SQL where there is one."""

from __future__ import annotations

from importlib import import_module

from revloom.llm.common import small_batches

MODULES = [
    "ann",
    "bpe",
    "decontamination",
    "jaccard",
    "langid",
    "linededup",
    "pii",
    "sharding",
    "simhash",
    "spelling",
    "toxicity",
    "trie",
    "warc",
]


def _gather(attribute: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(getattr(import_module(f"revloom.llm.{module}"), attribute))
    return found


def _bounded(query):
    def run(spark, sf_dir):
        small_batches(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict:
    return {name: _bounded(query) for name, query in _gather("QUERIES").items()}


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLE")

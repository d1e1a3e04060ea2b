"""Every registered query by name, with its SQL where there is one."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "ingest",
    "cleaning",
    "history",
    "text",
    "changes",
    "labelling",
    "features",
    "learning",
]


def _gather(attribute: str) -> dict:
    found: dict = {}
    for module in MODULES:
        entries = getattr(import_module(f"revloom.plans.{module}"), attribute)
        twice = found.keys() & entries.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        found.update(entries)
    return found


def _in_utc(query):
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict:
    return {name: _in_utc(query) for name, query in _gather("QUERIES").items()}


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLE")

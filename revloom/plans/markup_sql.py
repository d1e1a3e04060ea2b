"""Markup to text in DuckDB's SQL, written on its own.

The given pages are HTML: of wiki markup they have little, and templates and tables
are looked for a few levels deep only. The wiki rules are tested by hand.
"""

from __future__ import annotations

# Fixed values: (pattern, replacement) in the order they apply.
RULES = [
    ("(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>|<ref\\b[^>]*/>|<ref\\b.*?</ref>", ""),
    ("\\{\\{[^{}]*\\}\\}", ""),
    ("\\{\\{[^{}]*\\}\\}", ""),
    ("(?s)\\{\\|.*?\\|\\}", ""),
    ("\\[\\[(?:[^\\[\\]]*\\|)?([^\\[\\]|]*)\\]\\]", "\\1"),
    ("\\[https?://[^\\s\\]]+(?: +([^\\]\\n]*))?\\]", "\\1"),
    ("'{5}|'{2,3}", ""),
    ("(?m)^={1,6} *([^=\\n]+?) *={1,6} *$", "\\1"),
    ("(?s)</?[A-Za-z][^>]*>|<![A-Za-z][^>]*>", ""),
]


def plain_text_sql(column: str) -> str:
    sql = f"coalesce({column}, '')"
    for pattern, replacement in RULES:
        quoted = pattern.replace("'", "''")
        sql = f"regexp_replace({sql}, '{quoted}', '{replacement}', 'g')"
    for entity, character in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        sql = f"replace({sql}, '&{entity};', '{character}')"
    return sql

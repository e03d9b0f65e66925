"""All queries of this subpackage and the SQL that has to give the same rows."""

from __future__ import annotations

from keyflow.llm import archives, decontaminate, licenses, lines, minhash, negatives, ngrams, pieces, preferences, quality, secrets, tokens, tries

MODULES = [licenses, lines, pieces, tokens, quality, preferences, secrets, decontaminate, ngrams, archives, negatives, tries, minhash]


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}

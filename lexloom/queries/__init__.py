"""Registered queries over the driver's tables, and DuckDB's form of each."""

from __future__ import annotations

from . import corpus, files, lexicon, mining, structure

QUERIES = mining.QUERIES | corpus.QUERIES | structure.QUERIES | files.QUERIES | lexicon.QUERIES
ORACLE_SQL = mining.ORACLE_SQL | corpus.ORACLE_SQL | structure.ORACLE_SQL | files.ORACLE_SQL | lexicon.ORACLE_SQL

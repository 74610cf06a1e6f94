"""Quality rules kept as a bitmask ledger.

Every document is measured once and every rule evaluated once; the ledger keeps
the measurements and one bit for each rule that fails. A policy is a version and
a mask over those bits, so applying another version, or asking what a rule alone
rejects, needs bitwise work on the ledger and never the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, raw_bytes, small_batches, texts, tidy

SYMBOLS = b"#*$%&|<>"
_SPACES_AND_TAILS = bytes([32, *range(9, 14), *range(0x80, 0xC0)])
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim")


@dataclass(frozen=True)
class Rule:
    """A rule fails where the SQL predicate over the measurements holds. The bit never changes."""

    bit: int
    name: str
    fails: str


#: Bits are permanent: a changed threshold is a new rule with a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "4 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "exclamations", "2 * n_exclaim > n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
    Rule(6, "long_words", "word_chars > 25 * n_words"),
)
BASE = 0b11
#: Version to mask of the rules it enforces.
POLICIES = {"base": BASE, "v1": 0b0111, "v2": 0b1111111}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in some 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter(map(seen.setdefault, words, range(n)), np.int64, n)
    if n < 1 << 21:
        keys = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(n, bool)
    hit = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        covered[hit + k] = True
    return int(np.count_nonzero(covered))


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()  # splits at blanks and 09 to 0D, as the contract's words do
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), len(text.translate(None, _SPACES_AND_TAILS)), len(text) - len(text.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words), text.count(b"!")


def failed_bits(rules: tuple[Rule, ...] = RULES, within: str = "") -> Column:
    """The bits of the rules that fail, from measurements that are columns, or fields of the column ``within``."""
    own = re.compile(r"\b(" + "|".join(MEASURES) + r")\b")
    named = lambda r: own.sub(rf"{within}.\1", r.fails) if within else r.fails
    return F.expr(" | ".join(f"if({named(r)}, {1 << r.bit}L, 0L)" for r in rules) or "0L")


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, the measurements and ``failed_bits``.

    Works on whole texts without a shuffle. Null and empty texts have no words and
    no lines; repeated rows and null doc_ids give rows of their own; very long texts are
    measured whole; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(x) for x in raw_bytes(batch.column(1))]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *MEASURES])

    measured = texts(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, " + ", ".join(f"{x} long" for x in MEASURES))
    return measured.withColumn("failed_bits", failed_bits(rules))


def apply_policy(held: DataFrame, version: str = "v2", policies: dict[str, int] = POLICIES) -> DataFrame:
    """The ledger with ``kept`` and the ``rejected_by`` bits of one policy version."""
    mask = policies[version]
    return held.withColumn("rejected_by", F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))).withColumn("kept", F.col("rejected_by") == 0)


def passing(docs: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES, policies: dict[str, int] = POLICIES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, all columns as they are and without a shuffle: the ledger's
    measurements and bits beside each row, the policy's mask over them, and both dropped again."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<" + ", ".join(f"{x}: bigint" for x in MEASURES) + ">")
    def measures(column: pa.Array) -> pa.Array:
        found = [measure(x) for x in raw_bytes(column)]
        columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * len(MEASURES)
        return pa.StructArray.from_arrays(columns, MEASURES)

    measured = docs.withColumn("__measures", measures(F.col(f"`{text_col}`").cast("string")))
    held = measured.withColumn("__bits", failed_bits(rules, "__measures"))
    return held.where(F.col("__bits").bitwiseAND(F.lit(policies[version]).cast("long")) == 0).drop("__measures", "__bits")


def ablation(held: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES, policies: dict[str, int] = POLICIES) -> DataFrame:
    """For each rule of a policy: documents it fails, those only it rejects, and the
    documents kept without it. The ledger first shrinks to one row a bit pattern."""
    mask = policies[version]
    patterns = held.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    own = [r for r in rules if mask >> r.bit & 1]
    dim = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("flag")) for r in own]))
    rows = patterns.select("bits", "n", dim.alias("r")).select("bits", "n", "r.rule", "r.flag")
    fails, alone = F.col("bits").bitwiseAND(F.col("flag")) != 0, F.col("bits") == F.col("flag")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return rows.groupBy("rule").agg(count(fails).alias("n_failed"), count(alone).alias("n_only"), count((F.col("bits") == 0) | alone).alias("n_kept_without"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base measurements and the verdict of policy v2."""
    held = apply_policy(ledger(documents(spark, sf_dir)), "v2")
    return held.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (F.col("failed_bits").bitwiseAND(F.lit(BASE).cast("long")) != 0).alias("base_failed"), "kept", "failed_bits", "n_lines", "n_exclaim")


#: DuckDB for ``op5_quality_rules``. RE2 has no class for the bytes of white space alone, so they are listed.
OP5_SQL = r"""
WITH w AS (
  SELECT rowid_ AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)
), pos AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), tri AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM pos
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM tri) WHERE k > 1
), cov AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, i AS j FROM rep UNION ALL SELECT r, i + 1 FROM rep UNION ALL SELECT r, i + 2 FROM rep) GROUP BY r
), ln AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaim
  FROM w LEFT JOIN ln USING (r) LEFT JOIN cov USING (r)
), b AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_exclaim > n_words THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 25 * n_words THEN 64 ELSE 0 END AS BIGINT) AS failed_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits, n_lines, n_exclaim FROM b
"""

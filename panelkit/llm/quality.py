"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per
failed rule.  A policy is a version and a mask of the rules it enforces, so any policy, old or
new, is a bitwise test on the ledger, and ablations (what would stay if one rule were dropped)
come from counts per bit pattern: at most 2**rules rows, whatever the corpus holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a window that counts as repeated.
WINDOW = 5
#: Shares are compared as 100 * part > percent * whole, in whole numbers.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOLS_PER_100_WORDS = 20
MAX_DUP_LINE_PERCENT = 50
MAX_SHOUT_PERCENT = 60
MAX_CHARS_PER_WORD = 40

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shout_words")
MEASURE_TYPE = "struct<" + ", ".join(f"{m}:bigint" for m in MEASURES) + ">"

SYMBOLS = re.compile(r"[#*$%&|<>]+")


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text (NULL: empty), in the order of ``MEASURES``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines, seen, dup = 0, set(), 0
    for line in raw.split(b"\n"):
        if line and line.split(None, 1):
            lines += 1
            dup += line in seen
            seen.add(line)
    joined = b" ".join(words).decode()
    chars = len(joined) - max(n - 1, 0)
    shout = sum(w.upper() == w != w.lower() for w in joined.split(" "))
    return n, chars, sum(map(len, SYMBOLS.findall(text))), dup, repeated_words(words), lines, shout


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found at least twice."""
    grams = list(zip(*(words[i:] for i in range(window))))
    first: dict[tuple, int] = dict.fromkeys(grams, 0)
    if len(first) == len(grams):
        return 0
    for g in grams:
        first[g] += 1
    covered, upto = 0, 0
    for i, g in enumerate(grams):
        if first[g] > 1:
            covered += i + window - max(i, upto)
            upto = i + window
    return covered


@dataclass(frozen=True)
class Rule:
    """A named test on the measurements; its place in ``RULES`` is its bit."""

    name: str
    fails: str


RULES = (
    Rule("too_few_words", f"n_words < {MIN_WORDS}"),
    Rule("repeated_words", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("symbols", f"100 * n_symbols > {MAX_SYMBOLS_PER_100_WORDS} * n_words"),
    Rule("duplicate_lines", f"100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines"),
    Rule("shouting", f"100 * n_shout_words > {MAX_SHOUT_PERCENT} * n_words"),
    Rule("long_words", f"word_chars > {MAX_CHARS_PER_WORD} * n_words"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


#: Versions of the policy: the rules each enforces.
POLICIES = {
    "base": mask("too_few_words", "repeated_words"),
    "v1": mask("too_few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": mask(*BIT),
}
CURRENT = "v2"


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed`` (one bit per failed rule) of every row of ``docs``.

    NULL and empty texts measure zero and fail ``too_few_words``; a NULL doc_id, repeated rows
    and other columns are carried as they are; an empty table gives an empty ledger.
    """
    @F.pandas_udf(MEASURE_TYPE)
    def measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")

    rows = docs.select("doc_id", measures(F.col("text")).alias("m")).select("doc_id", "m.*")
    bits = [F.when(F.expr(r.fails), F.lit(BIT[r.name])).otherwise(0) for r in RULES]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return rows.withColumn("failed", failed.cast("long"))


def apply_policy(rows: DataFrame, version: str = CURRENT, name: str = "kept") -> DataFrame:
    """The ledger with the verdict of a policy."""
    return rows.withColumn(name, F.col("failed").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablations(rows: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """For every policy and enforced rule: documents, those the policy rejects, those that fail
    the rule, and those that fail it alone (kept if the rule were dropped)."""
    policies = POLICIES if policies is None else policies
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(r).alias("rule"),
                      F.lit(b).cast("long").alias("bit"))
             for v, m in policies.items() for r, b in BIT.items() if m & b]
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    n = F.col("n")
    return (patterns.select("failed", "n", F.explode(F.array(*cases)).alias("c")).select("failed", "n", "c.*")
            .groupBy("policy", "rule").agg(
                F.sum(n).alias("n_docs"),
                F.sum(F.when(hit != 0, n).otherwise(0)).alias("n_rejected"),
                F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, n).otherwise(0)).alias("n_failed"),
                F.sum(F.when(hit == F.col("bit"), n).otherwise(0)).alias("n_only")))


def with_ablation(rows: DataFrame, version: str = CURRENT, name: str = "kept_without") -> DataFrame:
    """The ledger with the number of documents that a policy would keep without the rules that the
    row's document fails (for a document that fails none: those it keeps).

    Counts per bit pattern are combined map side; there are at most 2**rules patterns, which are
    compared with one another by bits and joined back by pattern.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    all_ = patterns.agg(F.collect_list(F.struct("failed", "n")).alias("all"))  # at most 2**rules entries
    left = F.bitwise_not("failed").bitwiseAND(F.lit(POLICIES[version]))
    kept = F.aggregate("all", F.lit(0).cast("long"), lambda a, p: a + F.when(
        p["failed"].bitwiseAND(left) == 0, p["n"]).otherwise(0))
    counted = patterns.crossJoin(F.broadcast(all_)).select("failed", kept.alias(name))
    return rows.join(F.broadcast(counted), "failed")


def profile(rows: DataFrame, *by: str) -> DataFrame:
    """Per group: the bits that some document fails (OR) and that all fail (AND)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"), F.bit_or("failed").alias("any_failed"),
                                 F.bit_and("failed").alias("all_failed"))

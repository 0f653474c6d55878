"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document; the ledger row holds the
measurements and one failure bit a rule.  Policies are versioned masks over
those bits: a document is kept if no bit of the mask is set.  What a policy
would do without one of its rules is a bitwise aggregation over the ledger,
without reading a text again.

Only built-in column expressions are used.  Repeated word windows are found
inside the row: 64-bit hashes of all windows, a distinct count that lets most
texts go, and for the others a sort of (hash, position) whose equal
neighbours are the repeated windows.  Nothing is shuffled.

Cases: a null or empty text has zero words and fails the word count rule
only; a text of fewer words than a window has no repeated window; repeated
rows are judged one by one; other columns may be kept under their names; an
empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.names import check_free

WINDOW = 8
BREAKS = "[\\x20\\x09-\\x0D]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: bit -> (name, condition of failure over the measurements); bits are never reused.
RULES = {
    0: ("few_words", "n_words < 20"),
    1: ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    2: ("symbols", "n_symbols * 12 > word_chars"),
    3: ("duplicate_lines", "n_dup_lines * 2 > n_lines and n_dup_lines >= 3"),
    4: ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 16 * n_words)"),
}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    bits: tuple[int, ...]

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)


BASE = Policy("base", 1, (0, 1))
POLICIES = (BASE, Policy("web", 1, (0, 1, 2)), Policy("web", 2, (0, 1, 2, 3, 4)))
CURRENT = POLICIES[-1]


def measured(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """``keep`` and the measurements of every text."""
    check_free(keep, [*MEASURES, "failed_bits"])

    def names(*more: str) -> list:
        return [F.col(f"kept.{c}").alias(c) for c in keep] if more == ("out",) else ["kept", *more]

    t = docs.select(F.struct(*keep).alias("kept"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # each step is its own projection, so that no array is computed twice
    w = t.select("kept", "t", F.array_remove(F.split("t", BREAKS), "").alias("w"))
    w = w.select(
        *names("w"), F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.expr("filter(split(t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
        F.expr("transform(w, x -> xxhash64(x))").alias("wh"))
    w = w.select(
        *names("n_words", "word_chars", "n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"case when size(wh) < {window} then cast(array() as array<bigint>) else "
               f"transform(sequence(1, size(wh) - {window - 1}), i -> xxhash64(slice(wh, i, {window}))) end"
               ).alias("h"))
    plain = names("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    w = w.select(*plain, F.expr(
        "case when size(array_distinct(h)) = size(h) then cast(array() as array<struct<x: bigint, i: int>>) "
        "else array_sort(transform(h, (x, i) -> struct(x as x, i as i))) end").alias("s"))
    w = w.select(*plain, F.expr(
        "array_sort(transform(filter(s, (e, j) -> (j > 0 and s[j - 1].x = e.x) or "
        "(j + 1 < size(s) and s[j + 1].x = e.x)), e -> e.i))").alias("p"))
    w = w.select(*plain, F.expr(
        f"aggregate(transform(p, (i, j) -> cast(case when j + 1 < size(p) then least({window}, p[j + 1] - i) "
        f"else {window} end as bigint)), 0L, (a, b) -> a + b)").alias("n_repeat_words"))
    return w.select(*names("out"), *MEASURES)


def ledger(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """``keep``, the measurements and ``failed_bits`` (bit k set: rule k failed)."""
    bits = F.lit(0).cast("long")
    for bit, (_, condition) in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, keep, text, window).withColumn("failed_bits", bits)


def failed(policy: Policy, bits: str = "failed_bits"):
    """Whether the policy rejects the row."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) != 0


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES, bits: str = "failed_bits") -> DataFrame:
    """(policy, version, rule, rejected, failed, only, kept_without) for each rule of each policy.

    rejected: by the whole policy; failed: by this rule; only: by this rule and no other of the
    policy, which is what the policy would keep more without it; kept_without: kept then."""
    n = F.count("*").alias("n")
    by_bits = rows.groupBy(F.col(bits).alias("b")).agg(n)         # at most one row a bit pattern
    parts = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                      F.lit(RULES[k][0]).alias("rule"), F.lit(p.mask).cast("long").alias("mask"),
                      F.lit(1 << k).cast("long").alias("bit")) for p in policies for k in p.bits]
    each = by_bits.select("b", "n", F.explode(F.array(*parts)).alias("r")).select("b", "n", "r.*")
    inside = F.col("b").bitwiseAND(F.col("mask"))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0)))
    return each.groupBy("policy", "version", "rule").agg(
        count(inside != 0).alias("rejected"), count(F.col("b").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(inside == F.col("bit")).alias("only"),
        count((inside == 0) | (inside == F.col("bit"))).alias("kept_without"))

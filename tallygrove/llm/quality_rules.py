"""Quality rules: a ledger of failure bits and measurements, and policies applied to it.

Every rule is evaluated once per document.  The ledger keeps one bit per failed
rule beside the measurements; policies are masks over these bits, so a new
version of a policy, or the question what a rule alone removes, needs no text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import SPACE, WORD, let, text_of

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_lone_marks")


class Rule(NamedTuple):
    """``bit`` never changes its meaning; ``fails`` is SQL over the measurements."""

    bit: int
    name: str
    fails: str


RULES: tuple[Rule, ...] = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "n_symbols > n_words"),
    Rule(3, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(4, "repeated_lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule(5, "few_letters", "10 * n_letters < 6 * word_chars"),
    Rule(6, "capitals", "2 * n_upper > n_letters"),
    Rule(7, "lone_marks", "4 * n_lone_marks > n_words"),
)


class Policy(NamedTuple):
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        return sum(1 << r.bit for r in rules if r.name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))
POLICIES = (BASE, STANDARD)


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _covered(starts: Column, width: int) -> Column:
    """Places covered by windows of ``width`` at the ascending ``starts``."""
    gaps = F.transform(
        starts, lambda s, i: F.least(F.coalesce(F.get(starts, i + 1) - s, F.lit(width)), F.lit(width))
    )
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def _repeated(words: Column, width: int) -> Column:
    """Words in windows of ``width`` words that occur twice or more in the array."""
    last = F.size(words) - width

    def count(grams: Column) -> Column:
        placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(order: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                before, after = F.get(order, k - 1)["g"], F.get(order, k + 1)["g"]
                return F.coalesce(x["g"] == before, F.lit(False)) | F.coalesce(x["g"] == after, F.lit(False))

            return F.array_sort(F.transform(F.filter(order, twice), lambda x: x["i"]))

        heavy = let(let(placed, starts), lambda s: _covered(s, width))
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), heavy).otherwise(0)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    grams = let(
        hashed,
        lambda h: F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(h, i, width))),
    )
    return F.when(last >= 0, let(grams, count)).otherwise(0)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of every document, all ``bigint``.  Null text counts as empty.

    Repeated windows are found by 64-bit hashes of their word hashes.
    """
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias(id_col), text.alias("__text"))
    t = F.col("__text")
    words = F.regexp_extract_all(t, F.lit(f"({WORD})"), 1)
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(WORD))
    letters = F.regexp_replace(t, r"\P{L}+", "")
    lone = F.regexp_replace(F.concat(F.lit(" "), F.regexp_replace(t, SPACE, "  "), F.lit(" ")), r" [|#*$%&<>=~_-]+ ", "\x01")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n_words"), _repeated(w, WINDOW).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))

    def of_letters(x: Column) -> Column:
        return F.struct(F.length(x).alias("n_letters"), _length_without(x, r"\p{Lu}+").alias("n_upper"))

    found = rows.select(
        id_col,
        let(words, of_words).alias("__w"),
        let(lines, of_lines).alias("__l"),
        let(letters, of_letters).alias("__a"),
        F.length(F.regexp_replace(t, SPACE, "")).alias("__word_chars"),
        _length_without(t, r"[#*$%&|<>]+").alias("__symbols"),
        _length_without(F.regexp_replace(lone, "[^\x01]+", ""), "\x01+").alias("__lone"),
    )
    values = {
        "n_words": F.col("__w.n_words"), "word_chars": F.col("__word_chars"),
        "n_symbols": F.col("__symbols"), "n_dup_lines": F.col("__l.n_dup_lines"),
        "n_repeat_words": F.col("__w.n_repeat_words"), "n_lines": F.col("__l.n_lines"),
        "n_letters": F.col("__a.n_letters"), "n_upper": F.col("__a.n_upper"),
        "n_lone_marks": F.col("__lone"),
    }
    return found.select(id_col, *(values[m].cast("bigint").alias(m) for m in MEASURES))


def ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Measurements and ``failed_bits`` of every document: bit r is set if rule r fails.

    An empty or null text fails ``few_words``.  Rows equal to others are
    measured like any other.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0) for r in rules]
    all_bits = reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0)).cast("bigint")
    return measure(docs, id_col, text_col).withColumn("failed_bits", all_bits)


def fails(policy: Policy, bits: str = "failed_bits", rules: Sequence[Rule] = RULES) -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules))) != 0


def apply_policies(
    entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with one boolean ``kept_<name>_v<version>`` per policy."""
    kept = {f"kept_{p.name}_v{p.version}": ~fails(p, rules=rules) for p in policies}
    return entries.withColumns(kept)


def ablations(
    entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per policy and rule: documents that fail it, that fail only it, and kept without it.

    The ledger shrinks to a row per distinct set of bits before policies and
    rules meet it, so the text is read once for all of them.
    """
    sets = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = [
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
            F.lit(r.name).alias("rule"), F.lit(p.mask(rules)).cast("bigint").alias("mask"),
            F.lit(1 << r.bit).cast("bigint").alias("bit"),
        )
        for p in policies for r in rules if r.name in p.rules
    ]
    each = sets.select("failed_bits", "n", F.inline(F.array(*cases)))
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    others = hit.bitwiseAND(F.bitwise_not("bit"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("policy", "version", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_only_this"),
        total(hit == 0).alias("n_kept"),
        total(others == 0).alias("n_kept_without"),
    )

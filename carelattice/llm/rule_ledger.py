"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and leaves one failure bit; the measurements stay beside the bits. A policy is a
versioned set of rules: applying one, or asking what a rule alone costs, is a bitwise test on the ledger and never touches
the text again. All of it is column expressions; the only shuffle is the aggregation of an ablation, by distinct masks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.small import free_prefix
from carelattice.llm.words import BLANKS, fold_sum, let, windows, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


@dataclass(frozen=True)
class Policy:
    """``rules`` are the names that reject; a document is kept when none of them has failed."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule]) -> int:
        known = {r.name: r.mask for r in rules}
        return reduce(lambda a, b: a | b, (known[name] for name in self.rules), 0)


def rules() -> list[Rule]:
    """All rules over the columns of ``measure``; a bit, once given, is never used for another rule."""
    n = F.col("n_words")
    return [
        Rule(0, "few_words", n < 20),
        Rule(1, "repeated_windows", 100 * F.col("n_repeat_words") > 30 * n),
        Rule(2, "symbols", 100 * F.col("n_symbols") > 20 * F.col("word_chars")),
        Rule(3, "repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
        Rule(4, "short_words", F.col("word_chars") < 2 * n),
        Rule(5, "long_words", F.col("word_chars") > 20 * n),
    ]


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = (
    BASE,
    Policy("v1", ("few_words", "repeated_windows", "symbols", "long_words")),
    Policy("v2", ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words")),
)
CURRENT = POLICIES[-1]


def repeated_words(hashes: Column) -> Column:
    """Words inside windows of eight that occur at least twice, the first occurrence included.

    Few texts repeat a window at all, which a distinct count tells; only those sort their windows by hash.
    """

    def starts(keyed: Column) -> Column:
        def same(s: Column, i: Column) -> Column:
            return F.coalesce(s["h"] == F.get(keyed, i)["h"], F.lit(False))

        marked = F.transform(keyed, lambda s, i: F.when(same(s, i - 1) | same(s, i + 1), s["p"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    def covered(at: Column) -> Column:
        return fold_sum(F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))).cast("long")))

    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    counted = let(let(keyed, starts), covered)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), counted).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    Whole texts are measured; a null text counts as empty, every measure is then 0. Columns of these names are replaced, all others may have any name.
    """
    p = free_prefix(docs.columns)
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    found = {
        "n_words": F.size(p + "words"),
        "word_chars": F.length(F.array_join(p + "words", "")),
        "n_symbols": F.size(F.split(whole, "[#*$%&|<>]", -1)) - 1,
        "n_lines": F.size(p + "lines"),
        "n_dup_lines": F.size(p + "lines") - F.size(F.array_distinct(p + "lines")),
        "n_repeat_words": repeated_words(F.col(p + "windows")),
    }
    # out of an explode of one element, which no filter on a measure is pushed through: each is computed once
    once = F.explode(F.array(F.struct(*[value.cast("long").alias(name) for name, value in found.items()])))
    return (
        docs.drop(*found)
        .withColumns({p + "words": words(F.col(text)), p + "lines": lines})
        .withColumn(p + "hashes", F.transform(p + "words", lambda w: F.xxhash64(w)))
        .withColumn(p + "windows", windows(F.col(p + "hashes"), WINDOW))
        .withColumn(p + "found", once)
        .withColumns({name: F.col(f"{p}found.{name}") for name in found})
        .drop(p + "words", p + "lines", p + "hashes", p + "windows", p + "found")
    )


def ledger(docs: DataFrame, text: str = "text", checks: list[Rule] | None = None) -> DataFrame:
    """``docs`` with its measurements and ``failed_bits``: bit b is set when rule b has failed. A column failed_bits is replaced."""
    checks = rules() if checks is None else checks
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(r.fails, F.lit(r.mask)).otherwise(F.lit(0)) for r in checks))
    return measure(docs, text).withColumn("failed_bits", bits.cast("long"))


def passes(policy: Policy, checks: list[Rule] | None = None) -> Column:
    """Whether a ledger row passes ``policy``."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask(rules() if checks is None else checks))) == 0


def ablation(book: DataFrame, policy: Policy, checks: list[Rule] | None = None) -> DataFrame:
    """Per rule of ``policy``: documents it rejects, and those only it rejects (kept when the rule is left out).

    The ledger is first counted by distinct mask, at most 2 to the number of rules rows.
    """
    checks = rules() if checks is None else checks
    chosen = [r for r in checks if r.name in policy.rules]
    all_of = policy.mask(checks)
    masks = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(all_of)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r.bit).alias("bit"), F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask")) for r in chosen]))
    rows = masks.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    return (
        rows.groupBy("bit", "rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("mask")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(F.col("bits") == F.col("mask"), F.col("n")).otherwise(0)).alias("rejected_alone"),
        )
        .withColumn("policy", F.lit(policy.version))
    )


def keep_passing(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    return ledger(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))).where(passes(policy)).select("row.*")

"""Quality rules as a bitmask ledger, in built-in column expressions only.

Every rule is evaluated once per text.  The ledger keeps the measurements and
one failure bit per rule, so a policy is only a bit mask: applying another
policy version, or asking what each rule alone rejects, never reads the texts
again.

Defined cases: a null text measures like an empty one (all zeros) and fails
``few_words``; repeated rows are measured one by one; an empty table gives an
empty ledger; extra columns of any name pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_CHARS, col, fresh, let

SPACE_RUN = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaim", "n_lines", "n_dup_lines", "n_repeat_words")

# Rule name -> predicate over the measures; the position is the bit.  Only
# append: stored ledgers keep the meaning of their bits.
RULES: list[tuple[str, Callable[[Column], Column]]] = [
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("short_words", lambda m: m["word_chars"] < 3 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 12 * m["n_words"]),
    ("symbols", lambda m: 100 * m["n_symbols"] > 30 * m["n_words"]),
    ("exclaiming", lambda m: 100 * m["n_exclaim"] > 50 * m["n_words"]),
    ("repeated_lines", lambda m: (m["n_lines"] >= 4) & (100 * m["n_dup_lines"] > 50 * m["n_lines"])),
]
BASE_RULES = ("few_words", "repeated_words")
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE_RULES,
    "v2": tuple(name for name, _ in RULES),
}
CURRENT_POLICY = "v2"


def rule_mask(names) -> int:
    bit = {name: i for i, (name, _) in enumerate(RULES)}
    return reduce(lambda m, n: m | 1 << bit[n], names, 0)


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more.

    Windows are compared by 64-bit hash, sorted with their positions, so equal
    ones are neighbours; texts without two equal windows skip the sort.
    """
    windows = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def covered(s: Column) -> Column:
        same = lambda x, j: x["h"].eqNullSafe(F.get(s, j - 1)["h"]) | x["h"].eqNullSafe(F.get(s, j + 1)["h"])
        starts = F.transform(F.filter(s, same), lambda x: x["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    return let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)).otherwise(0))


def measures(text: Column) -> Column:
    """Struct of :data:`MEASURES` for a text column."""
    def measure(t: Column) -> Column:
        trimmed = F.btrim(t, F.lit(SPACE_CHARS))
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
        return let(words, lambda w: let(lines, lambda ls: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.translate(t, SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.length(t) - F.length(F.translate(t, "!", ""))).cast("bigint").alias("n_exclaim"),
            F.size(ls).cast("bigint").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"))))
    return let(F.coalesce(text.cast("string"), F.lit("")), measure)


def ledger(df: DataFrame, text_col: str = "text", out: str = "ledger") -> DataFrame:
    """``df`` plus one struct column ``out``: the measures and ``failed_bits``."""
    led = let(measures(col(text_col)), lambda m: F.struct(
        *[m[c].alias(c) for c in MEASURES], failure_bits(m).alias("failed_bits")))
    return df.withColumn(out, led)


def failure_bits(m: Column) -> Column:
    """One bit per failed rule of :data:`RULES`, from a struct of measures."""
    bits = [F.when(rule(m), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, (_, rule) in enumerate(RULES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def passes(bits: Column, policy: str = CURRENT_POLICY) -> Column:
    """True where no rule of the policy version failed."""
    return bits.bitwiseAND(F.lit(rule_mask(POLICIES[policy])).cast("bigint")) == 0


def only_rule(bits: Column, policy: str = CURRENT_POLICY) -> Column:
    """Name of the rule that alone rejects a text under the policy; null for texts it keeps or rejects twice."""
    b = bits.bitwiseAND(F.lit(rule_mask(POLICIES[policy])).cast("bigint"))
    return F.coalesce(*[F.when(b == rule_mask([n]), F.lit(n)) for n in POLICIES[policy]])


def ablation(led: DataFrame, policy: str = CURRENT_POLICY, bits: str = "ledger.failed_bits") -> DataFrame:
    """Per rule of a policy: texts that fail it, and texts that it alone rejects.

    One pass over the stored bits, pre-aggregated before its single-row exchange.
    """
    mask = rule_mask(POLICIES[policy])
    b = F.col(bits).bitwiseAND(F.lit(mask).cast("bigint"))
    one = {n: F.lit(rule_mask([n])).cast("bigint") for n in POLICIES[policy]}
    tally = led.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_or(b), F.lit(0)).alias("any_bits"),
        *[F.count(F.when(b.bitwiseAND(v) != 0, 1)).alias(f"fail_{n}") for n, v in one.items()],
        *[F.count(F.when(b == v, 1)).alias(f"only_{n}") for n, v in one.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"fail_{n}").alias("n_failed"),
                              F.col(f"only_{n}").alias("n_only")) for n in one])
    return tally.select(F.lit(policy).alias("policy"), "n", "any_bits", F.explode(rows).alias("r")) \
        .select("policy", "n", "any_bits", "r.*")


def filter_quality(df: DataFrame, text_col: str = "text", policy: str = CURRENT_POLICY) -> DataFrame:
    """Rows whose text passes the policy, with their own columns."""
    out = fresh(df.columns, "quality_ledger")
    led = ledger(df, text_col, out)
    return led.where(passes(col(out)["failed_bits"], policy)).select(*[col(c) for c in df.columns])

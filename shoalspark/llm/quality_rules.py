"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule; policies are
versioned masks over those bits, and ablations are sums over the distinct masks, so no text is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, words

#: Rule name -> (bit, condition of failure over the measurements). Bits are never reused.
RULES: dict[str, tuple[int, str]] = {
    "too_few_words": (0, "n_words < 50"),
    "repeated_words": (1, "100 * n_repeat_words > 50 * n_words"),
    "symbols": (2, "10 * n_symbols > word_chars"),
    "repeated_lines": (3, "n_dup_lines >= 4 and 10 * n_dup_lines > 5 * n_lines"),
    "short_words": (4, "n_words > 0 and word_chars < 2 * n_words"),
    "long_words": (5, "word_chars > 25 * n_words"),
    "no_text": (6, "n_words = 0"),
}

#: Rules that make base_failed.
BASE = ("too_few_words", "repeated_words")

#: Policy version -> rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "no_text"),
}

DEFAULT_POLICY = "v2"


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[r][0] for r in rules)


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more: the covered length of the sorted window starts."""
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, w[i + 1], w[i + 2]).alias("h"), i.alias("i")),
    )
    return F.sort_array(windows)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measurements (long) and fail_bits (long).

    Null and empty texts have no words: zero measurements and the bits too_few_words and no_text. Repeated rows each
    get their row; an empty table gives none. Only id_col and text_col are read, so further columns cannot clash.
    Windows are compared by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    one = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    two = one.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).alias("s"),
    )
    s = F.col("s")
    twice = F.filter(
        s,
        lambda e, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == e["h"]))
        | ((j + 1 < F.size(s)) & (s[F.least(j + 1, F.size(s) - 1)]["h"] == e["h"])),
    )
    three = two.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.sort_array(F.transform(twice, lambda e: e["i"])).alias("p"),
    )
    p = F.col("p")
    less = F.greatest(F.size(p) - 1, F.lit(0))
    gaps = F.zip_with(F.slice(p, 2, less), F.slice(p, 1, less), lambda a, b: F.least(a - b, F.lit(3)))
    four = three.withColumn(
        "n_repeat_words",
        F.when(F.size(p) == 0, 0).otherwise(F.aggregate(gaps, F.lit(3), lambda acc, x: acc + x)).cast("long"),
    ).drop("p")
    bits = F.lit(0).cast("long")
    for bit, failed in RULES.values():
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return four.withColumn("fail_bits", bits)


def rejects(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def verdicts(led: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with base_failed and kept under a policy version; kept is never true where base_failed is."""
    base = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE)).cast("long")) != 0
    return led.withColumn("base_failed", base).withColumn("kept", ~base & ~rejects(F.col("fail_bits"), policy))


def ablations(led: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of a policy: documents it fails, documents only it rejects, and documents kept without it.

    The ledger is first counted by distinct mask (at most 2 to the number of rules rows), so ablations cost nothing more.
    """
    full = mask(POLICIES[policy])
    counted = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    each = counted.select("fail_bits", "n", rules.alias("r")).select("fail_bits", "n", "r.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    others = F.col("fail_bits").bitwiseAND(F.lit(full).cast("long").bitwiseXOR(F.col("bit"))) != 0
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(total(hit)("n_failed"), total(hit & ~others)("n_only"), total(~others)("n_kept_without"))


def keep_good(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The rows of docs that the policy keeps, with their columns as they are."""
    one = docs.select(F.struct("*").alias("doc_id"), F.col("text").alias("text"))
    # A filter is pushed through projections by repeating their expressions, which here would nest without bound; it
    # stays above one that is not deterministic, as the partition's number is to the optimizer.
    judged = verdicts(ledger(one), policy).select("doc_id", "kept", F.spark_partition_id().alias("part"))
    return judged.where(F.col("kept") & (F.col("part") >= 0)).select("doc_id.*")

"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and one long, `failed_bits`, with bit i set
where rule i fails. Policies are versioned sets of rules and are applied to the ledger afterwards, without the texts;
ablations count documents per bit pattern, of which there are few, and work on those counts.

Defined results: NULL text has no words and is measured as empty; an empty table gives an empty ledger; repeated rows are
measured each on their own; other columns pass through unless they have the name of a ledger column, which is replaced.
Very long texts are measured whole, in one row, in time about linear in their words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import computed_once, whole_text, words_of

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate over the measurements: true where a document fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """Reject if a `hard` rule fails, or at least `soft_limit` of the `soft` ones."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    soft_limit: int = 2


#: The order is the bit order: append only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("some_repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("some_repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("some_symbols", "10 * n_symbols > n_words"),
)
BASE = Policy("base", hard=("few_words", "repeated_words"))
PRODUCTION = Policy(
    "production_1",
    hard=(*BASE.hard, "symbols", "repeated_lines"),
    soft=("short_words", "long_words", "some_repeated_words", "some_repeated_lines", "some_symbols"),
    soft_limit=3,
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements, inside one row and without a shuffle.

    A window of words is one hash of eight word hashes. Only a text with equal windows pays for sorting them; the words
    that such windows cover follow from the distances between their starts.
    """
    n, h, w, p, s = (F.col(c) for c in ("_n", "_hashes", "_windows", "_sorted", "_starts"))
    same = lambda a, b: F.coalesce(F.get(p, a)["h"] == F.get(p, b)["h"], F.lit(False))
    window = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
    covered = lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))
    return (
        docs.drop(*(c for c in MEASURES if c != text))
        .withColumn("_text", whole_text(text))
        .withColumn("_words", words_of(F.col("_text")))
        .withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("_n", F.size("_words"))
        .withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x)))
        .withColumn("_windows", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)))
        .withColumn("_again", F.coalesce(F.size(w) > F.size(F.array_distinct(w)), F.lit(False)))
        .withColumn("_sorted", F.when(F.col("_again"), F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
        .withColumn("_starts", F.sort_array(F.transform(F.filter(p, lambda x, k: same(k, k - 1) | same(k, k + 1)), lambda x: x["i"])))
        .withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.size(F.split("_text", SYMBOLS, -1)) - 1).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn(
            "n_repeat_words",
            computed_once(F.coalesce(F.aggregate(F.transform(s, covered), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")),
        )
        .drop("_text", "_words", "_lines", "_n", "_hashes", "_windows", "_again", "_sorted", "_starts")
    )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs with the measurements and `failed_bits`."""
    if len(rules) > 63:
        raise ValueError("a ledger has 63 bits")
    measured = measure(docs, text)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    return measured.withColumn("failed_bits", reduce(Column.bitwiseOR, bits))


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    place = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << place[n] for n in names)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES, bits: str = "failed_bits", without: int = 0) -> Column:
    """Whether a row of the ledger passes the policy; `without` masks out rules, for ablations."""
    failed = F.col(bits).bitwiseAND(F.lit(~without))
    soft = F.bit_count(failed.bitwiseAND(F.lit(mask(policy.soft, rules))))
    return (failed.bitwiseAND(F.lit(mask(policy.hard, rules))) == 0) & (soft < policy.soft_limit)


def apply_policies(entries: DataFrame, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A ledger with one column `kept_<version>` per policy."""
    return entries.select("*", *[passes(p, rules).alias(f"kept_{p.version}") for p in policies])


def ablation(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that the policy rejects, and that it would keep without this rule.

    The ledger is first reduced to its distinct bit patterns within the policy's mask (map-side, at most 2^rules).
    """
    used = (*policy.hard, *policy.soft)
    patterns = (
        entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask(used, rules))).alias("failed_bits")).agg(F.count("*").alias("n"))
    )
    n = F.col("n")
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            F.sum(F.when(F.col("failed_bits").bitwiseAND(F.lit(mask((name,), rules))) != 0, n)).alias("n_failed"),
            F.sum(F.when(~passes(policy, rules), n)).alias("n_rejected"),
            F.sum(F.when(~passes(policy, rules) & passes(policy, rules, without=mask((name,), rules)), n)).alias("n_rejected_by_it_alone"),
        )
        for name in used
    ]
    return patterns.agg(F.array(*per_rule).alias("r")).select(F.explode("r").alias("r")).select(
        "r.rule", *[F.coalesce(f"r.{c}", F.lit(0)).cast("long").alias(c) for c in ("n_failed", "n_rejected", "n_rejected_by_it_alone")]
    )


def filter_documents(docs: DataFrame, policy: Policy = PRODUCTION, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns only."""
    clashes = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c in (*MEASURES, "failed_bits")}
    kept = ledger(docs.withColumnsRenamed(clashes), rules, clashes.get(text, text)).filter(passes(policy, rules))
    return kept.drop(*MEASURES, "failed_bits").withColumnsRenamed({v: k for k, v in clashes.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])

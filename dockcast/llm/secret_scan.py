"""Secret scan: fixed patterns, and character Markov models for random strings that no pattern names.

Two first-order models over one alphabet, of random strings and of ordinary identifiers, are trained from labelled
samples; a long token is a secret if its log-likelihood ratio is high. A model is a table of character pairs, at most
(alphabet + 1)^2 rows whatever the input, so it can be a constant in the plan.

Defined results: NULL text is empty; texts without a candidate have no spans; equal values at several places are
several spans; without samples of a label its model is uniform; an empty table gives no rows; other columns pass through
unless they have the name of a result column, which is replaced.
Very long texts are scanned whole; the time grows with the square of the spans in one text.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import computed_once, matches, whole_text, words_of

# The three patterns, and the least length of what each must find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: In the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIDE = len(ALPHABET) + 1  # place 0 is the start of a token, and any other character
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Documents that the models are trained on, about; they are chosen by a hash of their id.
SAMPLE_DOCS = 8000
#: Pairs that a model's single-character shares count for, after a character that was seldom or never met.
PRIOR = 8.0
#: Least log-likelihood ratio in nats, in all and per character.
LEAST_RATIO, LEAST_PER_CHAR = 8.0, 0.4

SPAN = "array<struct<start:int,order:int,end:int,found:string>>"


def _spans(found: Column, order: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"], F.lit(order).alias("order"), m["end"], m["found"]))


def base_spans(text: Column) -> Column:
    """The spans of the three patterns, by start; cheap searches keep most texts away from the patterns.

    A run of one class that is long enough is the leftmost longest match, so a length in the pattern does for two kinds.
    An assignment whose value is too short still uses up its characters, so there the length is checked afterwards.
    """
    none = F.array().cast(SPAN)
    stem = text.rlike(r"(?i)[psta](?:assw|ecret|oken|pi_?key)")
    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= ASSIGN_LEAST)
    access = matches(text, rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
    hexes = matches(text, rf"[0-9a-f]{{{HEX_LEAST},}}")
    return F.array_sort(
        F.concat(
            F.when(stem & text.rlike(ASSIGN), _spans(assign, 0)).otherwise(none),
            F.when(text.contains("AKIA"), _spans(access, 1)).otherwise(none),
            F.when(text.rlike(rf"[0-9a-f]{{{HEX_LEAST}}}"), _spans(hexes, 2)).otherwise(none),
        )
    )


def _pairs(token: Column) -> Column:
    """The places of a token's character pairs in a table of SIDE x SIDE, the start of the token as first character."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.transform(places, lambda p, i: F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1)) * SIDE + p)


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, text: str = "text") -> DataFrame:
    """Samples (token, random) from about `sample_docs` documents: values that the patterns find, and all other words of 8+ characters."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = docs.filter(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) < int(share * 1_000_000)).select(whole_text(text).alias("_text"))
    value = lambda s: F.regexp_extract(s["found"], r"([A-Za-z0-9+/_=-]+)[.]*$", 1)
    secrets = chosen.select(F.explode(F.transform(base_spans(F.col("_text")), value)).alias("token"))
    words = chosen.select(F.explode(words_of(F.col("_text"))).alias("token")).filter(F.col("token").rlike("^[A-Za-z0-9+/_-]{8,}$"))
    words = words.filter(~F.col("token").rlike(rf"[0-9a-f]{{{HEX_LEAST}}}|{ACCESS}")).join(secrets.distinct(), "token", "left_anti")
    return secrets.withColumn("random", F.lit(True)).unionByName(words.withColumn("random", F.lit(False))).filter("token <> ''")


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of every character pair, row by row, from samples (token, random).

    Each model's pairs are smoothed towards its single characters, and those towards equal shares.
    """
    counted = samples.select("random", F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("random", "pair").count()
    counts = {True: [0] * SIDE**2, False: [0] * SIDE**2}
    for row in counted.collect():  # at most 2 * SIDE^2 rows
        counts[row["random"]][row["pair"]] = row["count"]
    logs = {}
    for kind, pairs in counts.items():
        single = [(sum(pairs[second::SIDE]) + 1) / (sum(pairs) + SIDE) for second in range(SIDE)]
        before = [sum(pairs[first * SIDE : (first + 1) * SIDE]) for first in range(SIDE)]
        logs[kind] = [math.log((n + PRIOR * single[i % SIDE]) / (before[i // SIDE] + PRIOR)) for i, n in enumerate(pairs)]
    return [a - b for a, b in zip(logs[True], logs[False], strict=True)]


def score(token: Column, ratio: list[float]) -> Column:
    """The log-likelihood ratio of a token, random against ordinary."""
    table = F.from_json(F.lit(json.dumps(ratio)), "array<double>")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda s, p: s + F.get(table, p))


def scan(docs: DataFrame, ratio: list[float], text: str = "text") -> DataFrame:
    """docs with `base` and `spans`: arrays of (start, order, end, found) by start, then kind; code points, end exclusive.

    A candidate of the models that overlaps a base span is left to that span.
    """
    body = F.col("_text")
    found = F.filter(
        matches(body, CANDIDATE),
        lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        & (score(m["found"], ratio) >= F.greatest(F.lit(LEAST_RATIO), LEAST_PER_CHAR * F.length(m["found"]))),
    )
    added = F.when(body.rlike(CANDIDATE), _spans(found, 3)).otherwise(F.array().cast(SPAN))
    return (
        docs.drop(*(c for c in ("base", "spans") if c != text))
        .withColumn("_text", whole_text(text))
        .withColumn("base", computed_once(base_spans(body)))
        .withColumn("_added", added)
        .withColumn("spans", computed_once(F.array_sort(F.concat("base", "_added"))))
        .drop("_text", "_added")
    )


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")

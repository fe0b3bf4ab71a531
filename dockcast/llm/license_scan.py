"""License scan by ordered signature rules.

A text is reduced to its words (A-Z lowered; digits, letters and everything beyond ASCII), laid out with two blanks
between words and one at either end, so that a rule is an ordinary regular expression over whole words and neighbouring
matches share nothing. Texts without a keyword never meet a rule: one search for the keywords gates the text, and a rule
runs only if its own keyword occurs.

Detections are word intervals. One that lies inside the interval of a detection with a better priority is suppressed;
between equal priorities the longer one wins, then the earlier rule. Base rules name the three plain phrases; they
report every place and their labels always stay.

Defined results: NULL or empty text has no words and no detection (score 0); equal detections of one rule at several
places all stay; an empty table gives no rows; repeated rows are scanned each on their own; other columns pass through
unless they have the name of a result column, which is replaced.
Very long texts are scanned whole; the time grows with the square of the matches in one text (README, "Choices and limits").
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import computed_once, count_between, let, lower_ascii, matches, whole_text

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULTS = ["n_words", "base_places", "detections", "labels", "score"]


@dataclass(frozen=True)
class Rule:
    """Words as regular expressions, a label, the keyword that must occur, and a priority (small is better)."""

    label: str
    words: tuple[str, ...]
    keyword: str
    priority: int
    confidence: float

    @property
    def pattern(self) -> str:
        return " " + "  ".join(self.words) + " "


# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# License names as they are written in prose, their identifiers and the versions in use.
NAMES = {
    "mit": (("mit",), "mit", ()),
    "apache": (("apache", "apache software"), "apache", ("1 0", "1 1", "2 0")),
    "gpl": (("gnu general public", "general public", "gnu gpl", "gpl"), "gpl", ("1 0", "2 0", "3 0")),
    "lgpl": (("gnu lesser general public", "lesser general public", "library general public", "lgpl"), "lgpl", ("2 0", "2 1", "3 0")),
    "agpl": (("gnu affero general public", "affero general public", "agpl"), "agpl", ("1 0", "3 0")),
    "fdl": (("gnu free documentation", "free documentation"), "gfdl", ("1 1", "1 2", "1 3")),
    "mpl": (("mozilla public", "mpl"), "mpl", ("1 0", "1 1", "2 0")),
    "epl": (("eclipse public", "epl"), "epl", ("1 0", "2 0")),
    "cddl": (("common development and distribution", "cddl"), "cddl", ("1 0", "1 1")),
    "cpl": (("common public",), "cpl", ("1 0",)),
    "eupl": (("european union public", "eupl"), "eupl", ("1 0", "1 1", "1 2")),
    "bsd": (("bsd", "berkeley software distribution"), "bsd", ("2 clause", "3 clause", "4 clause")),
    "isc": (("isc", "internet systems consortium"), "isc", ()),
    "zlib": (("zlib",), "zlib", ()),
    "boost": (("boost software", "boost"), "bsl", ("1 0",)),
    "artistic": (("artistic", "perl artistic"), "artistic", ("1 0", "2 0")),
    "unlicense": (("unlicense",), "unlicense", ()),
    "wtfpl": (("wtfpl",), "wtfpl", ()),
    "cc0": (("cc0", "creative commons zero"), "cc0", ("1 0",)),
    "cc-by": (("creative commons attribution",), "cc by", ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-sa": (("creative commons attribution sharealike", "creative commons attribution share alike"), "cc by sa", ("2 0", "3 0", "4 0")),
    "cc-by-nc": (("creative commons attribution noncommercial", "creative commons attribution non commercial"), "cc by nc", ("2 0", "3 0", "4 0")),
    "cc-by-nd": (("creative commons attribution noderivatives", "creative commons attribution noderivs", "creative commons attribution no derivatives"), "cc by nd", ("2 0", "3 0", "4 0")),
    "ofl": (("sil open font", "open font"), "ofl", ("1 0", "1 1")),
    "osl": (("open software",), "osl", ("1 0", "2 0", "3 0")),
    "afl": (("academic free",), "afl", ("2 0", "3 0")),
    "python": (("python software foundation", "psf"), "psf", ("2 0",)),
    "php": (("php",), "php", ("3 0", "3 01")),
    "openssl": (("openssl",), "openssl", ()),
    "postgresql": (("postgresql",), "postgresql", ()),
    "ms-pl": (("microsoft public", "ms public"), "ms pl", ()),
    "odbl": (("open database", "odbl"), "odbl", ("1 0",)),
    "proprietary": (("proprietary",), "licenseref proprietary", ()),
}
# Sentences that stand in license texts themselves.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("mit", "the software is provided as is without warranty of any kind", "warranty"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "redistribute"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("proprietary", "all rights reserved", "rights"),
    ("proprietary", "unauthorized copying of this file", "unauthorized"),
)


def signature_rules() -> list[Rule]:
    """The rules, best priority first: identifiers, license sentences, names with a version or clause before or after 'license', in a clause, alone."""
    lic, spdx = "licen[cs]e", ("spdx", "license", "identifier")
    rules = [Rule(label, tuple(text.split()), keyword, 1, 1.0) for label, text, keyword in SENTENCES]
    for label, (names, short, versions) in NAMES.items():
        ident = tuple(short.split())
        rules += [Rule(label, (*spdx, *ident, *v.split()), "spdx", 0, 1.0) for v in versions]
        rules += [Rule(label, (*spdx, *ident), "spdx", 2, 0.95)]
        for name in names:
            w = tuple(name.split())
            rules += [Rule(label, (*w, lic, "(?:version|v)", *v.split()), "license", 3, 0.95) for v in versions if "clause" not in v]
            rules += [Rule(label, (*w, *v.split(), lic), "license", 3, 0.95) for v in versions]
            rules += [Rule(label, (*w, lic, *v.split()), "license", 3, 0.95) for v in versions]
            rules += [
                Rule(label, ("licensed", "under", "the", *w), "licensed", 4, 0.9),
                Rule(label, ("under", "the", "terms", "of", "the", *w), "terms", 4, 0.9),
                Rule(label, (*w, lic), "license", 5, 0.8),
            ]
    return rules


def _keyword(place: Column) -> Column:
    return F.when(place == "licence", "license").otherwise(place)


def scan(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """docs with `n_words`, `base_places` and `detections` (arrays of word intervals), `labels` and `score`.

    Everything stays inside one row. The score is the best confidence among the surviving detections.
    """
    rules = signature_rules() if rules is None else rules
    keywords = sorted({r.keyword for r in rules})
    spelled = [*keywords, *(["licence"] if "license" in keywords else [])]
    base_words = [tuple(p.split()) for p, _ in BASE]
    stems = sorted({*spelled, *{w[-1] for w in base_words}})
    firsts = "".join(sorted({w[0] for w in stems}))
    gate = F.col("_text").rlike(f"(?i)[{firsts}](?:{'|'.join(w[1:] for w in stems)})") & F.col("_text").rlike("(?i)" + "|".join(stems))
    laid = lambda t: F.concat(F.lit(" "), F.regexp_replace(F.btrim(F.regexp_replace(t, NOT_WORD, " ")), " ", "  "), F.lit(" "))
    fields = [
        {"rule": i, "label": r.label, "pattern": r.pattern, "keyword": r.keyword, "priority": r.priority, "confidence": r.confidence}
        for i, r in enumerate(rules)
    ]
    table = F.from_json(F.lit(json.dumps(fields)), "array<struct<rule:int,label:string,pattern:string,keyword:string,priority:int,confidence:double>>")
    present = F.array_distinct(F.transform(F.regexp_extract_all("_laid", F.lit(f" ({'|'.join(spelled)})(?= )"), F.lit(1)), _keyword))

    def places(pattern: Column | str) -> Column:
        """Word intervals of a pattern: the blanks before a character place give the words before it."""
        by_char = matches(F.col("_laid"), pattern)
        counted = F.transform(
            by_char, lambda m: F.struct(m["start"], F.size(F.split(m["found"], "  ", -1)).alias("n_words"), F.substring("_laid", F.lit(1), m["start"]).alias("before"))
        )
        return F.transform(
            counted,
            lambda m: let(
                F.when(m["before"] == "", F.lit(0)).otherwise(F.size(F.split(m["before"], "  ", -1))),
                lambda first: F.struct(first.alias("first"), (first + m["n_words"] - 1).alias("last")),
            ),
        )

    def detect(rule: Column) -> Column:
        return F.transform(
            places(rule["pattern"]),
            lambda p: F.struct(
                p["first"], p["last"], rule["priority"].alias("priority"), (p["first"] - p["last"]).alias("shortness"),
                rule["rule"].alias("rule"), rule["label"].alias("label"), rule["confidence"].alias("confidence"),
            ),
        )

    def survivors(found: Column) -> Column:
        """Interval containment: found is sorted best first, so a detection falls to any earlier one that covers it."""
        rank = lambda d: F.struct(d["priority"], d["shortness"], d["rule"])
        return F.filter(
            found,
            lambda d: ~F.exists(found, lambda o: (rank(o) < rank(d)) & (o["first"] <= d["first"]) & (o["last"] >= d["last"])),
        )

    def base_places(phrase: str, label: str) -> Column:
        pattern = " " + "  ".join(phrase.split()) + " "
        return F.transform(places(pattern), lambda p: F.struct(p["first"], p["last"], F.lit(label).alias("label")))

    base = F.flatten(F.array(*[base_places(*b) for b in BASE]))
    open_ = F.col("_laid").isNotNull()
    none_base = F.array().cast("array<struct<first:int,last:int,label:string>>")
    none_found = F.array().cast("array<struct<first:int,last:int,priority:int,shortness:int,rule:int,label:string,confidence:double>>")
    all_labels = F.array_sort(
        F.array_distinct(F.concat(F.transform("base_places", lambda b: b["label"]), F.transform("detections", lambda d: d["label"])))
    )
    return (
        docs.drop(*(c for c in RESULTS if c != text))
        .withColumn("_text", whole_text(text))
        .withColumn("n_words", count_between(F.col("_text"), NOT_WORD))
        .withColumn("_laid", F.when(gate, laid(lower_ascii(F.col("_text")))))
        .withColumn("_active", F.when(open_, let(present, lambda p: F.filter(table, lambda r: F.array_contains(p, r["keyword"])))))
        .withColumn("base_places", computed_once(F.when(open_, base).otherwise(none_base)))
        .withColumn("_found", F.when(open_, F.flatten(F.transform("_active", detect))))
        .withColumn("detections", computed_once(F.when(open_, survivors(F.col("_found"))).otherwise(none_found)))
        .withColumn("labels", all_labels)
        .withColumn("score", F.greatest(F.lit(0.0), F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))))
        .drop("_text", "_laid", "_active", "_found")
    )

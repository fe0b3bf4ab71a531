"""Notices as projects write them."""

from dockcast.llm import license_scan

NOTICES = {
    "Creative Commons Attribution-ShareAlike License": "cc-by-sa",
    "Creative Commons Attribution-ShareAlike 4.0 License": "cc-by-sa",
    "Creative Commons Attribution Share Alike License": "cc-by-sa",
    "Creative Commons Attribution-NonCommercial License": "cc-by-nc",
    "Creative Commons Attribution-NoDerivatives License": "cc-by-nd",
    "Creative Commons Attribution-NoDerivs 3.0 License": "cc-by-nd",
    "BSD 3-Clause License": "bsd",
    "the BSD 2-clause license": "bsd",
    "Apache License 2.0": "apache",
}


def test_notices(spark):
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(NOTICES)), "doc_id long, text string")).collect()
    assert {r.text: (label in r.labels and len(r.detections) > 0) for r, label in zip(sorted(rows, key=lambda r: r.doc_id), NOTICES.values(), strict=True)} == dict.fromkeys(NOTICES, True)


def test_no_rule_twice():
    rules = [(r.label, r.pattern) for r in license_scan.signature_rules()]
    assert len(rules) == len(set(rules)) and not [p for _, p in rules if " ?" in p]

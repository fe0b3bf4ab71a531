"""Ranked search against scores of all documents; the pieces of the best-first search on their own."""

import math
import random
import re
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockcast.llm import queries, ranked_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(plain.LOWER) for t in TERM.findall(text or "")]


def expected(docs, items, top=50):
    """(item_id, rank, doc_id, score) over all documents."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (d, c), size in zip(held, n, strict=True):
            score = 0
            for t in set(terms(text)) & set(c):
                m = 50 + 50 * size * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, math.inf if d is None else d))
        out += [(item, i, None if d == math.inf else d, -s) for i, (s, d) in enumerate(sorted(scored)[:top], start=1)]
    return sorted(out, key=lambda r: r[:2])


def found(out):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in out.collect()), key=lambda r: r[:2])


def test_terms():
    text = pa.array(["Don't X-9_ÄÖü\u0085é\x00b", "", None, "a" * 20_000, " ... "])
    flat, counts = ranked_search.terms_of(text)
    assert flat.to_pylist() == ["don", "t", "x", "9", "ÄÖü\u0085é", "b", "a" * 20_000] and counts.tolist() == [6, 0, 0, 1, 0]
    flat, counts = ranked_search.terms_of(text.slice(3, 2))
    assert flat.to_pylist() == ["a" * 20_000] and counts.tolist() == [1, 0]


def test_range_maxima():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 20, 200)
    maxima = ranked_search.RangeMaxima(values, 150)
    lo = draw.integers(0, 199, 500)
    hi = np.minimum(200, lo + draw.integers(1, 150, 500))
    places = maxima.places(lo, hi)
    assert ((places >= lo) & (places < hi)).all()
    assert all(values[p] == values[a:b].max() for p, a, b in zip(places, lo, hi, strict=True))


@pytest.mark.parametrize("segment", [7, 64, 8192])
def test_search_equals_scoring_all(spark, monkeypatch, segment):
    """Common and rare terms, many ties and copies; segments far smaller than the table."""
    draw = random.Random(segment)
    word = lambda: f"w{int(draw.paretovariate(0.7)) % 400}"
    docs = [(i, " ".join(word() for _ in range(draw.choice((0, 1, 5, 30, 200))))) for i in range(300)]
    docs += [(1000 + i, "w1 w2 w3 rare") for i in range(120)] + [(500, docs[3][1])]
    items = [(i, " ".join(word() for _ in range(draw.randrange(1, 40)))) for i in range(20)] + [(50, "rare w1 w1"), (51, "unknown words"), (52, "")]
    for name in ("SEGMENT", "TOGETHER", "AT_ONCE"):
        monkeypatch.setattr(ranked_search, name, {"SEGMENT": segment, "TOGETHER": 3, "AT_ONCE": 2}[name])
    q = ranked_search.Queries.of([type("Row", (), {"item_id": a, "text": b}) for a, b in items])
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "text"])
    forward = list(ranked_search._forward(q.vocabulary)(iter([batch])))
    n_docs, n_terms = sum(map(len, forward)), sum(int(b.column(1).to_numpy().sum()) for b in forward)
    held = np.bincount(np.concatenate([b.column(2).flatten().to_numpy() for b in forward]), minlength=len(q.vocabulary))
    hits = pa.Table.from_batches(ranked_search._search(q, ranked_search.weights(held, n_docs), n_docs, n_terms, 50)(iter(forward)))
    got = sorted(zip(*(hits.column(c).to_pylist() for c in ("item", "score", "doc_id")), strict=True), key=lambda r: (r[0], -r[1], r[2]))
    want = [(i, s, d) for i, _, d, s in expected(docs, list(enumerate(t for _, t in items)))]
    assert got == want


def test_query(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(k, "text").collect()] for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert found(queries.op13_ranked_search(spark, SF)) == expected(docs, items)


def test_odd_rows_and_blocks(spark, monkeypatch):
    rows = [(1, None, 0), (2, "", 0), (None, "apple pie", 0), (None, "apple pie", 0), (7, "Apple pie", 0), (7, "apple", 0), (8, "!!", 0), (9, "x " * 50_000 + "apple", 0)]
    rows += [(100 + i, "filler words only", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("item", F.lit("c"))
    items = spark.createDataFrame([(1, "apple pie", "u"), (1, "apple pie", "u"), (2, None, "v"), (None, "APPLE", "w"), (3, "zzz", "w")], "item_id long, text string, rank string")
    want = expected([r[:2] for r in rows], [(1, "apple pie"), (2, ""), (3, "zzz")])
    got = [r for r in found(ranked_search.search(docs, items.filter("item_id IS NOT NULL")))]
    assert got == want
    monkeypatch.setattr(ranked_search, "QUERIES_AT_ONCE", 1)
    assert found(ranked_search.search(docs, items.filter("item_id IS NOT NULL"))) == want
    assert {r.item_id for r in ranked_search.search(docs, items).collect()} == {1, None}
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]

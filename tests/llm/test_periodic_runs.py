"""Runs against a plain search over all periods, the operator word by word and at once, and the query's digests."""

import hashlib
import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockcast.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def expected(words, times=4, least=6):
    """(start, length, smallest period) of all runs, by start, then period."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words])
    found = {}
    for q in range(1, len(w) // times + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]])
        change = np.diff(same)
        for a, b in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True):
            length = b - a + q
            if length >= max(least, times * q):
                found.setdefault((a, length), q)  # ascending q: the least period of a stretch comes first
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def streams(seed, n):
    draw = random.Random(seed)
    for _ in range(n):
        kind, size = draw.randrange(4), draw.randrange(70)
        if kind == 0:
            yield [draw.randrange(2) for _ in range(size)]
        elif kind == 1:
            yield [draw.randrange(3) for _ in range(size)]
        else:
            unit = [draw.randrange(3) for _ in range(draw.randrange(1, 9))]
            out = [draw.randrange(5) for _ in range(draw.randrange(6))] + unit * draw.randrange(1, 12) + unit[: draw.randrange(9)]
            if kind == 3:
                out[draw.randrange(len(out))] = 9
            yield out + [draw.randrange(3) for _ in range(draw.randrange(6))]


@pytest.mark.parametrize("times", [2, 3, 4])
def test_runs_equal_a_plain_search(times):
    for w in streams(times, 400):
        catchers = periodic_runs.Catchers(times)
        catchers.append(np.array(w, np.int64))
        got = [(a, b - a, q) for a, b, q in catchers.runs().tolist()]
        assert got == expected(w, times), w


def test_word_by_word_is_the_same_as_at_once():
    for w in streams(7, 40):
        one = periodic_runs.Catchers()
        for x in w:
            one.append(np.array([x]))
        assert [(a, b - a, q) for a, b, q in one.runs().tolist()] == expected(w), w
        parts = periodic_runs.Catchers()
        for at in range(0, len(w), 7):
            parts.append(np.array(w[at : at + 7]))
        assert parts.runs().tolist() == one.runs().tolist()


def test_long_texts():
    same, pair, nested = ["a"] * 100_000, ["a", "b"] * 40_000, (["x"] * 6 + ["y"]) * 5_000
    texts = pa.array([" ".join(t) for t in (same, pair, nested)])
    counts, runs, cut = periodic_runs.runs_of_texts(texts)
    assert counts.tolist() == [100_000, 80_000, 35_000]
    got = [[tuple(r.values()) for r in own] for own in runs.to_pylist()]
    assert got[0] == [(0, 100_000, 1)] and got[1] == [(0, 80_000, 2)]
    assert len(got[2]) == 5_001 and (0, 35_000, 7) in got[2]
    assert cut.to_pylist()[:2] == ["a", "a b"]


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (3, " \t ", "y"), (3, "a a a a a a", "y"), (3, "a a a a a a", "y"), (4, "A a A a A a A a", "z"), (5, "b a a a a a a\nc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = {(r.doc_id, r.text): (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()}
    assert got[1, None] == (0, [], "") and got[None, ""] == (0, [], "") and got[3, " \t "] == (0, [], "")
    assert got[3, "a a a a a a"] == (6, [(0, 6, 1)], "a")
    assert got[4, "A a A a A a A a"] == (8, [(0, 8, 2)], "A a")
    assert got[5, "b a a a a a a\nc"] == (8, [(1, 6, 1)], "b a c")
    assert out.count() == 7 and periodic_runs.find_runs(docs.limit(0)).count() == 0
    clean = periodic_runs.collapse_documents(docs.withColumn("more", F.lit(1)))
    assert clean.columns == ["doc_id", "text", "more"]
    assert {(r.doc_id, r.text) for r in clean.collect()} >= {(1, None), (3, " \t "), (3, "a"), (5, "b a c")}


def test_query(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(given)
    n_runs = 0
    for d, text in given:
        w, h = plain.words(text), zlib.crc32(str(d).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = expected(w)
        n_runs += len(runs)
        r = got[d]
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert n_runs > 10

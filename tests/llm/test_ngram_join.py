"""The n-gram join against all pairs, with ordinary buckets and with every bucket treated as a large one."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from dockcast.llm import ngram_join, queries

SF = "/root/testdata/sf0.001"


def grams(text, shingle=4):
    w = plain.words((text or "").translate(plain.LOWER))
    return {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()


def expected(rows, percent=85):
    """(id, text) to id -> (set size, smallest id of the component), over all pairs."""
    sets = [grams(t) for _, t in rows]
    of = list(range(len(rows)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s) + len(sets[j])
            if s and sets[j] and (100 + percent) * len(s & sets[j]) >= percent * both:
                of[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, n=240):
    """Texts around a few templates: copies, edits of one word to many, shared passages, texts of boilerplate alone."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(3000)}"
    templates = [[word() for _ in range(draw.choice((12, 60, 61, 90)))] for _ in range(3)]
    passage, lines = [word() for _ in range(25)], [[word() for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(n):
        kind = draw.random()
        if kind < 0.6:
            own = list(draw.choice(templates))
            for _ in range(draw.choice((0, 0, 1, 1, 2, 3, 5))):
                own[draw.randrange(len(own))] = draw.choice((word(), "edit"))
            own = own[draw.choice((0, 0, 0, 1, 3)) :]
        elif kind < 0.8:
            own = [word() for _ in range(draw.randrange(40))] + passage + [word() for _ in range(draw.randrange(40))]
        elif kind < 0.95:
            own = sum(draw.choices(lines, k=draw.randrange(1, 6)), [])
        else:
            own = [word() for _ in range(draw.randrange(4))]
        rows.append((i, " ".join(own)))
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.components(docs, **options)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())


@pytest.mark.parametrize(("small", "seed"), [(64, 1), (2, 2), (5, 3)])
def test_components_equal_all_pairs(spark, monkeypatch, small, seed):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rows = corpus(seed)
    assert found(spark, rows) == expected(rows)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.op11_ngram_join(spark, SF).collect())
    assert got == expected(rows)


def test_odd_rows(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(5, text, 1), (3, text.upper(), 2), (3, text, 3), (None, text, 4), (7, None, 5), (8, "", 6), (9, " \t\n", 7), (None, None, 8), (10, "a b", 9),
            (11, "A  b", 10), (12, "a b c", 11), (13, " ".join(f"y{i}" for i in range(60_000)), 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").withColumn("node", F.lit("x")).withColumn("sig", F.lit(1))
    out = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(docs).collect()]
    assert sorted(out, key=str) == sorted(
        [(5, 37, 3), (3, 37, 3), (3, 37, 3), (None, 37, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9), (None, 0, None), (10, 1, 10), (11, 1, 10), (12, 1, 12), (13, 59_997, 13)],
        key=str,
    )
    assert ngram_join.components(docs.limit(0)).count() == 0


def test_prefixes_bitmaps_and_sizes():
    import numpy as np

    for n in range(1, 300):
        p = ngram_join.prefix_length(n, 85)
        assert 1 <= p <= n and n - p + 1 == -(-85 * n // 100)
    draw = np.random.default_rng(0)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 80, 50)) for _ in range(2))
        maps = [ngram_join.bitmaps(x, np.zeros(len(x), int), 1)[0] for x in (a, b)]
        off = sum(int(x).bit_count() if x >= 0 else (int(x) + (1 << 64)).bit_count() for x in (maps[0] ^ maps[1]).tolist())
        assert off <= len(np.setxor1d(a, b))


def test_only_hashes_that_connect_something_open_a_bucket(spark, monkeypatch):
    """Of a group of near copies no row is made for a hash in which one node alone differs, or none that is not yet connected."""
    monkeypatch.setattr(ngram_join, "SMALL", 8)
    draw, dealt, whole = random.Random(4), [], ngram_join._sized
    text = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(text)
        for _ in range(draw.choice((0, 1, 2, 3, 4))):
            own[draw.randrange(len(own))] = draw.choice(("edit", f"own{i}"))
        rows.append((i, " ".join(own)))

    def watched(buckets, total):
        sizes = buckets.groupBy("bucket").agg(F.count("*").alias("m"), F.max("open").alias("any"))
        dealt.append(sizes.agg(F.sum("m").alias("rows"), F.sum(F.when((F.col("m") > 1) & F.col("any"), F.col("m"))).alias("useful")).first())
        return whole(buckets, total)

    monkeypatch.setattr(ngram_join, "_sized", watched)
    assert found(spark, rows) == expected(rows)
    assert len(dealt) > 1 and all(d.useful >= 0.98 * d.rows for d in dealt[1:])


def test_joins_on_buckets_make_rows_with_a_partner_only(spark, monkeypatch):
    """Hashes in one list alone, most of all, leave no join with a large bucket in it as rows."""
    monkeypatch.setattr(ngram_join, "SMALL", 8)
    draw, plans, whole = random.Random(5), {}, ngram_join.store
    text = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if draw.random() < 0.97 else f"own{i}" for w in text)) for i in range(60)]
    rows += [(100 + i, " ".join(f"v{i}_{k}" for k in range(40))) for i in range(40)]

    def watched(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, name)

    monkeypatch.setattr(ngram_join, "store", watched)
    assert found(spark, rows) == expected(rows)
    made = plans["join-shared"] + plans["join-sized"]
    assert len(made) > 2 and not any("LeftOuter" in p for p in made)

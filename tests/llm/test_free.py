"""The operators with Python inside tasks, against plain versions, round trips and held-out texts."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockcast.llm import exact_dedup, packing, queries, simhash, simple8b, suffix_tree, tokens

SF = "/root/testdata/sf0.01"
ODD_TEXTS = ["", "  ", "don't STOP'S it's 'll", "İstanbul ΣΑΣ ß ſ", "é ́x a\u0085d", "<|endoftext|> x<|endoftext|>y", "12 3.4 a1b2 ''s", "日本語 テスト",
             "\x00 \x1c a\x1cb", "ÀÉÎ,,, x--y", "´`a a·b ªº ×÷", "!'s don''t 'S", "a " * 20_000, "b" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def plain_ids(texts):
    whole = Tokenizer.from_file(queries.TOKENIZER)
    return {d: whole.encode(t or "", add_special_tokens=False).ids for d, t in texts.items()}


@pytest.fixture
def odd(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "x"), (2, None, "x"), (3, "", "x"), (None, "a b c d", "x"), (4, "z" * 30_000, "x"), (None, "q", "x"), (None, "q", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string")


# ---- tokens and files


def test_encoder_equals_the_tokenizer(texts, plain_ids):
    whole, own = Tokenizer.from_file(queries.TOKENIZER), tokens.Encoder(queries.TOKENIZER)
    given = [*texts.values(), *ODD_TEXTS]
    ids, counts = own.encode(pa.array([*given, None]))
    expected = [*plain_ids.values(), *(whole.encode(t, add_special_tokens=False).ids for t in ODD_TEXTS), []]
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    assert own.encode(pa.array([], pa.string()))[0].size == 0


def test_encoder_with_a_full_cache(texts, plain_ids, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 500)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 20_000)
    ids, _ = tokens.Encoder(queries.TOKENIZER).encode(pa.array(list(texts.values())[:300]))
    assert ids.tolist() == [i for e in list(plain_ids.values())[:300] for i in e]


@pytest.mark.parametrize("seed", range(3))
def test_simple8b_round_trip(seed):
    draw = np.random.default_rng(seed)
    cases = [[], [0], [5] * 3000, draw.integers(0, 49_408, 5000), [*[0] * 500, *draw.integers(0, 3, 900).tolist(), (1 << 60) - 1, 7],
             [1 << 60, (1 << 64) - 1, 3], draw.integers(0, 1 << 62, 2000, dtype=np.uint64), (1 << draw.integers(0, 60, 4000)).astype(np.uint64)]
    for case in cases:
        ids = np.array(case, np.uint64)
        words, offsets, escapes = simple8b.encode_ids(ids)
        assert (simple8b.decode_ids(words, offsets, len(ids), escapes) == ids).all()
        if len(ids) > simple8b.BLOCK:  # a block alone
            a, b = int(offsets[1]), int(offsets[2]) if len(offsets) > 2 else len(words)
            n = min(simple8b.BLOCK, len(ids) - simple8b.BLOCK)
            alone = simple8b.decode_ids(words[a:b], np.array([0, b - a], np.uint64), n, np.empty((0, 2), np.uint64))
            real = ids[simple8b.BLOCK : simple8b.BLOCK + n]
            assert (alone[real < 1 << 60] == real[real < 1 << 60]).all()
    shard = simple8b.encode_shard(np.array([3, 9]), np.array([2, 1]), np.array([7, 8, 9]))
    assert [x.tolist() for x in simple8b.decode_shard(shard)] == [[3, 9], [2, 1], [7, 8, 9]]
    with pytest.raises(ValueError, match="not a shard"):
        simple8b.decode_shard(b"nope" + shard[4:])


def test_token_files(spark, plain_ids):
    at, expected = 0, []
    for d in sorted(plain_ids):
        ids = [*plain_ids[d], 1]
        expected.append((d, at, len(ids), plain.crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, queries.op7_token_files(spark, SF).collect())) == expected


def test_token_files_odd_rows(spark, odd, tmp_path):
    for name, rows in (("all", odd), ("none", odd.limit(0))):
        simple8b.write(rows, f"{tmp_path}/{name}", queries.TOKENIZER)
        got = simple8b.read_index(spark, f"{tmp_path}/{name}").collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows.collect())
        starts = sorted((r.start, r.n_tokens) for r in got)
        assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
        assert [r.doc_id for r in sorted(got, key=lambda r: r.start)][:3] == ([None] * 3 if got else [])


# ---- packing


def check_packed(rows, ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        own, at = np.array([*ids[d], 2], "<u4"), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(own)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return len(by_sequence)


def test_packing(spark, plain_ids):
    n = check_packed(queries.op4_packing(spark, SF).collect(), plain_ids)
    assert sum(len(i) + 1 for i in plain_ids.values()) > 0.97 * n * packing.CAPACITY


def test_packing_odd_rows_and_sequences(spark, odd):
    packed = packing.pack_documents(odd, queries.TOKENIZER)
    rows = packed.collect()
    assert sum(r.length for r in rows if r.start == 0 and r.doc_tokens <= 4096) == sum(r.doc_tokens for r in rows if r.start == 0 and r.doc_tokens <= 4096)
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in odd.collect())
    whole = packing.sequences(odd, packed, queries.TOKENIZER).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert {r.sequence_id: r.length for r in whole} == dict(used)
    for r in rows:
        ids = next(w.ids for w in whole if w.sequence_id == r.sequence_id)
        assert zlib.crc32(ids[4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32
    assert packing.pack_documents(odd.limit(0), queries.TOKENIZER).count() == 0


def test_differencing():
    draw = np.random.default_rng(1)
    assert packing.pack_group(np.array([], np.int64)).tolist() == []
    assert sorted(np.bincount(packing.spread(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]  # the known result of differencing
    for n in (1, 2, 50, 700):
        lengths = np.sort(draw.integers(1, 4097, n))[::-1]
        sums = np.bincount(packing.pack_group(lengths), lengths)
        assert sums.max() <= 4096 and sums.sum() == lengths.sum()
    sums = np.bincount(packing.spread(lengths, 400), lengths)
    lpt = np.zeros(400, np.int64)
    for x in lengths:
        lpt[lpt.argmin()] += x
    assert sums.max() - sums.min() <= lpt.max() - lpt.min() + 50


# ---- exact copies


def test_exact_dedup(spark, docs, texts):
    groups = defaultdict(list)
    for d, t in texts.items():
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    expected = sorted((d, max(v), len(v), d == max(v), h) for h, v in groups.items() for d in v)
    assert sorted(map(tuple, queries.op8_exact_dedup(spark, SF).collect())) == expected
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == sorted(max(v) for v in groups.values())


def test_exact_dedup_odd_rows(odd):
    rows = exact_dedup.decide(odd).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.kept) for r in rows if r.keep_id is not None)
    assert got == [(-1, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True), (2, 3, 2, False), (3, 3, 2, True), (4, 4, 1, True)]
    assert sorted(r.kept for r in rows if r.keep_id is None) == [False, True]
    stay = exact_dedup.drop_copies(odd)
    assert stay.columns == odd.columns and Counter(r.doc_id for r in stay.collect()) == Counter([1, 3, 4, None])
    assert exact_dedup.decide(odd.limit(0)).count() == 0 and exact_dedup.drop_copies(odd.limit(0)).count() == 0


def test_exact_dedup_hot_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text")
    )
    got = exact_dedup.decide(rows.repartition(20)).collect()
    sizes = Counter(r.text for r in rows.collect())
    text = {r.doc_id: r.text for r in rows.collect()}
    assert all(r.group_size == sizes[text[r.doc_id]] for r in got) and sum(r.kept for r in got) == len(sizes)


def test_golomb_round_trip():
    draw = np.random.default_rng(2)
    for n in (0, 1, 7, 4000):
        values = np.unique(draw.integers(0, 1 << 28, n).astype(np.uint64))
        rice = exact_dedup._rice(len(values), 1 << 28)
        coded = exact_dedup.rice_encode(values, rice)
        assert (exact_dedup.rice_decode(coded, len(values), rice) == values).all()
    assert len(coded) * 8 < 20 * n  # 28 bits uncoded


# ---- near copies


def test_fingerprints_and_components(spark, docs, texts):
    prints = [plain.fingerprint(t) for t in texts.values()]
    expected = plain.components(list(texts), prints)
    rows = {r.doc_id: r for r in queries.op9_simhash(spark, SF).collect()}
    assert [(rows[d].fingerprint, rows[d].component_id) for d in texts] == [(f"{p:016x}", c) for p, c in zip(prints, expected, strict=True)]
    stay = simhash.drop_near_copies(docs)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == sorted(set(expected))


def near_prints(n, seed):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [base]
    for _ in range(3):
        x = base.copy()
        for _ in range(draw.integers(1, 4)):
            x ^= np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64)
        out.append(x)
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("most", [5, 1 << 16])
def test_links_connect_all_pairs_within_the_budget(spark, most):
    values = near_prints(400, 3)
    signed = values.astype(np.int64).tolist()
    roots = simhash.connect(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, most)).collect()
    expected = plain.components(signed, values)
    assert sorted((r.node, r.root) for r in roots) == sorted((v, c) for v, c in zip(signed, expected, strict=True) if v != c)


def test_trie_in_pieces(monkeypatch):
    values = near_prints(500, 4)
    whole = simhash.join_trie(values, 0, 2)
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    assert (simhash.join_trie(values, 0, 2) == whole).all()
    assert simhash.join_trie(np.empty(0, np.uint64), 21, 2).size == 0


def test_layouts_cover_all_bits():
    for path in ((0,), (2, 1), (1, 1, 1, 0)):
        order, shared = simhash.layout(path, 2)
        assert sorted(order) == list(range(64)) and 0 < shared < 64


def test_simhash_odd_rows(odd):
    rows = simhash.components(odd).collect()
    ids = [r.doc_id for r in odd.collect() if r.doc_id is not None]
    prints = [plain.fingerprint(r.text) for r in odd.collect() if r.doc_id is not None]
    expected = dict(zip(ids, plain.components(ids, prints), strict=True))
    assert all(r.component_id == expected[r.doc_id] for r in rows if r.doc_id is not None) and len(rows) == 8
    stay = simhash.drop_near_copies(odd)
    assert stay.columns == odd.columns and stay.count() == len({r.component_id for r in rows})
    assert simhash.components(odd.limit(0)).count() == 0 and simhash.drop_near_copies(odd.limit(0)).count() == 0


# ---- scoring


def test_scores_against_a_plain_tree(spark, docs, texts):
    rows = {r.doc_id: r for r in queries.op6_suffix_tree(spark, SF).collect()}
    split = {d: [*plain.words((t or "").translate(plain.LOWER)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, ws in split.items() if not held[d] for w in ws)
    below = sum(counts.values()) + len(counts) + 1
    for d, ws in split.items():
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(counts[w] > 0 for w in ws), sum(counts.values()))
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / below) for w in ws), rel_tol=1e-9)

    states: dict[bytes, dict[int, int]] = {b"": {}}
    for r in suffix_tree.contexts(docs.filter(~suffix_tree.held_out())).collect():
        states.setdefault(r.context.to_bytes(r.depth, "big"), {})[r.symbol] = r.n
    known: dict[bytes, np.ndarray] = {}

    def shares(context):
        if context not in known:
            rest = next((shares(context[k:]) for k in range(1, len(context) + 1) if context[k:] in states), np.full(256, 1 / 256))
            n = np.zeros(256)
            for s, c in states[context].items():
                n[s] = c
            known[context] = (n + suffix_tree.PRIOR * rest) / (n.sum() + suffix_tree.PRIOR)
        return known[context]

    for d in list(texts)[:25]:
        read, total = b"\xff" * suffix_tree.DEPTH, 0.0
        for s in " ".join(split[d][:-1]).encode() + b"\xff":
            context = next(read[k:] for k in range(len(read) - suffix_tree.DEPTH, len(read) + 1) if read[k:] in states)
            total += math.log10(shares(context)[s])
            read += bytes([s])
        assert math.isclose(rows[d].score, total, rel_tol=1e-5)

    size = lambda d: len(" ".join(split[d][:-1]).encode()) + 1
    out = [d for d in texts if held[d]]
    bits = -sum(rows[d].score for d in out) * math.log2(10) / sum(map(size, out))
    flat = -sum(math.log10(shares(b"")[s]) for d in out for s in " ".join(split[d][:-1]).encode() + b"\xff") * math.log2(10) / sum(map(size, out))
    assert bits < 0.7 * flat  # the contexts help on held-out texts


def test_scores_odd_rows(spark, odd):
    nothing = odd.limit(0)
    words, tree = suffix_tree.train_unigrams(nothing), suffix_tree.train_tree(nothing)
    rows = suffix_tree.score(odd, tree, words).collect()
    assert len(rows) == 8 and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
    for r in rows:
        if r.doc_id == 2:
            assert r.n_tokens == 1 and math.isclose(r.score, -math.log10(256), rel_tol=1e-6)
    words, tree = suffix_tree.train_unigrams(odd), suffix_tree.train_tree(odd)
    assert suffix_tree.score(nothing, tree, words).count() == 0
    shares = 10.0 ** tree.log10.astype(float)
    unseen = 256 - (tree.log10.shape[1] - 1)
    assert abs(shares[:, :-1].sum(axis=1) + unseen * shares[:, -1] - 1).max() < 1e-4
    random.seed(1)
    symbols = np.array(random.choices(range(97, 101), k=3 * suffix_tree.STREAM + 5), np.uint8)
    node = tree.start
    slow = []
    for s in tree.symbol[symbols].tolist():
        slow.append(tree.log10[node, s])
        node = tree.step[node, s]
    assert np.allclose(suffix_tree.score_symbols(tree, symbols), slow)

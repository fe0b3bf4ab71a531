"""The stages one by one against plain versions of what they decide."""

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import plain
from test_free import check_packed
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        outs.append(docs)
    assert all(o.columns == columns for o in outs[:-1])
    given = spark.read.parquet(f"{SF}/documents.parquet").collect()

    base = {r.doc_id for r in given if (m := plain.measures(r.text))[0] >= 20 and 100 * m[5] <= 30 * m[0] and 10 * m[2] <= 3 * m[0] and 2 * m[4] <= m[3]}
    kept = [r for r in outs[0].collect()]
    assert {r.doc_id for r in kept} == base

    newest = defaultdict(int)
    for r in kept:
        newest[r.text] = max(newest[r.text], r.doc_id)
    exact = outs[1].collect()
    assert {r.doc_id for r in exact} == set(newest.values())

    ids = [r.doc_id for r in exact]
    expected = set(plain.components(ids, [plain.fingerprint(r.text) for r in exact]))
    near = outs[2].collect()
    assert {r.doc_id for r in near} == expected and len(near) == len(expected)

    size = {r.doc_id: len(plain.words(r.text)) for r in near}
    by = defaultdict(int)
    for r in near:
        by[r.source] += size[r.doc_id]
    goal, mixed = plain.targets(dict(by)), outs[3].collect()
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(size) and max(copies.values()) <= 3
    for s in by:
        own = [r.doc_id for r in near if r.source == s]
        assert abs(sum(copies[d] * size[d] for d in own) - goal[s]) <= max(size[d] for d in own)

    whole = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    pieces = outs[4].collect()
    tokens = {r.doc_id: whole.encode(r.text, add_special_tokens=False).ids for r in mixed}
    assert sum(r.length for r in pieces) == sum(len(tokens[r.doc_id]) + 1 for r in mixed)
    once = [r for r in pieces if copies[r.doc_id] == 1]
    for r in once:
        own = np.array([*tokens[r.doc_id], 2])
        assert plain.crc(own[r.start : r.start + r.length]) == r.ids_crc32
    places = Counter((r.sequence_id, r.offset) for r in pieces)
    assert max(places.values()) == 1
    if all(c == 1 for c in copies.values()):
        check_packed(pieces, tokens)

    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, pieces))

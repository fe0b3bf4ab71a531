"""Helpers that several operators share."""

import pyarrow as pa
import pytest

from dockcast.llm import common, simhash, texts

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_small_batches_last_as_long_as_the_step(spark):
    before = spark.conf.get(KEY)
    with common.small_batches(spark):
        assert spark.conf.get(KEY) == str(common.BATCH_ROWS)
    assert spark.conf.get(KEY) == before
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        raise ZeroDivisionError
    assert spark.conf.get(KEY) == before


def test_keys_of_near_copies_are_worked_out_for_doubtful_rows_only(spark):
    rows = [(i, f"text number {i} of a few words") for i in range(40)] + [(100 + i, "one text that comes again and again") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.drop_near_copies(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "pythonUDF" not in plan.split("ArrowEvalPython")[-1].split("\n", 1)[1]  # no filter on the key below its evaluation
    assert {r.doc_id for r in kept.filter("doc_id >= 100").collect()} == {100}


def test_slices_and_words():
    given = ["a  b\tc", None, "", " \n", "x" * 50, "é\u0085f g"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(given, pa.string())], ["id", "text"])
    parts = list(texts.slices(iter([batch]), 1, most=10))
    assert [i for b, _ in parts for i in b.column(0).to_pylist()] == list(range(6))
    assert [t for _, x in parts for t in x.to_pylist()] == ["a  b\tc", "", "", " \n", "x" * 50, "é\u0085f g"]
    flat, counts = texts.words(pa.array([g or "" for g in given]))
    assert flat.to_pylist() == ["a", "b", "c", "x" * 50, "é\u0085f", "g"] and counts.tolist() == [3, 0, 0, 0, 1, 2]
    assert texts.starts_of(counts).tolist() == [0, 3, 3, 3, 3, 4, 6]
    assert list(texts.slices(iter([]), 0)) == []


def test_join_known_keeps_rows_with_a_group_whatever_the_share_of_their_key(spark):
    keys = [1] * 3000 + [2] * 900 + list(range(10, 300)) * 2 + [5000, 5001, None, None]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    sizes = {k: keys.count(k) for k in set(keys) if k is not None and keys.count(k) > 1}
    for given in (sizes, {k: n for k, n in sizes.items() if n < 4}, {}):
        groups = spark.createDataFrame(list(given.items()), "k long, m long")
        out = common.join_known(rows, groups, "k", "m", len(keys))
        assert out.columns == ["k", "i", "m"]
        assert sorted(map(tuple, out.collect())) == sorted((k, i, given[k]) for i, k in enumerate(keys) if k in given)
        assert "LeftOuter" not in out._jdf.queryExecution().optimizedPlan().toString()

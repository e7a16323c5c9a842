"""Benchmark windows in documents, against SQL and by hand."""

import hashlib

import pytest
from comparing import rows_of, rows_of_sql

from sessiongrid.llm import decontaminate as dc
from sessiongrid.llm.queries import ORACLE_SQL, QUERIES


def test_query_equals_sql(spark, duck, sf_dir):
    df = QUERIES["op9_decontamination"](spark, sf_dir)
    want, names = rows_of_sql(duck, ORACLE_SQL["op9_decontamination"])
    assert sorted(df.columns) == names and rows_of(df) == want


ITEMS = [(10, "a b c d e f g h i j k"), (2, "X-Y"), (2, "X-Y"), (3, None), (4, "..."), (None, "q r s")]
TEXTS = [
    (1, "A,b c d e f g h i j k! tail", 11, ["10"]),
    (2, "b c d e f g h i j k", 10, ["10"]),
    (3, "a b c d e f g h i", 0, []),
    (4, "x y x y", 4, ["2"]),
    (5, None, 0, []),
    (6, "", 0, []),
    (7, "É x é y", 0, []),
    (8, "q r s x y", 5, ["", "2"]),
    (None, "x y", 2, ["2"]),
    (1, "other text under a known id", 0, []),
]


@pytest.mark.parametrize("block", [50_000, 2])
def test_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK", block)
    docs = spark.createDataFrame([(k, t, 1) for k, t, _, _ in TEXTS] + [(1, TEXTS[0][1], 1)], "doc_id long, text string, hits int")
    got = dc.report(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    want = [(k, n, hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()) for k, _, n, items in [*TEXTS, TEXTS[0]]]
    assert sorted(((r["doc_id"], r["n_hit"], r["items_sha256"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)
    kept = dc.without_contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 7]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.report(docs.limit(0), items).count() == 0
    assert [r["n_hit"] for r in dc.report(docs, items.limit(0)).collect()] == [0]


def test_a_word_in_all_texts_and_a_long_text(spark):
    docs = spark.createDataFrame([(k, "the " * 50 + f"the rare{k} the") for k in range(50)] + [(99, "w " * 60_000 + "the rare7 the")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the the"), (2, "the rare7 the")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in dc.report(docs, items).collect()}
    assert got[7] == (53, 2) and got[8] == (51, 1) and got[99] == (3, 1)


def test_only_built_in_functions(spark, sf_dir):
    plan = QUERIES["op9_decontamination"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

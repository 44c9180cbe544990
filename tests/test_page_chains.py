"""Page chains with one fault each, and chunks of a null parent."""

from pyspark.sql import functions as F

from outledger.operators.nesting import ChildList, checked_array, nest_lists, split_rejects
from outledger.sources.pages import chain_faults, chain_places


def test_faults_of_extracts(spark):
    extracts = {
        "whole": [("a", False, "b"), ("b", False, "c"), ("c", True, None)],
        "one": [("a", True, None)],
        "gap": [("a", False, "b"), ("c", False, "d"), ("d", True, None)],
        "fork": [("a", False, "c"), ("b", False, "c"), ("c", True, None)],
        "cycle": [("a", False, "b"), ("b", False, "a"), ("c", True, None)],
        "open": [("a", False, "b"), ("b", False, None)],
        "twice": [("a", False, "b"), ("a", False, "b"), ("b", True, None)],
        "ends": [("a", True, "b"), ("b", True, None)],
        "long": [(str(i), i == 99, str(i + 1)) for i in range(100)],
    }
    rows = [(e, *p) for e, pages in extracts.items() for p in pages]
    pages = spark.createDataFrame(rows, "extract string, url string, done boolean, nextRecordsUrl string")
    found = {}
    for r in chain_faults(pages, F.col("extract")).collect():
        found.setdefault(r.extract, {})[r.fault] = r.n
    assert found == {
        "gap": {"missing page": 1, "first pages": 2},
        "fork": {"fork": 1, "first pages": 2},
        "cycle": {"cycle": 2},
        "open": {"open end": 1, "final pages": 0},
        "twice": {"repeated page": 1},
        "ends": {"first pages": 2, "final pages": 2},
    }
    links = pages.where("extract = 'long'").select("extract", "url", F.when(~F.col("done"), F.col("nextRecordsUrl")).alias("next"))
    assert {(r.url, r.steps) for r in chain_places(links).collect()} == {(str(i), 99 - i) for i in range(100)}


def test_children_of_a_null_key_come_in_chunks(spark):
    rows = [(None, i) for i in range(9)] + [(1, i) for i in range(5)] + [(2, 0)]
    df = spark.createDataFrame(rows, "k int, v int")
    docs = nest_lists({"vs": ChildList(df, ["v"], ["v"])}, "k", part_rows=2)
    got = {}
    for r in sorted(docs.collect(), key=lambda r: r.part_no):
        got.setdefault((r.k, r.parts), []).append([x.v for x in r.vs])
    assert got == {
        (None, 5): [[0, 1], [2, 3], [4, 5], [6, 7], [8]], (1, 3): [[0, 1], [2, 3], [4]], (2, 1): [[0]],
    }


def test_unusable_lists_are_kept_aside(spark):
    texts = ['[{"k":1}]', ' {"k":2} ', "", None, "null", "7", '"x"', "[oops", "{", "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows, rejects = split_rejects(df, ["i"], "t", "struct<k:int>")
    assert {r.i: len(r["items"]) for r in rows.collect() if r["items"]} == {0: 1, 1: 1}
    assert {(r.i, r.text, r.reason) for r in rejects.collect()} == {
        (5, "7", "no list"), (6, '"x"', "no list"), (7, "[oops", "not JSON"), (8, "{", "not JSON"),
    }
    assert df.select(checked_array(F.col("t"), "struct<k:int>").alias("c")).where("c.items is null").isEmpty()

"""Trigram search against the literal scan."""

import random

from outledger.operators import filters, search


def test_same_rows_as_a_scan(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abAB%_ é", k=rng.choice([0, 1, 2, 3, 5, 9])))
    rows = [(i, word(), rng.choice([None, word()]), "x") for i in range(400)] + [(400, "aaaa", "İstanbul", "y")]
    df = spark.createDataFrame(rows, "k int, a string, b string, gram string")
    path = str(tmp_path / "postings")
    search.store_postings(df, "k", ["a", "b"], path)
    for text in ("", "a", "ab", "abA", "AAAA", "b%_", " é ", "aaaaa", "ababab", "zzz", "stan"):
        want = sorted(r.k for r in filters.search(df, ["a", "b"], text).collect())
        got = search.search(spark, df, "k", ["a", "b"], text, path)
        assert sorted(r.k for r in got.collect()) == want, text


def test_only_postings_of_the_needle_are_read(spark, tmp_path):
    rows = [(i, f"item number {i:05d} {chr(97 + i % 26) * 4}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, a string")
    path = str(tmp_path / "postings")
    search.store_postings(df, "k", ["a"], path)
    found = search.search(spark, df, "k", ["a"], "QQQQ", path)
    assert sorted(r.k for r in found.collect()) == [i for i in range(3000) if i % 26 == 16]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1]
    assert "EqualTo(gram,qqq)" in plan or "In(gram" in plan

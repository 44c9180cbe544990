"""Pairs of rows of equal keys, formed from blocks."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from outledger.operators import blocks, joins

LEFT = "a string, b string, n int, same string, d decimal(9,2), t timestamp, day date, x double, l array<int>, s struct<p:int,q:string>"


def left_rows(n):
    made = [
        (f"K{i % 3}" if i % 7 else None, "Q" if i % 2 else "", i % 2, f"left {i}", Decimal(i) / 4, datetime(2024, 1, 1 + i % 9, 7),
         date(2024, 2, 1), i / 8, [i, None], (i, None if i % 5 else "q"))
        for i in range(n)
    ]
    return made + made[:5] + [tuple(None for _ in made[0])] * 2


def plain(left, right):
    lk = F.concat_ws("", left["a"], left["b"], left["n"].cast("string"))
    rk = F.concat_ws("", right["u"], right["v"], right["w"].cast("string"))
    return left.join(right, lk == rk).select(*[left[c] for c in left.columns], *[right[c] for c in right.columns])


@pytest.mark.parametrize("small", [False, True])
def test_pairs_are_those_of_a_join_of_rows(spark, monkeypatch, small):
    if small:  # keys of several blocks, panels and parts
        for name, value in (("LEFT_ROWS", 4), ("RIGHT_ROWS", 3), ("HELD_ROWS", 16), ("PANEL", 10), ("PART", 7), ("TASK_ROWS", 20)):
            monkeypatch.setattr(blocks, name, value)
    left = spark.createDataFrame(left_rows(80), LEFT).withColumn("none", F.lit(None)).repartition(3)
    # 'K0' + 'Q' is also '' + 'K0Q', and null counts as ''.
    texts = [("K0", "Q"), (None, "K0Q"), ("K1", None), ("", ""), (None, None), ("K9", "")]
    rows = [(*texts[i % 6], i % 2, i, f"right {i}") for i in range(60)] * 2 + [(None, None, None, None, None)] * 3
    right = spark.createDataFrame(rows, "u string, v string, w int, i bigint, same string").repartition(2)
    found = joins.join_on_concat(left, right, ["a", "b", "n"], ["u", "v", "w"])
    wanted = plain(left, right)
    assert found.dtypes == wanted.dtypes
    got = found.collect()
    assert len(got) > 500
    assert Counter(map(repr, map(tuple, got))) == Counter(map(repr, map(tuple, wanted.collect())))


def test_sides_without_rows_or_other_columns(spark):
    left = spark.createDataFrame([("A", "B"), ("A", "B"), ("C", None)], "a string, b string")
    right = spark.createDataFrame([("AB",), ("AB",), ("C",), ("D",)], "k string")
    pairs = joins.join_on_concat(left, right, ["a", "b"], ["k"]).collect()
    assert Counter(map(tuple, pairs)) == {("A", "B", "AB"): 4, ("C", None, "C"): 1}
    assert joins.join_on_concat(left, right.limit(0), ["a", "b"], ["k"]).count() == 0
    assert joins.join_on_concat(left.limit(0), right, ["a", "b"], ["k"]).count() == 0


def test_written_pairs_of_a_large_key_take_few_bits(spark, tmp_path):
    # As many left rows that a page of a file does not hold what repeats, and no sequence ends at a whole byte twice in it.
    key = F.concat(F.lit("K"), (F.col("id") < 0).cast("string"))
    left = spark.range(6007).select(key.alias("a"), (F.col("id") * 7 % 6007 + 10**9).alias("i"))
    right = spark.range(500).select(key.alias("x"), F.col("id").alias("j"))
    joins.join_on_concat(left, right, ["a"], ["x"]).select("i", "j").write.parquet(f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.count("*"), F.sum("i"), F.count_distinct("j")).first()[:] == (
        6007 * 500, 500 * (6007 * 10**9 + 6007 * 6006 // 2), 500
    )
    size = sum(f.stat().st_size for f in (tmp_path / "out").glob("part-*"))
    assert size * 8 < 3 * 6007 * 500


def test_pairs_of_a_key_are_dealt_to_tasks_and_formed_one_right_row_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(blocks, "PANEL", 256)
    monkeypatch.setattr(blocks, "PART", 256)
    key = F.concat(F.lit("K"), (F.col("id") < 0).cast("string"))
    sides = [spark.range(2048).select(key.alias(k), F.col("id").alias(c)) for k, c in (("a", "i"), ("x", "j"))]
    pairs = joins.join_on_concat(*sides, ["a"], ["x"]).select("i", "j", F.spark_partition_id().alias("task"))
    by_task = pairs.groupBy("task").agg(F.count("*").alias("n"))
    sizes = [r.n for r in by_task.collect()]
    assert sum(sizes) == 2048 * 2048 and len(sizes) > 1
    formed = [x for x in by_task._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate inline" in x]
    assert formed and not any("*(" in x for x in formed)


def test_cut_blocks_hold_rows_of_one_key_in_order():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"k0": ["b", None, "b", "", "b", None], "v": [1, 2, 3, 4, 5, 6]})
    (cut,) = blocks.cutter(["k0"], ["v"], "n", 2)(iter([rows.slice(0, 0), rows.slice(0, 3), rows.slice(3)]))
    assert sorted(map(str, cut.to_pylist())) == sorted(
        map(str, [{"k0": "b", "n": 2, "v": [1, 3]}, {"k0": "b", "n": 1, "v": [5]}, {"k0": None, "n": 2, "v": [2, 6]}, {"k0": "", "n": 1, "v": [4]}])
    )

"""Deep pages of a stored list read one or two files; positions run their source once."""

from pyspark.sql import functions as F

from outledger.operators.batching import with_position
from outledger.operators.paging import page_of
from outledger.operators.stored_list import store_list


def shuffled(spark, n):
    return spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 3).alias("kind"))


def test_deep_pages_read_two_files_at_most(spark, tmp_path):
    stored = store_list(shuffled(spark, 1_200_007), str(tmp_path / "list"), ["k"], file_rows=40_000)
    assert stored.total() == 1_200_007
    for page in (1, 201, 10_001, 12_001):
        shown = stored.page(page, 100)
        assert [r.k for r in shown.collect()] == list(range((page - 1) * 100, min(page * 100, 1_200_007)))
        assert len(shown.inputFiles()) <= 2
    assert stored.page(12_002, 100).count() == 0
    files = stored.index.count()
    assert files >= 30 and stored.index.orderBy("start").first()["first"]["k"] == 0


def test_filtered_pages_equal_sorted_ones(spark, tmp_path):
    df = shuffled(spark, 5_003)
    stored = store_list(df, str(tmp_path / "list"), ["k"], file_rows=300)
    condition = F.col("kind") == 1
    stored.count_where("ones", condition)
    for page in (1, 7, 80, 83, 84, 99):
        want = [r.k for r in page_of(df.where(condition), ["k"], page, 20).collect()]
        shown = stored.page(page, 20, "ones", condition)
        assert [r.k for r in shown.collect()] == want
        assert len(shown.inputFiles()) <= 2 or not want
    assert stored.page(1, 20, "ones", condition).first().total_count == df.where(condition).count()


def test_empty_list(spark, tmp_path):
    stored = store_list(shuffled(spark, 5).limit(0), str(tmp_path / "list"), ["k"])
    assert stored.total() == 0 and stored.page(1).count() == 0


def test_positions_run_their_source_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(k):
        runs.add(1)
        return k

    counted = F.udf(seen, "long")
    df = spark.range(500).repartition(3).select(counted("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows = with_position(df, ["k"])
    assert sorted((r.pos, r.k, r.v, r.total) for r in rows.collect()) == [(i, i, 2 * i, 500) for i in range(500)]
    assert runs.value == 500

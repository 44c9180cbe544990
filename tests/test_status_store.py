"""Bucketed record status: which files a write touches, and counts that never need a recount."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from outledger.operators import state
from outledger.operators.status_store import StatusStore
from outledger.sources.schemas import RECORD_STATUS

START = datetime(2026, 1, 1)
STATUSES = ["Pending", "Pushing", "Pushed", "Failed"]


def rows_of(store, part):
    return sorted(map(tuple, store.read(part).collect()), key=str)


def updates(spark, rng, part, keys, hour):
    now = START + timedelta(hours=hour)
    rows = []
    for k in keys:
        status = rng.choice(STATUSES)
        final = now if status in ("Pushed", "Failed") else None
        rows.append((part, k, status, final, "e" if status == "Failed" else None, now))
    return spark.createDataFrame(rows, RECORD_STATUS)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = StatusStore(spark, str(tmp_path / "s"), buckets=8)
    rng = random.Random(1)
    store.upsert(updates(spark, rng, "a", [str(i) for i in range(200)], 0), "a")
    store.upsert(updates(spark, rng, "b", ["1", "2"], 0), "b")
    files = lambda: {k: sorted((tmp_path / "s" / v).glob("*.parquet")) for k, v in store.folders().items()}
    before = files()
    assert sum(k[0] == "a" for k in before) == 8
    change = updates(spark, rng, "a", ["7"], 1)
    hit = change.select(store.bucket().alias("b")).first().b
    store.upsert(change, "a")
    after = files()
    assert {k for k in after if after[k] != before.get(k)} == {("a", hit)}
    written = tmp_path / "s" / store.folders("a", [hit])["a", hit]
    assert [p.name for p in written.parent.glob("bucket=*")] == [f"bucket={hit}"]
    # Reading one bucket lists only its folder.
    read = store.read("a", [hit])
    assert all(f"/bucket={hit}/" in f for f in read.inputFiles()) and read.count() < 200
    again = StatusStore(spark, str(tmp_path / "s"), buckets=3)  # the first write decides
    assert again.buckets == 8 and rows_of(again, "a") == rows_of(store, "a")


def test_counts_equal_a_recount(spark, tmp_path):
    rng = random.Random(5)
    store = StatusStore(spark, str(tmp_path / "s"), buckets=3)
    expected = {part: spark.createDataFrame([], RECORD_STATUS) for part in "ab"}
    for hour in range(8):
        part = rng.choice("ab")
        keys = rng.sample([str(i) for i in range(30)], rng.choice([0, 1, 6, 20]))
        change = updates(spark, rng, part, keys, hour)
        if hour == 5:
            named = change.select("record_key")
            store.mark_in_flight(named, part, F.lit(START).cast("timestamp_ntz"))
            change = state.in_flight_updates(named, part, F.lit(START).cast("timestamp_ntz"))
        else:
            store.upsert(change, part)
        merged = state.upsert_status(expected[part], change).collect()
        expected[part] = spark.createDataFrame(merged, RECORD_STATUS)
    for part in "ab":
        rows = expected[part]
        assert rows_of(store, part) == sorted(map(tuple, rows.collect()), key=str)
        recount = {r.push_status: r["count"] for r in rows.groupBy("push_status").count().collect()}
        counts = store.status_counts(part)
        assert {r.push_status: r.n for r in counts.collect()} == recount
        assert not any("/bucket=" in f for f in counts.inputFiles())


def test_lookup_reads_buckets_of_its_keys(spark, tmp_path):
    store = StatusStore(spark, str(tmp_path / "s"), buckets=8)
    store.upsert(updates(spark, random.Random(2), "a", [str(i) for i in range(99)], 0), "a")
    found = store.lookup(spark.createDataFrame([("3",), ("3",), ("nobody",)], "record_key string"), "a")
    assert [r.record_key for r in found.collect()] == ["3"]
    assert store.lookup(spark.createDataFrame([("3",)], "record_key string"), "none").count() == 0

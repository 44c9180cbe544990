"""Properties that hold for any input, also when one key holds most of the rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.operators import delivery, joins, ranking, state
from outledger.operators.batching import assign_batches
from outledger.operators.nesting import ChildList, distinct_children, nest_lists, places
from outledger.operators.filters import FilterSpec, exclude_values, include_values
from outledger.operators.paging import far_page, page_of
from outledger.operators.skew import HotKeys, salted_join
from outledger.operators.state import Snapshots
from outledger.operators.status_store import StatusStore
from outledger.plans.push import PushRun
from outledger.fixed_values import NOT_FOUND_TEXT
from outledger.sources.schemas import RECORD_STATUS
from outledger.plans.items import item_documents
from outledger.rules import Rules
from outledger.sources.schemas import RECORD_STATUS

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

START = datetime(2026, 1, 1)


@few
@given(
    keys=st.lists(st.integers(0, 3), max_size=60),
    size=st.integers(1, 20),
)
def test_batches_split_the_input_exactly(spark, keys, size):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    out = assign_batches(rows, ["k", "i"], size).collect()
    ordered = sorted((k, i) for i, k in enumerate(keys))
    assert [(r.k, r.i) for r in sorted(out, key=lambda r: r.pos)] == ordered
    assert sorted(r.pos for r in out) == list(range(len(keys)))
    assert all(r.batch_no == r.pos // size + 1 for r in out)
    assert sum(r.batch_end for r in out) == (1 if keys else 0)


def test_positions_with_a_hot_leading_key(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, 5).otherwise(F.col("id") % 7).alias("k"), "id"
    )
    out = assign_batches(rows, ["k", "id"], 64)
    got = [tuple(r) for r in out.orderBy("pos").select("k", "id").collect()]
    assert got == sorted(tuple(r) for r in rows.collect())


@few
@given(
    events=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c"]),
            st.sampled_from(["Pushing", "Pushed", "Failed"]),
        ),
        min_size=1,
        max_size=12,
    ),
    split=st.integers(0, 12),
)
def test_bulk_upsert_equals_serial_replay(spark, events, split):
    expected = {}
    for i, (key, status) in enumerate(events):
        now = START + timedelta(hours=i)
        final = status in ("Pushed", "Failed")
        old = expected.get(key, (None, None, None, None))
        error = f"e{i}" if status == "Failed" else None
        expected[key] = (status, now if final else old[1], error, now)

    def updates(part):
        rows = [
            (
                "m",
                key,
                status,
                START + timedelta(hours=i) if status != "Pushing" else None,
                f"e{i}" if status == "Failed" else None,
                START + timedelta(hours=i),
                i,
            )
            for i, (key, status) in part
        ]
        return spark.createDataFrame(rows, RECORD_STATUS + ", seq int")

    numbered = list(enumerate(events))
    store = spark.createDataFrame([], RECORD_STATUS)
    for part in (numbered[:split], numbered[split:]):
        store = state.bulk_upsert(store, updates(part), "seq")
    got = {
        r.record_key: (r.push_status, r.last_pushed_at, r.error_message, r.updated_at)
        for r in store.collect()
    }
    assert got == expected
    again = state.bulk_upsert(store, updates(numbered), "seq")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, store.collect()))


@few
@given(
    requested=st.sets(st.integers(0, 9), min_size=1),
    fetched=st.sets(st.integers(0, 9)),
    mapped=st.sets(st.integers(0, 9)),
    failed=st.sets(st.integers(0, 9)),
)
def test_every_requested_key_has_one_outcome(spark, requested, fetched, mapped, failed):
    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "record_key int")

    errors = keys(failed).withColumn("error_message", F.lit("bad"))
    out = delivery.reconcile_missing(keys(requested), keys(fetched), keys(mapped), errors).collect()
    assert sorted(r.record_key for r in out) == sorted(requested)
    for r in out:
        good = r.record_key in fetched & mapped - failed
        assert r.success == good and (r.error_message is None) == good


def test_pages_cover_all_rows_once(spark):
    rows = spark.range(137).select(F.col("id").alias("k"))
    seen = [r.k for page in range(1, 9) for r in page_of(rows, ["k"], page, 20).collect()]
    assert seen == list(range(137))


def test_prefer_is_unique_and_takes_the_best_source(spark):
    def source(seed, n):
        return spark.range(n).select(
            F.pmod(F.hash("id", F.lit(seed)), F.lit(50)).alias("k"), F.col("id").alias("v")
        )

    a, b = source(1, 40), source(2, 400)
    best = ranking.prefer([a, b], ["k"], ["v"]).collect()
    in_a = {r.k: min(x.v for x in a.collect() if x.k == r.k) for r in a.collect()}
    assert len({r.k for r in best}) == len(best)
    for r in best:
        if r.k in in_a:
            assert (r.source_priority, r.v) == (1, in_a[r.k])
        else:
            assert r.source_priority == 2


def hot_table(spark, n=3000):
    """A third of the rows under key 0, the rest spread, some without a key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(
        1 + F.col("id") % 100
    )
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"))


def test_salted_join_equals_plain_join(spark):
    fact = hot_table(spark)
    other = spark.range(60).select(
        F.col("id").alias("k"), F.concat(F.lit("o"), "id").alias("name")
    ).unionByName(spark.createDataFrame([(0, "again")], "k bigint, name string"))
    assert HotKeys(fact, ["k"], floor=500, per_part=100).rows.count() == 1
    assert HotKeys(fact, ["k"]).rows is None
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = fact.join(other, ["k"], how)
        salted = salted_join(fact, other, ["k"], how, floor=500, per_part=100)
        assert plain.columns == salted.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salt_spreads_the_hot_key(spark):
    fact = hot_table(spark)
    spread = HotKeys(fact, ["k"], floor=500, per_part=100).spread(fact)
    counts = spread.filter("k = 0").groupBy("_salt").count().collect()
    assert len(counts) == 10 and max(r["count"] for r in counts) < 200


def test_parts_keep_every_child_of_a_hot_parent(spark):
    rows = hot_table(spark).filter("k is not null")
    nested = nest_lists({"kids": ChildList(rows, ["v"], ["v"])}, "k", part_rows=50)
    parts = nested.collect()
    assert max(len(r.kids) for r in parts) == 50
    assert {r.parts for r in parts if r.k == 0} == {20}
    hot = sorted((r for r in parts if r.k == 0), key=lambda r: r.part_no)
    assert [kid.v for r in hot for kid in r.kids] == sorted(kid.v for r in hot for kid in r.kids)
    assert [(p.pos, p.v) for p in places(nested.filter("k = 0"), "kids", 50).orderBy("pos").select(
        "pos", "col.v").collect()] == list(enumerate(kid.v for r in hot for kid in r.kids))
    flat = sorted((r.k, kid.v) for r in parts for kid in r.kids)
    assert flat == sorted(tuple(r) for r in rows.collect())
    whole = nest_lists({"kids": ChildList(rows, ["v"], ["v"])}, "k", part_rows=None).collect()
    assert all([kid.v for kid in r.kids] == sorted(kid.v for kid in r.kids) for r in whole)


def test_two_lists_share_their_parts(spark):
    a = spark.range(25).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    b = spark.range(3).select(F.lit(2).alias("k"), F.col("id").alias("y"))
    nested = nest_lists(
        {"xs": ChildList(a, ["x"], ["x"]), "ys": ChildList(b, ["y"], ["y"])}, "k", part_rows=10
    ).collect()
    assert sorted(e.x for r in nested for e in r.xs or []) == list(range(25))
    assert [[e.y for e in r.ys] for r in nested if r.ys] == [[0, 1, 2]]
    assert all(r.ys is None for r in nested if r.k == 1)


def test_item_documents_do_not_depend_on_partitioning(spark):
    columns = (
        "ProductName ProductIsActive ProductGroupCode ShortDesc DetailedDesc CategoryName StyleCode "
        "SizeCode DivisionCode UOM AttributeSetName SizeGroup HSNCode Brand SalPackUn ColorName "
        "Color Shade"
    ).split()
    rows = spark.range(200).select(
        (F.col("id") % 9).cast("string").alias("ProductCode"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("ColorCode"),
        *[F.concat(F.lit(c), F.col("id") % 5).alias(c) for c in columns],
        (F.col("id") % 3).alias("Min_Qty"),
        (F.col("id") % 2).alias("Max_Qty"),
        F.lit(0).alias("IsCoreColor"),
        (F.col("id") % 6).cast("decimal(10,2)").alias("TaxBelow"),
        F.lit(None).cast("decimal(10,2)").alias("TaxAbove"),
        F.lit("s").alias("SubBrandCode"),
        "id",
    )

    def documents(n):
        docs = item_documents(rows.repartition(n, F.rand(n)), Rules(), order=["id"])
        return sorted(str(r) for r in docs.collect())

    assert documents(1) == documents(7)


def test_distinct_children_takes_the_first(spark):
    rows = hot_table(spark).filter("k is not null").withColumn("c", F.col("v") % 5)
    got = distinct_children(rows, "k", ["c"], ["v"]).collect()
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: r.v):
        expected.setdefault((r.k, r.c), r.v)
    assert {(r.k, r.c): r.v for r in got} == expected


def test_exists_any_never_multiplies(spark):
    df = spark.range(20)
    left = spark.range(10).union(spark.range(5))
    right = spark.range(8, 12).union(spark.range(8, 12))
    found = joins.where_exists_any(df, [(left, ["id"]), (right, ["id"])])
    assert sorted(r.id for r in found.collect()) == list(range(12))


def test_snapshots_versions(spark, tmp_path):
    store = state.Snapshots(spark, str(tmp_path / "s"), RECORD_STATUS)
    assert store.version() == 0 and store.read().count() == 0
    keys = spark.createDataFrame([("a",), ("b",)], "record_key string")
    for n in (1, 2):
        store.write(state.mark_in_flight(store.read(), keys, "m", moment("2026-01-01 00:00:00")))
        assert store.version() == n and store.read().count() == 2


def test_changed_records_sees_nulls(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (3, "y"), (4, None)], "id int, v string")
    changed = state.changed_records(new, old, "id")
    assert sorted(r.id for r in changed.collect()) == [2, 3, 4]


def test_many_hot_keys_are_all_spread(spark):
    keys = spark.range(1500).select(F.col("id").alias("k"))
    fact = keys.crossJoin(spark.range(20).select(F.col("id").alias("v")))
    other = keys.withColumn("x", F.col("k") * 2)
    hot = HotKeys(fact, ["k"], floor=10, per_part=5)
    assert hot.rows.count() == 1500
    joined = salted_join(fact, other, ["k"], floor=10, per_part=5)
    assert joined.count() == 30_000 and joined.filter("x <> 2 * k").count() == 0


def test_pages_agree_at_every_depth(spark):
    rows = spark.range(997).select(F.col("id").alias("k")).repartition(7)
    for page in (1, 2, 7, 50, 100, 101):
        near = [r.k for r in page_of(rows, ["k"], page, 10).collect()]
        assert near == [r.k for r in far_page(rows, ["k"], page, 10).collect()]


def test_listed_values_without_trailing_blanks(spark):
    rows = spark.createDataFrame([("A ",), ("B",), (None,)], "c string")
    assert [r.c for r in exclude_values(rows, "c", ["A"], trimmed=True).collect()] == ["B"]
    assert [r.c for r in include_values(rows, "c", ["A  "], trimmed=True).collect()] == ["A "]
    assert exclude_values(rows, "c", ["A"]).count() == 2


def test_push_run_aborts_and_judges_what_was_sent(spark, tmp_path):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    store = StatusStore(spark, str(tmp_path / "state"), buckets=4)
    source = {"rows": [("a",), ("b",)]}

    def extract(keys):
        rows = spark.createDataFrame(source["rows"], "code string")
        return rows.join(keys, rows.code == keys.record_key, "left_semi")

    def states():
        return {r.record_key: (r.push_status, r.error_message) for r in store.read().collect()}

    def make(document):
        return PushRun("stock", store, extract, document, "code", "code", 1)

    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "record_key string")
    run = make(lambda df: df)
    run.send(keys, str(tmp_path / "one"), now)
    source["rows"] = [("c",)]
    replies = spark.createDataFrame([(1, True, None), (2, False, "bad")], "batch_no long, ok boolean, error_message string")
    make(None).finish(str(tmp_path / "one"), replies, now)  # as a new process would
    assert states() == {"a": ("Pushed", None), "b": ("Failed", "bad"), "c": ("Failed", NOT_FOUND_TEXT)}

    def broken(df):
        raise ValueError("no mapping")

    with pytest.raises(ValueError, match="no mapping"):
        make(broken).send(keys, str(tmp_path / "two"), now)
    assert set(states().values()) == {("Failed", "no mapping")}
    records = spark.createDataFrame([("c", "x"), ("d", "y")], "code string, grp string")
    spec = FilterSpec(group="x", columns={"group": "grp"})
    make(lambda df: df).push_all(records, spec, "code", str(tmp_path / "three"), now)
    assert states()["c"] == ("Pushing", None) and "d" not in states()


def test_snapshots_of_other_parts_stay_untouched(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"), "k string, v int")
    store.write(spark.createDataFrame([("a", 1)], store.schema), "x")
    store.write(spark.createDataFrame([("b", 2)], store.schema), "y")
    before = store.folders()
    store.write(spark.createDataFrame([("b", 3)], store.schema), "y")
    after = store.folders()
    assert after["x"] == before["x"] and after["y"] != before["y"] and store.version() == 3
    assert sorted(map(tuple, store.read().collect())) == [("a", 1), ("b", 3)]
    assert [tuple(r) for r in store.read("x").collect()] == [("a", 1)]

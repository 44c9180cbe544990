"""Streams against the batch form of the same work."""

import json
import random

from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.plans.attendance import new_punches
from outledger.sources.schemas import PUNCH_LOG
from outledger.streaming import punches as streams
from outledger.streaming.replies import NO_REPLY, judged

def now():
    return moment("2026-02-01 00:00:00")


def make_punches(n=400, seed=3):
    rnd = random.Random(seed)
    return [
        {
            "ref_id": i,
            "employee_id": rnd.choice([None, "", "E1", "E2", "E3"]),
            "punch_type": rnd.choice("IO"),
            "punch_time": f"2026-01-{rnd.randint(10, 14)}T{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00",
        }
        for i in range(n)
    ]


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def columns(df):
    return sorted(
        (r.employee_id, r.punch_type, str(r.punch_time), str(r.ref_id))
        for r in df.select("employee_id", "punch_type", "punch_time", "ref_id").collect()
    )


def run(spark, tmp_path):
    stream = streams.punch_files(spark, str(tmp_path / "in"), files_per_batch=1)
    query = streams.ingest_stream(stream, str(tmp_path / "log"), str(tmp_path / "cp"), now())
    query.awaitTermination()
    return streams.read_log(spark, str(tmp_path / "log"))


def test_ingest_equals_batch_replay_and_restarts_cleanly(spark, tmp_path):
    punches = make_punches()
    parts = [punches[:150], punches[150:300]]
    expected = spark.createDataFrame([], PUNCH_LOG)
    for i, part in enumerate(parts):
        land(tmp_path / "in", f"{i}.json", part)
        batch = spark.read.schema(streams.PUNCH).json(str(tmp_path / "in" / f"{i}.json"))
        fresh = new_punches(batch, expected, now()).withColumn("ref_id", F.col("ref_id").cast("string"))
        rows = [*expected.collect(), *fresh.collect()]
        expected = spark.createDataFrame(rows, PUNCH_LOG)
        assert columns(run(spark, tmp_path)) == columns(expected)
    # nothing new: a restart from the checkpoint adds nothing
    assert columns(run(spark, tmp_path)) == columns(expected)
    # a lost checkpoint replays everything, which the log absorbs
    stream = streams.punch_files(spark, str(tmp_path / "in"))
    streams.ingest_stream(stream, str(tmp_path / "log"), str(tmp_path / "cp2"), now()).awaitTermination()
    assert columns(streams.read_log(spark, str(tmp_path / "log"))) == columns(expected)


def test_replayed_batch_fills_a_partial_write(spark, tmp_path):
    land(tmp_path / "in", "a.json", make_punches(100))
    batch = spark.read.schema(streams.PUNCH).json(str(tmp_path / "in"))
    streams.ingest_batch(batch.filter("employee_id = 'E1'"), str(tmp_path / "log"), now())
    streams.ingest_batch(batch, str(tmp_path / "log"), now())
    streams.ingest_batch(batch, str(tmp_path / "log"), now())
    expected = new_punches(batch, spark.createDataFrame([], PUNCH_LOG), now())
    assert columns(streams.read_log(spark, str(tmp_path / "log"))) == columns(expected)


def test_empty_batch_writes_nothing(spark, tmp_path):
    streams.ingest_batch(spark.createDataFrame([], streams.PUNCH), str(tmp_path / "log"), now())
    assert not (tmp_path / "log").exists()


def test_dedupe_keeps_one_per_person_kind_and_day(spark, tmp_path):
    punches = make_punches(200)
    land(tmp_path / "in", "a.json", punches)
    stream = streams.dedupe_stream(streams.punch_files(spark, str(tmp_path / "in")))
    streams.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    keys = {
        (p["employee_id"], p["punch_type"], p["punch_time"][:10])
        for p in punches
        if p["employee_id"] is not None
    }
    assert got.count() == len(keys)


def test_daily_counts_follow_new_files(spark, tmp_path):
    schema = "punch_type string, push_status string, punch_time timestamp_ntz"
    for i in range(2):
        spark.range(30).select(
            F.when(F.col("id") % 2 == 0, "I").otherwise("O").alias("punch_type"),
            F.lit("Pending").alias("push_status"),
            moment("2026-01-15 10:00:00").alias("punch_time"),
        ).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.changes_to(
            streams.daily_counts(arriving), str(tmp_path / "out"), str(tmp_path / "cp")
        ).awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "out"))
    keys = ["punch_day", "punch_type", "push_status"]
    now = streams.latest_changes(changes, keys, "n").collect()
    assert {(r.punch_type, r.n) for r in now} == {("I", 30), ("O", 30)}


def test_rejected_punches_are_stored_and_counted(spark, tmp_path):
    rows = make_punches(60)
    land(tmp_path / "in", "a.json", rows[:30])
    land(tmp_path / "in", "b.json", rows[30:])
    log = run(spark, tmp_path)
    rejected_path, counts_path = streams.side_paths(str(tmp_path / "log"))
    rejected = spark.read.parquet(rejected_path)
    bad = [r for r in rows if not r["employee_id"]]
    assert sorted(r.ref_id for r in rejected.collect()) == sorted(r["ref_id"] for r in bad)
    assert {r.reason for r in rejected.select("reason").collect()} == {"employee_id"}
    counts = spark.read.parquet(counts_path).orderBy("batch").collect()
    assert sum(r.arrived for r in counts) == 60 and sum(r.rejected for r in counts) == len(bad)
    assert sum(r.inserted for r in counts) == log.count()
    assert all(r.arrived == r.rejected + r.inserted + r.duplicate for r in counts)


def test_counts_and_dedupe_take_late_files(spark, tmp_path):
    day = lambda d, i, who="E1": {
        "ref_id": i, "employee_id": who, "punch_type": "I", "punch_time": f"2026-01-{d:02d}T08:00:00"
    }
    arrivals = [[day(20, 1), day(21, 2)], [day(2, 3), day(20, 4)], [day(2, 5), day(2, 6, "E2")]]
    for i, rows in enumerate(arrivals):
        land(tmp_path / "in", f"{i}.json", rows)
        stream = streams.punch_files(spark, str(tmp_path / "in"), files_per_batch=1)
        query = streams.dedupe_to(
            stream, str(tmp_path / "out"), str(tmp_path / "late"), str(tmp_path / "cp1")
        )
        query.awaitTermination()
        stream = streams.punch_files(spark, str(tmp_path / "in"), files_per_batch=1)
        counts = streams.daily_counts(stream.withColumn("push_status", F.lit("Pending")))
        streams.changes_to(counts, str(tmp_path / "n"), str(tmp_path / "cp2")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.ref_id for r in kept.collect()) == [1, 2, 3, 6]
    late = spark.read.parquet(str(tmp_path / "late"))
    assert sorted(r.ref_id for r in late.collect()) == [3, 4, 5, 6]
    changes = spark.read.parquet(str(tmp_path / "n"))
    latest = streams.latest_changes(changes, ["punch_day", "punch_type", "push_status"], "n")
    assert sorted((r.punch_day.day, r.n) for r in latest.collect()) == [(2, 3), (20, 2), (21, 1)]


def test_replies_in_time_late_and_none(spark, tmp_path):
    sent_schema = "batch_no long, sent_at timestamp_ntz"
    reply_schema = "batch_no long, replied_at timestamp_ntz, ok boolean, error_message string"
    at = lambda minute, second=0: f"2026-01-01 10:{minute:02d}:{second:02d}"

    def step(name, sent, replies):
        land(tmp_path / "sent", f"{name}.json", [{"batch_no": b, "sent_at": t} for b, t in sent])
        rows = [{"batch_no": b, "replied_at": t, "ok": ok, "error_message": e} for b, t, ok, e in replies]
        land(tmp_path / "replies", f"{name}.json", rows)
        results = judged(
            spark.readStream.schema(sent_schema).json(str(tmp_path / "sent")),
            spark.readStream.schema(reply_schema).json(str(tmp_path / "replies")),
        )
        streams.append_to(results, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=str)

    first = step("a", [(1, at(0)), (2, at(0)), (3, at(0)), (4, at(0))], [(1, at(0, 5), True, None), (2, at(0, 30), False, "bad")])
    assert first == [(1, True, None), (2, False, "bad")]  # 3 and 4 still wait
    last = step("b", [(5, at(9))], [(3, at(0, 40), True, None), (5, at(9, 1), True, None)])
    late = (False, NO_REPLY)
    assert last == [(1, True, None), (2, False, "bad"), (3, *late), (4, *late), (5, True, None)]


def test_counts_and_late_rows_survive_a_replay(spark, tmp_path):
    rows = make_punches(80)
    land(tmp_path / "in", "a.json", rows[:40])
    land(tmp_path / "in", "b.json", rows[40:])
    log = str(tmp_path / "log")
    stream = lambda: streams.punch_files(spark, str(tmp_path / "in"), files_per_batch=1)
    counts = lambda: sorted(map(tuple, streams.run_counts(spark, log).select(
        "batch", "arrived", "rejected", "inserted", "duplicate").collect()))
    streams.ingest_stream(stream(), log, str(tmp_path / "cp"), now()).awaitTermination()
    before, kept = counts(), columns(streams.read_log(spark, log))
    streams.ingest_stream(stream(), log, str(tmp_path / "cp2"), now()).awaitTermination()  # both batches again
    assert counts() == before and columns(streams.read_log(spark, log)) == kept
    assert sum(c[1] for c in before) == 80 and sum(c[3] for c in before) == len(kept)

    late = str(tmp_path / "late")
    for checkpoint in ("cp3", "cp4"):
        streams.dedupe_to(stream(), str(tmp_path / "out"), late, str(tmp_path / checkpoint)).awaitTermination()
        found = sorted(r.ref_id for r in spark.read.parquet(late).collect())
        if checkpoint == "cp3":
            first = found
    assert found == first

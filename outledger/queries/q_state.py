"""Keyed state and status tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.fixed_values import DATASETS
from outledger.functions.dates import moment
from outledger.operators import state
from outledger.operators.status_store import StatusStore
from outledger.plans import attendance, dashboard
from outledger.queries.q_aggregates import partner_states
from outledger.queries.q_files import own_folder
from outledger.queries.registry import query
from outledger.queries.views import views
from outledger.sources.schemas import BOARD

_c = F.col
CUT = "2024-01-15 00:00:00"
NOW = "2024-02-01 00:00:00"


def _status_rows(df):
    return df.select(
        "record_key", "push_status", "last_pushed_at", "error_message", "updated_at"
    )


def _early_state(v):
    early = v("si_status_event").filter(_c("ts") < moment(CUT))
    folded = state.fold_events(early, "record_key", ["seq"], "status", "ts", "error")
    return folded.select(F.lit("partners").alias("master_type"), *folded.columns)


def _late_updates(v):
    late = v("si_status_event").filter(_c("ts") >= moment(CUT))
    final = _c("status").isin("Pushed", "Failed")
    return late.select(
        F.lit("partners").alias("master_type"),
        _c("record_key").cast("string").alias("record_key"),
        _c("status").alias("push_status"),
        F.when(final, _c("ts")).alias("last_pushed_at"),
        _c("error").alias("error_message"),
        _c("ts").alias("updated_at"),
        "seq",
    )


def _stored(spark, rows):
    """A store of 16 buckets that holds the given rows."""
    store = StatusStore(spark, f"{own_folder(spark)}/state", buckets=16)
    store.upsert(rows.withColumn("record_key", _c("record_key").cast("string")), "partners")
    return store


_STATE_SQL = """early as (select cast(record_key as varchar) as k, arg_max(status, seq) as st,
 max(ts) filter (status in ('Pushed','Failed')) as pushed,
 nullif(arg_max(coalesce(error,''), seq),'') as err, max(ts) as upd
 from si_status_event where ts<timestamp '2024-01-15' group by 1),
 late as (select cast(record_key as varchar) as k, arg_max(status, seq) as st,
 {pushed} as pushed, nullif(arg_max(coalesce(error,''), seq),'') as err,
 arg_max(ts, seq) as upd
 from si_status_event where ts>=timestamp '2024-01-15' group by 1)
 select coalesce(l.k,e.k) as record_key, coalesce(l.st,e.st) as push_status,
 strftime(coalesce(l.pushed,e.pushed),'%Y-%m-%d %H:%M:%S') as last_pushed_at,
 case when l.k is null then e.err else l.err end as error_message,
 strftime(coalesce(l.upd,e.upd),'%Y-%m-%d %H:%M:%S') as updated_at
 from early e full join late l on e.k=l.k"""


@query(
    "upsert_status",
    "with "
    + _STATE_SQL.format(
        pushed="case when arg_max(status,seq) in ('Pushed','Failed') then arg_max(ts,seq) end"
    ),
    "si_status_event",
)
def upsert_status(spark, folder):
    v = views(spark, folder)
    last = state.latest_per_record(_late_updates(v), ["master_type", "record_key"], "seq")
    store = _stored(spark, _early_state(v))
    store.upsert(last, "partners")
    return _status_rows(store.read("partners"))


@query(
    "bulk_upsert",
    "with " + _STATE_SQL.format(pushed="max(ts) filter (status in ('Pushed','Failed'))"),
    "si_status_event",
)
def bulk_upsert(spark, folder):
    v = views(spark, folder)
    store = _stored(spark, _early_state(v))
    store.store_results(_late_updates(v), "partners", "seq")
    return _status_rows(store.read("partners"))


@query(
    "mark_in_flight",
    """select coalesce(record_key, k) as record_key,
    case when k is not null then 'Pushing' else push_status end as push_status,
    strftime(last_pushed_at,'%Y-%m-%d %H:%M:%S') as last_pushed_at,
    case when k is null then error_message end as error_message,
    strftime(case when k is not null then timestamp '2024-02-01' else updated_at end,
    '%Y-%m-%d %H:%M:%S') as updated_at from si_status full join
    (select cast(bp_id as varchar) as k from si_partner where grp='BUILDING') on record_key=k""",
    "si_status si_partner",
)
def mark_in_flight(spark, folder):
    v = views(spark, folder)
    current = v("si_status").withColumn("master_type", F.lit("partners"))
    keys = v("si_partner").filter("grp = 'BUILDING'").select(
        _c("bp_id").cast("string").alias("record_key")
    )
    store = _stored(spark, current.select("master_type", *_status_rows(current).columns))
    store.mark_in_flight(keys, "partners", moment(NOW))
    return _status_rows(store.read("partners"))


@query(
    "status_counts",
    """select case when k is not null then 'Pushing' else push_status end as push_status, count(*) as n
    from si_status full join (select cast(bp_id as varchar) as k from si_partner where grp='BUILDING')
    on record_key=k group by 1""",
    "si_status si_partner",
)
def status_counts(spark, folder):
    v = views(spark, folder)
    current = v("si_status").withColumn("master_type", F.lit("partners"))
    store = _stored(spark, current.select("master_type", *_status_rows(current).columns))
    keys = v("si_partner").filter("grp = 'BUILDING'").select(_c("bp_id").cast("string").alias("record_key"))
    store.mark_in_flight(keys, "partners", moment(NOW))
    return store.status_counts("partners")


@query(
    "status_transition",
    """select record_key, push_status, strftime(last_pushed_at,'%Y-%m-%d %H:%M:%S')
    as last_pushed_at, error_message, strftime(updated_at,'%Y-%m-%d %H:%M:%S') as updated_at
    from si_status""",
    "si_status",
)
def status_transition(spark, folder):
    events = views(spark, folder)("si_status_event")
    return _status_rows(
        state.fold_events(events, "record_key", ["seq"], "status", "ts", "error")
    )


@query(
    "status_overlay",
    """select bp_id, coalesce(push_status,'Pending') as push_status, error_message,
    strftime(last_pushed_at,'%Y-%m-%d %H:%M:%S') as last_pushed_at from si_partner
    left join si_status on cast(bp_id as varchar)=record_key""",
    "si_partner si_status",
)
def status_overlay(spark, folder):
    return partner_states(views(spark, folder)).select(
        "bp_id", "push_status", "error_message", "last_pushed_at"
    )


def _board(v):
    """A board that knows three of the datasets, as earlier runs left them."""
    runs = v("si_batch").filter("sync_type in ('products', 'schemes', 'outstanding')")
    known = runs.groupBy("sync_type").agg(F.count_if("ok").alias("success_count")).select(
        "sync_type", F.upper("sync_type").alias("display_name"), "success_count"
    )
    empty = v("region").sparkSession.createDataFrame([], BOARD)
    return empty.unionByName(known, allowMissingColumns=True)


_BOARD_SQL = """(select t as sync_type, coalesce(upper(k), n) as display_name, ord,
 case when k is null then false end as is_pushed, done as success_count from
 (values ('products','Product Master',1),('pricelists','Price Lists',2),
 ('images','Product Images',3),('schemes','Schemes / Promotions',4),
 ('businesspartners','Business Partners',5),('stockInventory','Stock Inventory',6),
 ('outstanding','Outstanding / Receivables',7)) d(t,n,ord) left join
 (select sync_type as k, count(*) filter (ok) as done from si_batch
 where sync_type in ('products','schemes','outstanding') group by 1) on k=t)"""


@query(
    "dashboard_seed",
    f"select sync_type, display_name, is_pushed, success_count from {_BOARD_SQL}",
    "si_batch",
)
def dashboard_seed(spark, folder):
    seeded = state.board_seed(_board(views(spark, folder)), DATASETS, moment(NOW))
    return seeded.select("sync_type", "display_name", "is_pushed", "success_count")


@query(
    "dashboard_list",
    f"select sync_type, display_name, success_count from {_BOARD_SQL} order by ord",
    "si_batch",
)
def dashboard_list(spark, folder):
    seeded = state.board_seed(_board(views(spark, folder)), DATASETS, moment(NOW))
    return state.board_list(seeded, DATASETS).select(
        "sync_type", "display_name", "success_count"
    )


_RESULT_SQL = """(select sync_type as rt, count(*) as nb, sum(size)::bigint as total,
 coalesce(sum(size) filter (ok),0)::bigint as good, coalesce(sum(size) filter (not ok),0)::bigint
 as bad, count(*) filter (ok) as okb, count(*) filter (not ok) as badb from si_batch group by 1)"""


@query(
    "dashboard_update",
    f"""select sync_type, coalesce(okb>0 or badb=0, is_pushed) as is_pushed,
    case when rt is not null then case when okb>0 or badb=0 then 'Success' else 'Failed' end end
    as last_status, total as total_records, case when rt is not null then good
    else success_count end as success_count, bad as failed_count,
    case when okb=0 and badb>0 then 'All '||badb||' batch(es) failed.' end as error_message
    from {_BOARD_SQL} left join {_RESULT_SQL} on rt=sync_type""",
    "si_batch",
)
def dashboard_update(spark, folder):
    v = views(spark, folder)
    seeded = state.board_seed(_board(v), DATASETS, moment(NOW))
    results = dashboard.run_results(v("si_batch"))
    return state.board_result(seeded, results, moment(NOW)).select(
        "sync_type",
        "is_pushed",
        "last_status",
        "total_records",
        "success_count",
        "failed_count",
        "error_message",
    )


@query(
    "update_by_ids",
    """select id, employee_id, case when id in (select ref_id from si_punch where emp_id is null)
    then 'Failed' else push_status end as push_status from si_punch_log""",
    "si_punch_log si_punch",
)
def update_by_ids(spark, folder):
    v = views(spark, folder)
    ids = v("si_punch").filter("emp_id is null").select(_c("ref_id").alias("id"))
    log = v("si_punch_log").select("id", "employee_id", "push_status")
    return state.update_by_ids(log, ids, "id", "Failed")


_DAYS_SQL = """select 'JOB_'||cast(capture_time as date) as job_key, min(punch_type) as punch_type,
 min(capture_time) as last_triggered_at, max(capture_time) as last_completed_at,
 case when count(*) filter (push_status='Failed')>0 then 'CompletedWithErrors'
 else 'Completed' end as last_status, max(capture_time) as updated_at from si_punch_log"""


@query(
    "job_log_upsert",
    f"""with a as ({_DAYS_SQL} where capture_time<timestamp '2024-01-20 12:00:00' group by 1),
    b as ({_DAYS_SQL} where capture_time>=timestamp '2024-01-15' group by 1)
    select coalesce(b.job_key,a.job_key) as job_key, coalesce(a.punch_type,b.punch_type)
    as punch_type, strftime(coalesce(b.last_triggered_at,a.last_triggered_at),
    '%Y-%m-%d %H:%M:%S') as last_triggered_at, strftime(coalesce(b.last_completed_at,
    a.last_completed_at),'%Y-%m-%d %H:%M:%S') as last_completed_at,
    coalesce(b.last_status,a.last_status) as last_status, strftime(coalesce(b.updated_at,
    a.updated_at),'%Y-%m-%d %H:%M:%S') as updated_at from a full join b on a.job_key=b.job_key""",
    "si_punch_log",
)
def job_log_upsert(spark, folder):
    log = views(spark, folder)("si_punch_log")

    def jobs(rows):
        day = F.concat(F.lit("JOB_"), F.to_date("capture_time").cast("string"))
        failed = F.count_if(_c("push_status") == "Failed")
        return rows.groupBy(day.alias("job_key")).agg(
            F.min("punch_type").alias("punch_type"),
            F.min("capture_time").alias("last_triggered_at"),
            F.max("capture_time").alias("last_completed_at"),
            state.job_status(failed).alias("last_status"),
            F.max("capture_time").alias("updated_at"),
        )

    earlier = jobs(log.filter(_c("capture_time") < moment("2024-01-20 12:00:00")))
    later = jobs(log.filter(_c("capture_time") >= moment("2024-01-15 00:00:00")))
    return state.job_log_upsert(earlier, later)


@query(
    "pending_queue",
    """select id, employee_id, push_status from si_punch_log where punch_type='I'
    and push_status in ('Pending','Failed') order by punch_time, id""",
    "si_punch_log",
)
def pending_queue(spark, folder):
    queue = state.pending_queue(views(spark, folder)("si_punch_log"), "I", "punch_time", "id")
    return queue.select("id", "employee_id", "push_status")


@query(
    "unprocessed_to_failed",
    """select id, case when punch_type='I' and push_status in ('Pending','Failed')
    and id not in (select request_id from si_response) then 'Failed' else push_status end
    as push_status from si_punch_log""",
    "si_punch_log si_response",
)
def unprocessed_to_failed(spark, folder):
    v = views(spark, folder)
    log = v("si_punch_log")
    fetched = state.pending_queue(log, "I")
    processed = v("si_response").select(_c("request_id").alias("id")).distinct()
    return state.unprocessed_to_failed(log, fetched, processed, "id").select("id", "push_status")


@query(
    "snapshot_delta",
    """select * from (select l_partkey as item_id, l_suppkey%3 as whs,
    cast(sum(cast(l_quantity as decimal(12,2))) as double) as on_hand from lineitem group by all)
    except select l_partkey, l_suppkey%3, cast(sum(cast(l_quantity as decimal(12,2))) as double)
    from lineitem where l_shipdate<timestamp '2001-01-01' group by all""",
)
def snapshot_delta(spark, folder):
    lines = views(spark, folder)("lineitem")

    def stock(rows):
        return rows.groupBy(
            F.concat_ws(":", "l_partkey", (_c("l_suppkey") % 3).cast("string")).alias("key"),
            _c("l_partkey").alias("item_id"),
            (_c("l_suppkey") % 3).alias("whs"),
        ).agg(F.sum(_c("l_quantity").cast("decimal(12,2)")).alias("on_hand"))

    previous = stock(lines.filter(_c("l_shipdate") < moment("2001-01-01 00:00:00")))
    return state.changed_records(stock(lines), previous, "key").drop("key")


@query(
    "push_pending",
    """select id, case when punch_type='O' and push_status in ('Pending','Failed') then
    case when final between 200 and 299 then 'Pushed' else 'Failed' end else push_status end
    as push_status from si_punch_log left join (select request_id,
    coalesce(arg_min(http_status, attempt) filter (http_status between 200 and 499),
    arg_max(http_status, attempt)) as final from si_response group by 1) on id=request_id""",
    "si_punch_log si_response",
)
def push_pending(spark, folder):
    v = views(spark, folder)
    log = v("si_punch_log")
    queue = state.pending_queue(log, "O")
    attempts = v("si_response").withColumn("ref_id", _c("request_id").cast("string"))
    outcomes = attendance.push_outcomes(queue, attempts)
    return attendance.apply_outcomes(log, outcomes).select("id", "push_status")


@query(
    "punch_record",
    """select ref_id, employee_id as "EmployeeId", punch_type as "PunchType",
    strftime(punch_time,'%Y-%m-%dT%H:%M:%S') as "PunchTime",
    strftime(capture_time,'%Y-%m-%dT%H:%M:%S') as "CaptureDateTime" from si_punch_log""",
    "si_punch_log",
)
def punch_record(spark, folder):
    return attendance.punch_records(views(spark, folder)("si_punch_log"))



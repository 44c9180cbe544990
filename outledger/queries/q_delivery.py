"""Response logs, outcomes and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.functions.text import composite_key
from outledger.operators import delivery
from outledger.operators.aggregates import delivery_counts
from outledger.operators.batching import assign_batches
from outledger.operators.filters import FilterSpec
from outledger.plans.push import freeze_keys
from outledger.queries.q_aggregates import _OK_SQL, partner_states
from outledger.queries.registry import query
from outledger.queries.views import views

_c = F.col


@query("classify_response", f"select seq, http_status, {_OK_SQL} as ok from si_response", "si_response")
def classify_response(spark, folder):
    replies = views(spark, folder)("si_response")
    return delivery.classify_response(replies).select("seq", "http_status", "ok")


def _fold_sql(ends: str, good: str) -> str:
    return f"""select request_id, u.attempt as attempts_used, u.http_status as http_status,
    {good} as ok, u.ended=0 and u.attempt>=3 as exhausted, logged-u.attempt as ignored_attempts
    from (select request_id, coalesce(arg_min(r, attempt) filter (ended=1), arg_max(r, attempt)) as u,
    max(attempt) as logged from (select request_id, attempt, ended, struct_pack(attempt:=attempt,
    http_status:=http_status, body:=body, ended:=ended) as r from (select *,
    case when {ends} then 1 else 0 end as ended from si_response)) group by request_id)"""


@query(
    "retry_fold",
    "select 'crm' as policy, * from ("
    + _fold_sql(
        "http_status between 200 and 299",
        _OK_SQL.replace("http_status", "u.http_status").replace("body", "u.body"),
    )
    + ") union all select 'hr', * from ("
    + _fold_sql("http_status between 200 and 299 or http_status between 400 and 499",
                "u.http_status between 200 and 299")
    + ")",
    "si_response",
)
def retry_fold(spark, folder):
    replies = views(spark, folder)("si_response")
    crm = delivery.retry_fold(replies, ["request_id"], 3, stop_on_4xx=False, check_body=True)
    hr = delivery.retry_fold(replies, ["request_id"], 3, stop_on_4xx=True, check_body=False)
    both = crm.withColumn("policy", F.lit("crm")).unionByName(
        hr.withColumn("policy", F.lit("hr"))
    )
    return both.drop("body")


@query(
    "retry_wait_report",
    "select run_day, sum((used-1)*used/2*1500)::bigint as wait_ms, sum(used-1)::bigint as retries, "
    "count(*) as requests from (select run_day, request_id, "
    "coalesce(min(attempt) filter (http_status between 200 and 299), max(attempt))::bigint as used "
    "from si_response group by all) group by run_day",
    "si_response",
)
def retry_wait_report(spark, folder):
    folded = delivery.retry_fold(
        views(spark, folder)("si_response"), ["run_day", "request_id"], 3, False, True
    )
    return delivery.wait_report(folded, ["run_day"], 1500, linear=True)


def _failures(v):
    """Failed replies, each carrying two record keys."""
    bad = delivery.classify_response(v("si_response")).filter(~_c("ok"))
    codes = F.array(_c("record_key"), _c("record_key") + 7)
    text = F.concat_ws(" ", F.lit("HTTP"), _c("http_status").cast("string"))
    return bad.select(codes.alias("codes"), text.alias("error"), "seq")


_FAILED_SQL = f"""(select k as record_key, arg_max(error, seq) as error_message from
 (select unnest([record_key, record_key+7]) as k, 'HTTP '||http_status as error, seq
 from si_response where not {_OK_SQL}) group by k)"""


@query(
    "reconcile_by_code",
    f"""select bp_id as record_key, f.record_key is null as success, error_message
    from (select distinct bp_id from si_partner) left join {_FAILED_SQL} f
    on bp_id=f.record_key""",
    "si_response si_partner",
)
def reconcile_by_code(spark, folder):
    v = views(spark, folder)
    failed = delivery.failed_keys_of(_failures(v), "codes", "error", "seq")
    requested = v("si_partner").select(_c("bp_id").alias("record_key"))
    return delivery.reconcile(requested, failed)


@query(
    "reconcile_by_prefix",
    f"""select cast(bp_id as varchar) as record_key, bp_id not in (select record_key
    from si_response where not {_OK_SQL}) as success, case when bp_id in (select record_key
    from si_response where not {_OK_SQL}) then 'Batch failed' end as error_message
    from si_partner""",
    "si_response si_partner",
)
def reconcile_by_prefix(spark, folder):
    v = views(spark, folder)
    bad = delivery.classify_response(v("si_response")).filter(~_c("ok"))
    children = bad.select(composite_key(_c("record_key"), _c("seq")).alias("child_key"))
    requested = v("si_partner").select(_c("bp_id").cast("string").alias("record_key"))
    return delivery.reconcile_by_prefix(requested, children)


@query(
    "reconcile_missing",
    f"""select record_key, fetched and mapped and not failed as success,
    case when not fetched then 'Record not found in DB' when not mapped
    then 'Mapper produced no output' when failed then error_message end as error_message from
    (select r.record_key, p.bp_id is not null as fetched, coalesce(p.area<>'', false) as mapped,
    f.record_key is not null as failed, f.error_message from
    (select distinct o_custkey+500 as record_key from orders) r
    left join si_partner p on p.bp_id=r.record_key left join {_FAILED_SQL} f
    on f.record_key=r.record_key)""",
    "si_response si_partner",
)
def reconcile_missing(spark, folder):
    v = views(spark, folder)
    requested = v("orders").select((_c("o_custkey") + 500).alias("record_key"))
    fetched = v("si_partner").select(_c("bp_id").alias("record_key"), "area")
    mapped = fetched.filter("area <> ''")
    failed = delivery.failed_keys_of(_failures(v), "codes", "error", "seq")
    return delivery.reconcile_missing(requested, fetched, mapped, failed)


@query(
    "error_text",
    """select seq, coalesce(case when http_status=500 then body end,
    '{"status":'||http_status||',"attempt":'||attempt||'}') as error_text from si_response""",
    "si_response",
)
def error_text(spark, folder):
    detail = F.struct(_c("http_status").alias("status"), "attempt")
    text = F.when(_c("http_status") == 500, _c("body"))
    return views(spark, folder)("si_response").select(
        "seq", delivery.error_text(text, detail).alias("error_text")
    )


@query(
    "run_outcome",
    """select sync_type, case when count(*) filter (ok)=0 then 'failed'
    when count(*) filter (not ok)>0 then 'completed with failures' else 'success' end as outcome
    from si_batch group by 1""",
    "si_batch",
)
def run_outcome(spark, folder):
    counts = delivery_counts(views(spark, folder)("si_batch"), ["sync_type"], "ok", "size")
    outcome = delivery.run_outcome(_c("success_batches"), _c("failed_batches"))
    return counts.select("sync_type", outcome.alias("outcome"))


@query(
    "push_all_snapshot",
    """select cast(bp_id as varchar) as record_key,
    (row_number() over (order by cast(bp_id as varchar))-1)//100+1 as chunk
    from si_partner left join si_status on cast(bp_id as varchar)=record_key
    where coalesce(push_status,'Pending')='Pending'""",
    "si_partner si_status",
)
def push_all_snapshot(spark, folder):
    spec = FilterSpec(status="Pending", columns={"status": "push_status"})
    keys = freeze_keys(partner_states(views(spark, folder)), spec, "bp_id")
    return assign_batches(keys, ["record_key"], 100).select(
        "record_key", _c("batch_no").alias("chunk")
    )

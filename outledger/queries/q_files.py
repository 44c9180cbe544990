"""Operators that read or write files: their input is first derived from the test tables.

Every run works in a folder of its own below the session's scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from outledger.fixed_values import BATCH_SIZES
from outledger.functions.dates import moment
from outledger.operators.batching import assign_batches, outbox_write
from outledger.operators.delivery import classify_response
from outledger.operators.nesting import ChildList, json_text, nest_lists
from outledger.operators.status_store import StatusStore
from outledger.plans import stock
from outledger.plans.push import PushRun
from outledger.queries.registry import query
from outledger.queries.sample_rules import RULES
from outledger.queries.views import erp, views
from outledger.session import scratch_dir
from outledger.sources.pages import PAGE, chain_faults, folder_of, linked_pages, page_records, read_pages
from outledger.streaming import punches as streams
from outledger.streaming.replies import NO_REPLY, judged

_c = F.col
NOW = "2024-02-01 00:00:00"


def own_folder(spark) -> str:
    """A new folder for one run."""
    return f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"


@query(
    "paged_json_source",
    """select cast(ref_id as varchar) as ref_id, cast(emp_id as varchar) as employee_id,
    strftime(punch_time,'%Y-%m-%d %H:%M:%S') as punch_time, case when punch_type='I'
    then 'Check-In' else 'Check-Out' end as type_name from si_punch""",
    "si_punch",
)
def paged_json_source(spark, folder):
    # One page per day of punches as a JSON line, the last day closing the extract.
    path = own_folder(spark)
    record = F.struct(
        _c("ref_id").cast("string").alias("Id"),
        F.struct(_c("emp_id").cast("string").alias("EmployeeId")).alias("related"),
        _c("punch_time").cast("string").alias("AttendenceTime"),
        F.when(_c("punch_type") == "I", "Check-In").otherwise("Check-Out").alias("Type"),
    )
    punches = views(spark, folder)("si_punch").withColumn("day", F.to_date("punch_time"))
    pages = nest_lists(
        {"records": ChildList(punches.withColumn("r", record), ["r"], ["ref_id"])}, "day"
    )
    # One extract a year of punches.
    body = linked_pages(pages, punches).select(
        F.year("day").alias("year"), "url", _c("next").isNull().alias("done"), _c("next").alias("nextRecordsUrl"),
        F.transform("records", lambda x: x["r"]).alias("records"),
    )
    body.write.partitionBy("year").json(path)
    landed = read_pages(spark, path, PAGE, page_per_file=False)
    if not chain_faults(landed, folder_of(landed)).isEmpty():
        raise RuntimeError("an extract is not complete")
    return page_records(landed)


@query(
    "page_chain_faults",
    """with p as (select distinct cast(punch_time as date) as d from si_punch), l as
    (select d, strftime(d,'%Y-%m') as extract, lead(d) over (partition by strftime(d,'%Y-%m') order by d) as n
    from p), k as (select *, day(d)<>15 as kept from l), f as (
    select extract, 'missing page' as fault, count(*) as n from k a where kept and exists
    (select 1 from k b where b.d=a.n and not b.kept) group by 1
    union all
    select extract, 'first pages', count(*) from k a where kept and not exists
    (select 1 from k b where b.n=a.d and b.kept) group by 1 having count(*)<>1
    union all
    select extract, 'final pages', count(*) filter (n is null) from k where kept group by 1
    having count(*) filter (n is null)<>1) select * from f""",
    "si_punch",
)
def page_chain_faults(spark, folder):
    # An extract a month, a page a day; the pages of the fifteenth got lost.
    days = views(spark, folder)("si_punch").select(F.to_date("punch_time").alias("day")).distinct()
    month = F.date_format("day", "yyyy-MM")
    following = F.lead("day").over(Window.partitionBy(month).orderBy("day"))
    pages = days.select(
        month.alias("extract"), "day", _c("day").cast("string").alias("url"),
        following.isNull().alias("done"), following.cast("string").alias("nextRecordsUrl"),
    )
    return chain_faults(pages.filter(F.dayofmonth("day") != 15), _c("extract"))


@query(
    "nest_keep_nulls",
    """select bp_id, '{"area":'||coalesce('"'||area||'"','null')||',"phone":'||
    coalesce('"'||phone2||'"','null')||'}' as kept, '{'||concat_ws(',', '"area":"'||area||'"',
    '"phone":"'||phone2||'"')||'}' as dropped from si_partner""",
    "si_partner",
)
def nest_keep_nulls(spark, folder):
    value = F.struct("area", _c("phone2").alias("phone"))
    return views(spark, folder)("si_partner").select(
        "bp_id",
        json_text(value, keep_nulls=True).alias("kept"),
        json_text(value, keep_nulls=False).alias("dropped"),
    )


_STOCK_SQL = """select ItemCode as code, (row_number() over (order by ItemCode)-1)//200+1
 as batch_no, trunc(OnHand)::double as quantity, row_number() over (order by ItemCode desc)=1
 as batch_end from erp_items join erp_stock using (ItemCode) where WhsCode='W0' and validFor='Y'
 and U_SubGrp1 not in ('Brand#3','Brand#7') and trunc(OnHand)>0"""


@query("outbox_write", _STOCK_SQL, "erp_items erp_stock")
def outbox_write_query(spark, folder):
    path = own_folder(spark)
    records = stock.stock_records(stock.stock_rows(erp(spark, folder), RULES))
    batches = assign_batches(records, ["ProductCode"], BATCH_SIZES["stockInventory"])
    content = F.struct(*records.columns)
    outbox_write(batches, path, "stockInventory", content, group_batches=4)
    schema = (
        "batch_no bigint, pos bigint, batch_end boolean, "
        "document struct<ProductCode:string, StockQuantity:double>, "
        "dataset string, batch_group bigint"
    )
    return spark.read.schema(schema).json(path).select(
        _c("document.ProductCode").alias("code"),
        "batch_no",
        _c("document.StockQuantity").alias("quantity"),
        "batch_end",
    )


@query(
    "push_run",
    f"""with sent as ({_STOCK_SQL.replace("U_SubGrp1 not in ('Brand#3','Brand#7') and trunc(OnHand)>0",
    "ItemCode in (select cast(l_partkey as varchar) from lineitem where l_discount>=0.1)")}),
    reply as (select batch_no, arg_max(http_status, seq) between 200 and 299 and not
    coalesce(contains(arg_max(coalesce(body,''), seq), 'errorCode') or
    contains(arg_max(coalesce(body,''), seq), 'false'), false) as ok,
    'HTTP '||arg_max(http_status, seq) as err from (select request_id+1 as batch_no, *
    from si_response) group by 1)
    select k as record_key, case when code is not null and coalesce(ok,true) then 'Pushed'
    else 'Failed' end as push_status, case when code is null then 'Record not found in DB'
    when not ok then err end as error_message from (select distinct cast(l_partkey as varchar) as k
    from lineitem where l_discount>=0.1) left join sent on code=k left join reply using (batch_no)""",
    "erp_items erp_stock si_response",
)
def push_run(spark, folder):
    path = own_folder(spark)
    v, t = views(spark, folder), erp(spark, folder)
    keys = v("lineitem").filter("l_discount >= 0.1").select(
        _c("l_partkey").cast("string").alias("record_key")
    ).distinct()
    store = StatusStore(spark, f"{path}/state", buckets=16)
    run = PushRun(
        "stockInventory",
        store,
        lambda wanted: stock.stock_rows_by_key(t, RULES, wanted),
        stock.stock_records,
        "ProductCode",
        "ProductCode",
        BATCH_SIZES["stockInventory"],
    )
    run.send(keys, f"{path}/outbox", moment(NOW))
    # The last reply of a request stands in for the reply of the batch of that number.
    last = v("si_response").groupBy("request_id").agg(
        F.max_by(F.struct("http_status", "body"), "seq").alias("r")
    )
    replies = classify_response(
        last.select((_c("request_id") + 1).alias("batch_no"), "r.http_status", "r.body")
    ).withColumn("error_message", F.concat_ws(" ", F.lit("HTTP"), _c("http_status").cast("string")))
    run.finish(f"{path}/outbox", replies, moment(NOW))
    return store.read().select("record_key", "push_status", "error_message")


def _land_punches(spark, folder) -> tuple[str, int]:
    """All punches as JSON files: their folder, and the number of files of a batch."""
    path = own_folder(spark)
    punches = views(spark, folder)("si_punch").select(
        "ref_id", _c("emp_id").cast("string").alias("employee_id"), "punch_type", "punch_time"
    )
    # A day lies in one file, hence in one batch: which punch of a day is kept depends on the batch.
    day = F.to_date("punch_time")
    return path, _in_files(spark, punches, day, "json", f"{path}/in")


def _in_files(spark, rows, key, kind, path) -> int:
    """Write rows with as many files as the session has shuffle partitions; half of them make a batch."""
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartition(parts, key).write.format(kind).save(path)
    return parts // 2


@query(
    "punch_ingest_stream",
    """select cast(emp_id as varchar) as employee_id, punch_type, cast(punch_time as date)
    as punch_day, cast(case when punch_type='I' then arg_min(ref_id, (punch_time, ref_id))
    else arg_max(ref_id, (punch_time, ref_id)) end as varchar) as ref_id,
    'Pending' as push_status from si_punch where emp_id is not null group by emp_id, punch_type,
    cast(punch_time as date)""",
    "si_punch",
)
def punch_ingest_stream(spark, folder):
    path, files = _land_punches(spark, folder)
    arrived = streams.punch_files(spark, f"{path}/in", files_per_batch=files)
    streams.ingest_stream(arrived, f"{path}/log", f"{path}/checkpoint", moment(NOW)).awaitTermination()
    return streams.read_log(spark, f"{path}/log").select(
        "employee_id", "punch_type", "punch_day", "ref_id", "push_status"
    )


@query(
    "stateful_dedupe_stream",
    """select distinct cast(emp_id as varchar) as employee_id, punch_type,
    cast(punch_time as date) as punch_day from si_punch where emp_id is not null""",
    "si_punch",
)
def stateful_dedupe_stream(spark, folder):
    path, files = _land_punches(spark, folder)
    arriving = streams.punch_files(spark, f"{path}/in", files_per_batch=files)
    run = streams.dedupe_to(arriving, f"{path}/out", f"{path}/late", f"{path}/checkpoint")
    run.awaitTermination()
    schema = f"{streams.PUNCH}, punch_day date"
    return spark.read.schema(schema).parquet(f"{path}/out").select(
        "employee_id", "punch_type", "punch_day"
    )


@query(
    "punch_run_counts",
    """select count(*) as arrived, count(*) filter (emp_id is null) as rejected,
    count(distinct (emp_id, punch_type, cast(punch_time as date))) filter (emp_id is not null) as inserted,
    count(*) - count(*) filter (emp_id is null) - count(distinct (emp_id, punch_type,
    cast(punch_time as date))) filter (emp_id is not null) as duplicate from si_punch""",
    "si_punch",
)
def punch_run_counts(spark, folder):
    path, files = _land_punches(spark, folder)
    arrived = streams.punch_files(spark, f"{path}/in", files_per_batch=files)
    streams.ingest_stream(arrived, f"{path}/log", f"{path}/checkpoint", moment(NOW)).awaitTermination()
    names = ["arrived", "rejected", "inserted", "duplicate"]
    return streams.run_counts(spark, f"{path}/log").agg(*[F.sum(c).alias(c) for c in names])


@query(
    "reply_timeouts",
    f"""select s.event_id as batch_no, r.event_id is not null and r.event_type<>'error' as ok,
    case when r.event_id is null then '{NO_REPLY}' when r.event_type='error' then 'HTTP 500' end as error_message
    from events s left join events r on r.event_id=s.event_id+1 and r.ts>=s.ts
    and r.ts<=s.ts+interval 10 day where s.event_type in ('click','view','signup')""",
)
def reply_timeouts(spark, folder):
    # Clicks, views and signups stand for sendings, the event after each for its reply.
    path = own_folder(spark)
    events = views(spark, folder)("events")
    sent = events.filter(_c("event_type").isin("click", "view", "signup")).select(
        _c("event_id").alias("batch_no"), _c("ts").alias("sent_at")
    )
    bad = _c("event_type") == "error"
    replies = events.select(
        (_c("event_id") - 1).alias("batch_no"), _c("ts").alias("replied_at"), (~bad).alias("ok"),
        F.when(bad, "HTTP 500").alias("error_message"),
    )
    far = moment("2100-01-01 00:00:00")  # a last row of both streams that closes every wait
    none = F.lit(-1).cast("bigint")  # a real key: null ones never reach the watermark
    ends = {
        "sent": spark.range(1).select(none.alias("batch_no"), far.alias("sent_at")),
        "replies": spark.range(1).select(
            none.alias("batch_no"), far.alias("replied_at"), F.lit(True).alias("ok"),
            F.lit(None).cast("string").alias("error_message"),
        ),
    }
    for name, rows in (("sent", sent), ("replies", replies)):
        rows.write.parquet(f"{path}/{name}")
    for _ in range(2):
        arriving = {
            name: spark.readStream.schema(end.schema).parquet(f"{path}/{name}") for name, end in ends.items()
        }
        results = judged(arriving["sent"], arriving["replies"], within="10 days", lateness="3650 days")
        streams.append_to(results, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        for name, end in ends.items():
            end.write.mode("append").parquet(f"{path}/{name}")
    return spark.read.schema(results.schema).parquet(f"{path}/out").filter("batch_no >= 0")


@query(
    "daily_status_stream",
    """select cast(punch_time as date) as punch_day, punch_type, push_status, count(*) as n
    from si_punch_log group by all""",
    "si_punch_log",
)
def daily_status_stream(spark, folder):
    path = own_folder(spark)
    log = views(spark, folder)("si_punch_log").select("punch_type", "push_status", "punch_time")
    files = _in_files(spark, log, "punch_time", "parquet", f"{path}/in")
    reader = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", str(files))
    arriving = reader.parquet(f"{path}/in")
    counts = streams.daily_counts(arriving)
    streams.changes_to(counts, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    keys = ["punch_day", "punch_type", "push_status"]
    schema = "punch_day date, punch_type string, push_status string, n bigint, batch bigint"
    changes = spark.read.schema(schema).parquet(f"{path}/out")
    return streams.latest_changes(changes, keys, "n")

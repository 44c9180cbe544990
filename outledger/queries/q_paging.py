"""Order, pages, totals, batches and end marks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from outledger.functions.choose import lookup
from outledger.operators import batching, paging
from outledger.operators.stored_list import store_list
from outledger.queries.q_aggregates import partner_states
from outledger.queries.registry import query
from outledger.queries.views import views
from outledger.session import run_dir

_c = F.col


@query(
    "total_over_all",
    "select scheme_id, basis, count(*) over () as total_count from si_scheme",
    "si_scheme",
)
def total_over_all(spark, folder):
    return paging.with_total(views(spark, folder)("si_scheme").select("scheme_id", "basis"))


@query(
    "order_by_keys",
    """select grp, bp_id, area from si_partner order by grp asc, area desc nulls last, bp_id""",
    "si_partner",
)
def order_by_keys(spark, folder):
    rows = views(spark, folder)("si_partner").select("grp", "bp_id", "area")
    return rows.orderBy("grp", F.desc_nulls_last("area"), "bp_id")


@query(
    "offset_page",
    "select item_id, item_name, brand from si_item order by item_id limit 50 offset 100",
    "si_item",
)
def offset_page(spark, folder):
    rows = views(spark, folder)("si_item").select("item_id", "item_name", "brand")
    return paging.page_of(rows, ["item_id"], page=3, limit=50)


@query(
    "page_metadata",
    """select count(*) as total, cast(ceil(count(*)/50.0) as bigint) as total_pages
    from si_item where valid='Y'""",
    "si_item",
)
def page_metadata(spark, folder):
    return paging.page_meta(views(spark, folder)("si_item").filter("valid = 'Y'"), 50)


@query(
    "stored_page",
    """with o as (select *, row_number() over (order by o_orderdate, o_orderkey)-1 as pos from orders),
    f as (select *, row_number() over (order by pos)-1 as r from o where o_orderstatus='F')
    select 'all' as list, o_orderkey, o_totalprice, (select count(*) from o) as total_count from o
    where pos>=(select count(*)//2//50*50 from o) and pos<(select count(*)//2//50*50+50 from o)
    union all select 'F', o_orderkey, o_totalprice, (select count(*) from f) from f
    where r>=(select count(*)//100*50 from f) and r<(select count(*)//100*50+50 from f)""",
)
def stored_page(spark, folder):
    # The page in the middle of all orders by date, and the one in the middle of the finished ones.
    orders = views(spark, folder)("orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    path = f"{run_dir(spark)}/list-{uuid.uuid4().hex}"
    stored = store_list(orders, path, ["o_orderdate", "o_orderkey"])
    finished = _c("o_orderstatus") == "F"
    stored.count_where("finished", finished)
    middle = stored.total() // 2 // 50 + 1
    done = stored.page(1, 50, "finished", finished).first()["total_count"]
    shown = stored.page(middle, 50).withColumn("list", F.lit("all")).unionByName(
        stored.page(done // 100 + 1, 50, "finished", finished).withColumn("list", F.lit("F"))
    )
    return shown.select("list", "o_orderkey", "o_totalprice", "total_count")


@query(
    "direction_sort",
    """select punch_type, emp_id, ref_id, row_number() over (partition by punch_type
    order by emp_id nulls first, punch_time, ref_id) - 1 as pos from si_punch where punch_type='I'
    union all select punch_type, emp_id, ref_id, row_number() over (partition by punch_type
    order by emp_id desc nulls first, punch_time desc, ref_id desc) - 1 from si_punch
    where punch_type='O'""",
    "si_punch",
)
def direction_sort(spark, folder):
    # The order key of one kind is negated, so one ascending order serves both.
    punches = views(spark, folder)("si_punch")
    sign = lookup(_c("punch_type"), {"I": 1, "O": -1})
    keyed = punches.select(
        "punch_type",
        "emp_id",
        "ref_id",
        (sign * _c("emp_id")).alias("k1"),
        (sign * F.unix_micros(_c("punch_time").cast("timestamp"))).alias("k2"),
        (sign * _c("ref_id")).alias("k3"),
    )
    parts = [
        batching.with_position(keyed.filter(_c("punch_type") == kind), ["k1", "k2", "k3"])
        for kind in ("I", "O")
    ]
    return parts[0].unionByName(parts[1]).select("punch_type", "emp_id", "ref_id", "pos")


@query(
    "dense_batch_number",
    """select trans_id, cast((row_number() over (order by trans_id)-1)//200+1 as bigint) as batch_no,
    least(((row_number() over (order by trans_id)-1)//200+1)*200, count(*) over ())
    -((row_number() over (order by trans_id)-1)//200)*200 as batch_size,
    (((row_number() over (order by trans_id)-1)//200)*200+1)||'-'||
    least(((row_number() over (order by trans_id)-1)//200+1)*200, count(*) over ()) as record_range,
    cast(ceil(count(*) over ()/200.0) as bigint) as total_batches,
    (row_number() over (order by trans_id)-1)//200+1=cast(ceil(count(*) over ()/200.0) as bigint)
    as last_batch from si_journal""",
    "si_journal",
)
def dense_batch_number(spark, folder):
    batches = batching.assign_batches(
        views(spark, folder)("si_journal").select("trans_id"), ["trans_id"], 200
    )
    return batches.select(
        "trans_id",
        "batch_no",
        "batch_size",
        "record_range",
        "total_batches",
        (_c("batch_no") == _c("total_batches")).alias("last_batch"),
    )


@query(
    "final_row_mark",
    """select doc_num, bp_id, row_number() over (order by bp_id desc, doc_num desc)=1 as batch_end
    from si_invoice""",
    "si_invoice",
)
def final_row_mark(spark, folder):
    rows = views(spark, folder)("si_invoice").select("doc_num", "bp_id")
    return batching.mark_end(rows, ["bp_id", "doc_num"])


@query(
    "delivery_plan",
    """select batch_no, count(*) as batch_size, min(rn)||'-'||max(rn) as record_range,
    max(total_batches) as total_batches, max(rn)=max(total) as is_last from (
    select (row_number() over (order by bp_id)-1)//25+1 as batch_no,
    row_number() over (order by bp_id) as rn, count(*) over () as total,
    cast(ceil(count(*) over ()/25.0) as bigint) as total_batches from si_partner
    left join si_status on cast(bp_id as varchar)=record_key
    where coalesce(push_status,'Pending')<>'Pushed') group by batch_no""",
    "si_partner si_status",
)
def delivery_plan(spark, folder):
    waiting = partner_states(views(spark, folder)).filter("push_status <> 'Pushed'")
    return batching.delivery_plan(waiting, 25)

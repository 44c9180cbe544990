"""Aggregations, rankings and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from outledger.functions import dates
from outledger.functions.choose import classify_like
from outledger.operators import aggregates as agg
from outledger.operators import joins, ranking
from outledger.operators.delivery import classify_response
from outledger.operators.filters import contained, split_valid, valid_at
from outledger.operators.nesting import ChildList, nest_lists
from outledger.operators.paging import overlay_status
from outledger.queries.registry import query
from outledger.queries.views import AS_OF, views

_c = F.col

# A complete tie-break for price rows of the preferred source.
PRICE_ORDER = ["book_id", "line_id", "price", "supp_id"]


def partner_states(v, master="partners"):
    """Partners with their current delivery state."""
    status = v("si_status").withColumn("master_type", F.lit(master))
    return overlay_status(v("si_partner"), status, "bp_id", master)


@query(
    "group_counts",
    "select trans_type, cast(n as bigint) as n from (select trans_type, count(*) as n from si_journal group by 1)",
    "si_journal",
)
def group_counts(spark, folder):
    return agg.group_count(views(spark, folder)("si_journal"), "trans_type")


@query(
    "price_summary",
    """select item_id, brand, grp, count(*) as price_entries, count(distinct state_id) as state_count,
    cast(min(price) as double) as min_price, cast(max(price) as double) as max_price
    from si_price_a join si_item using (item_id) group by all""",
    "si_price_a si_item",
)
def price_summary(spark, folder):
    v = views(spark, folder)
    summary = agg.price_summary(v("si_price_a"), ["item_id"], "state_id", "price")
    return joins.inner(summary, v("si_item").select("item_id", "brand", "grp"), "item_id")


@query(
    "sum_cast",
    """select item_id, cast(trunc(sum(on_hand)) as bigint) as stock_quantity from si_stock
    group by item_id""",
    "si_stock",
)
def sum_cast(spark, folder):
    return agg.sum_whole(views(spark, folder)("si_stock"), ["item_id"], "on_hand", "stock_quantity")


@query(
    "receivable_summary",
    f"""select bp_id, max(bp_name) as bp_name, max(city) as city, max(state) as state,
    count(*) as entries, cast(sum(balance) as double) as total_balance,
    cast(max(case when balance>0 then date_diff('day', case when trans_type in ('-2','30')
    then due_date else ref_date end, timestamp '{AS_OF}') else 0 end) as int) as max_overdue
    from si_journal_line join si_journal using (trans_id) join si_partner using (bp_id)
    left join (select * from si_address where addr_type='B') using (bp_id)
    where balance<>0 group by bp_id""",
    "si_journal_line si_journal si_partner si_address",
)
def receivable_summary(spark, folder):
    # Lines are reduced per document, then per partner, before anything is joined to them.
    v = views(spark, folder)
    owed = v("si_journal_line").filter("balance <> 0")
    per_doc = owed.groupBy("trans_id").agg(
        F.count("*").alias("entries"),
        F.sum("balance").alias("total"),
        F.min(F.when(_c("balance") > 0, _c("due_date"))).alias("first_due"),
        F.max(F.when(_c("balance") <= 0, 0)).alias("no_claim"),
        F.max(_c("balance") > 0).alias("claim"),
    )
    docs = per_doc.join(v("si_journal"), "trans_id")
    due = dates.effective_due(_c("trans_type"), _c("first_due"), _c("ref_date"))
    late = F.when(_c("claim"), F.datediff(dates.moment(AS_OF), due))
    per_partner = docs.groupBy("bp_id").agg(
        F.sum("entries").alias("entries"),
        F.sum("total").alias("total_balance"),
        F.max(F.greatest(late, "no_claim")).alias("max_overdue"),
    )
    billing = (
        v("si_address")
        .filter("addr_type = 'B'")
        .groupBy("bp_id")
        .agg(
            F.max("city").alias("city"),
            F.max("state").alias("state"),
            F.count("*").alias("copies"),
        )
    )
    copies = F.coalesce("copies", F.lit(1))
    return (
        per_partner.join(v("si_partner").select("bp_id", "bp_name"), "bp_id")
        .join(billing, "bp_id", "left")
        .select(
            "bp_id",
            "bp_name",
            "city",
            "state",
            (_c("entries") * copies).alias("entries"),
            (_c("total_balance") * copies).alias("total_balance"),
            "max_overdue",
        )
    )


@query(
    "scheme_summary",
    """select scheme_id, 'P'||scheme_id as policy_number, max(case when brand like '%#1%' then 'EAST'
    when brand like '%#2%' then 'WEST' end) as division, max(basis) as basis,
    strftime(from_date,'%Y-%m-%d') as from_day, strftime(to_date,'%Y-%m-%d') as to_day,
    count(distinct line_no) as line_count from si_scheme join si_scheme_line using (scheme_id)
    where from_date>=timestamp '1997-01-01' and to_date<=timestamp '1998-12-31'
    group by scheme_id, from_date, to_date""",
    "si_scheme si_scheme_line",
)
def scheme_summary(spark, folder):
    v = views(spark, folder)
    window = contained(
        v("si_scheme"),
        "from_date",
        "to_date",
        dates.moment("1997-01-01 00:00:00"),
        dates.moment("1998-12-31 00:00:00"),
    )
    division = classify_like(_c("brand"), [("%#1%", "EAST"), ("%#2%", "WEST")])
    lines = v("si_scheme_line").groupBy("scheme_id").agg(
        F.max(division).alias("division"), F.count_distinct("line_no").alias("line_count")
    )
    return window.join(lines, "scheme_id").select(
        "scheme_id",
        F.concat(F.lit("P"), "scheme_id").alias("policy_number"),
        "division",
        "basis",
        dates.date_text(_c("from_date")).alias("from_day"),
        dates.date_text(_c("to_date")).alias("to_day"),
        "line_count",
    )


@query(
    "distinct_rows",
    """select distinct i.item_id, brand, grp, style from si_item i join si_price_a using (item_id)""",
    "si_item si_price_a",
)
def distinct_rows(spark, folder):
    # The join only multiplies rows that DISTINCT folds again, so it is a semi-join.
    v = views(spark, folder)
    items = joins.where_exists(v("si_item"), v("si_price_a"), "item_id")
    return agg.distinct_rows(items.select("item_id", "brand", "grp", "style"))


@query("group_by_dedupe", "select grp, style, brand from si_item group by all", "si_item")
def group_by_dedupe(spark, folder):
    return agg.group_dedupe(views(spark, folder)("si_item"), "grp", "style", "brand")


@query(
    "distinct_keys_base",
    """select coalesce(push_status,'Pending') as push_status, count(*) as n from
    (select distinct item_id from si_price_a) left join si_status
    on cast(item_id as varchar)=record_key group by 1""",
    "si_price_a si_status",
)
def distinct_keys_base(spark, folder):
    v = views(spark, folder)
    base = agg.group_dedupe(v("si_price_a"), "item_id")
    status = v("si_status").withColumn("master_type", F.lit("prices"))
    return agg.group_count(overlay_status(base, status, "item_id", "prices"), "push_status")


@query(
    "zero_filled_rollup",
    """select s as push_status, coalesce(n,0) as n from
    (values ('Pending'),('Pushing'),('Pushed'),('Failed'),('Cancelled')) t(s) left join
    (select coalesce(push_status,'Pending') as p, count(*) as n from si_partner
    left join si_status on cast(bp_id as varchar)=record_key group by 1) on p=s""",
    "si_partner si_status",
)
def zero_filled_rollup(spark, folder):
    states = ("Pending", "Pushing", "Pushed", "Failed", "Cancelled")
    return agg.status_rollup(partner_states(views(spark, folder)), "push_status", states)


@query(
    "pivot_rollup",
    """select case when punch_type='I' then 'checkin' else 'checkout' end as stat_group,
    count(*) filter (status='Pending') as n_pending, count(*) filter (status='Pushed') as n_pushed,
    count(*) filter (status='Failed') as n_failed, count(*) as total from (select punch_type,
    coalesce(push_status,'Pending') as status from si_punch left join si_status
    on cast(emp_id as varchar)=record_key) group by 1""",
    "si_punch si_status",
)
def pivot_rollup(spark, folder):
    v = views(spark, folder)
    status = v("si_status").withColumn("master_type", F.lit("ehr"))
    log = overlay_status(v("si_punch"), status, "emp_id", "ehr")
    group = F.when(_c("punch_type") == "I", "checkin").otherwise("checkout").alias("stat_group")
    return agg.pivot_rollup(log, group, "push_status")


_OK_SQL = """(http_status between 200 and 299
 and not coalesce(contains(lower(body),'"errorcode"') or contains(lower(body),'"errormessage"')
 or contains(lower(body),'"exceptionmessage"')
 or json_extract_string(body,'$.success')='false', false))"""


@query(
    "delivery_counts",
    f"""select run_day, count(*) as total_batches, cast(sum(size) as bigint) as total_records,
    count(*) filter (ok) as success_batches, count(*) filter (not ok) as failed_batches,
    cast(coalesce(sum(size) filter (ok),0) as bigint) as success_records,
    cast(coalesce(sum(size) filter (not ok),0) as bigint) as failed_records from
    (select run_day, {_OK_SQL} as ok, attempt as size from si_response) group by run_day""",
    "si_response",
)
def delivery_counts(spark, folder):
    replies = classify_response(views(spark, folder)("si_response"))
    return agg.delivery_counts(replies, ["run_day"], "ok", "attempt")


@query(
    "failed_key_list",
    f"""select run_day, record_key as failed_key, ok_keys, failed_keys from
    (select run_day, record_key from si_response where not {_OK_SQL} group by all)
    join (select run_day, count(distinct record_key) filter ({_OK_SQL}) as ok_keys,
    count(distinct record_key) filter (not {_OK_SQL}) as failed_keys from si_response
    group by run_day) using (run_day)""",
    "si_response",
)
def failed_key_list(spark, folder):
    replies = classify_response(views(spark, folder)("si_response"))
    counts = replies.groupBy("run_day").agg(
        F.count_distinct(F.when(_c("ok"), _c("record_key"))).alias("ok_keys"),
        F.count_distinct(F.when(~_c("ok"), _c("record_key"))).alias("failed_keys"),
    )
    failed = replies.filter(~_c("ok")).select("run_day", "record_key").distinct()
    lists = nest_lists({"keys": ChildList(failed, ["record_key"], ["record_key"])}, "run_day")
    return (
        lists.join(counts, "run_day")
        .select("run_day", F.explode("keys").alias("k"), "ok_keys", "failed_keys")
        .select("run_day", _c("k.record_key").alias("failed_key"), "ok_keys", "failed_keys")
    )


@query(
    "unify_counts",
    """select dataset, coalesce(total_db_rows, db_rows_fetched, total_records) as total_count,
    coalesce(total_success, success_count, success_records) as ok_count,
    coalesce(total_failed, failed_count, failed_records, failed_batches) as bad_count from (
    select trans_type as dataset, case when trans_type='13' then count(*) end as total_db_rows,
    case when trans_type='30' then count(*) end as db_rows_fetched, count(*) as total_records,
    case when trans_type='13' then count(*) filter (bp_id>=100) end as total_success,
    null::bigint as success_count, count(*) filter (bp_id>=100) as success_records,
    null::bigint as total_failed, null::bigint as failed_count,
    case when trans_type<>'30' then count(*) filter (bp_id<100) end as failed_records,
    1::bigint as failed_batches from si_journal group by trans_type)""",
    "si_journal",
)
def unify_counts(spark, folder):
    kind, n = _c("trans_type"), F.count("*")
    ok, bad = F.count_if(_c("bp_id") >= 100), F.count_if(_c("bp_id") < 100)
    none = F.lit(None).cast("bigint")
    runs = views(spark, folder)("si_journal").groupBy(kind.alias("dataset")).agg(
        F.when(kind == "13", n).alias("total_db_rows"),
        F.when(kind == "30", n).alias("db_rows_fetched"),
        n.alias("total_records"),
        F.when(kind == "13", ok).alias("total_success"),
        none.alias("success_count"),
        ok.alias("success_records"),
        none.alias("total_failed"),
        none.alias("failed_count"),
        F.when(kind != "30", bad).alias("failed_records"),
        F.lit(1).cast("bigint").alias("failed_batches"),
    )
    unified = agg.unify_counts(
        runs,
        ["total_db_rows", "db_rows_fetched", "total_records"],
        ["total_success", "success_count", "success_records"],
        ["total_failed", "failed_count", "failed_records", "failed_batches"],
    )
    return unified.select("dataset", "total_count", "ok_count", "bad_count")


# ---- rankings and unions ---------------------------------------------------------

_SOURCES_SQL = f"""select item_id, state_id, book_id, line_id, price, supp_id, 1 as source_priority
 from si_price_a where timestamp '{AS_OF}' between valid_from and valid_to
 union all select item_id, state_id, book_id, line_id, price, 0, 2 from si_price_b"""


def price_sources(v):
    """Preferred and fallback prices in one shape."""
    columns = ["item_id", "state_id", "book_id", "line_id", "price", "supp_id"]
    preferred = valid_at(v("si_price_a"), "valid_from", "valid_to", dates.moment(AS_OF))
    fallback = v("si_price_b").withColumn("supp_id", F.lit(0).cast("bigint"))
    return [preferred.select(*columns), fallback.select(*columns)]


@query(
    "union_all",
    f"""select item_id, state_id, book_id, line_id, cast(price as double) as price,
    cast(supp_id as bigint) as supp_id, source_priority from ({_SOURCES_SQL})""",
    "si_price_a si_price_b",
)
def union_all(spark, folder):
    return ranking.union_sources(price_sources(views(spark, folder)))


@query(
    "source_priority",
    f"""select item_id, state_id, book_id, line_id, cast(price as double) as price, source_priority
    from (select *, row_number() over (partition by item_id, state_id
    order by source_priority, book_id, line_id, price, supp_id) as rn from ({_SOURCES_SQL}))
    where rn=1""",
    "si_price_a si_price_b",
)
def source_priority(spark, folder):
    sources = price_sources(views(spark, folder))
    best = ranking.prefer(sources, ["item_id", "state_id"], PRICE_ORDER)
    return best.drop("supp_id")


@query(
    "first_line_per_doc",
    f"""select scheme_id, line_no, item_id, brand from (select *, row_number() over
    (partition by scheme_id order by line_no, item_id, supp_id, price) as rn
    from si_scheme join si_scheme_line using (scheme_id)
    where timestamp '{AS_OF}' between from_date and to_date) where rn=1""",
    "si_scheme si_scheme_line",
)
def first_line_per_doc(spark, folder):
    v = views(spark, folder)
    valid = valid_at(v("si_scheme"), "from_date", "to_date", dates.moment(AS_OF))
    lines = joins.inner(v("si_scheme_line"), valid, "scheme_id")
    first = ranking.first_by(lines, ["scheme_id"], ["line_no", "item_id", "supp_id", "price"])
    return first.select("scheme_id", "line_no", "item_id", "brand")


@query(
    "first_per_composite",
    """select scheme_id, grp, style, line_no, item_id from (select *, row_number() over
    (partition by scheme_id, grp, style order by line_no, item_id, supp_id, price) as rn
    from si_scheme_line) where rn=1""",
    "si_scheme_line",
)
def first_per_composite(spark, folder):
    first = ranking.first_by(
        views(spark, folder)("si_scheme_line"),
        ["scheme_id", "grp", "style"],
        ["line_no", "item_id", "supp_id", "price"],
    )
    return first.select("scheme_id", "grp", "style", "line_no", "item_id")


@query(
    "extreme_per_day",
    """select emp_id, punch_type, cast(punch_time as date) as punch_day,
    case when punch_type='I' then arg_min(ref_id, (punch_time, ref_id))
    else arg_max(ref_id, (punch_time, ref_id)) end as ref_id,
    strftime(case when punch_type='I' then min(punch_time) else max(punch_time) end,
    '%Y-%m-%d %H:%M:%S') as punch_time from si_punch where emp_id is not null
    group by emp_id, punch_type, cast(punch_time as date)""",
    "si_punch",
)
def extreme_per_day(spark, folder):
    good, _ = split_valid(views(spark, folder)("si_punch"), ["emp_id", "punch_time"])
    return ranking.extreme_per_day(good, person="emp_id")



"""Scans, lookups, slices and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from outledger.functions import choose
from outledger.functions.dates import moment
from outledger.operators import filters as flt
from outledger.operators import joins, search
from outledger.queries.registry import query
from outledger.queries.views import AS_OF, views
from outledger.session import run_dir
from outledger.sources import tables as src

SEGMENTS = [
    ("HOUSEHOLD", "Retail", 1),
    ("BUILDING", "Projects", 2),
    ("MACHINERY", "Projects", 3),
    ("FURNITURE", "Retail", 4),
]


@query("scan_table", "select * replace (strftime(o_orderdate,'%Y-%m-%d %H:%M:%S') as o_orderdate) from orders")
def scan_table(spark, folder):
    return views(spark, folder)("orders")


@query(
    "inline_lookup",
    """select grp, division, seq, count(*) as n from si_partner
    join (values ('HOUSEHOLD','Retail',1),('BUILDING','Projects',2),('MACHINERY','Projects',3),
    ('FURNITURE','Retail',4)) t(segment, division, seq) on grp=segment group by all""",
    "si_partner",
)
def inline_lookup(spark, folder):
    lookup = src.inline_lookup(spark, SEGMENTS, "grp string, division string, seq int")
    counts = views(spark, folder)("si_partner").groupBy("grp").agg(F.count("*").alias("n"))
    return joins.inner(counts, lookup, "grp").select("grp", "division", "seq", "n")


@query(
    "scan_by_keys",
    """select bp_id, bp_name, grp, area, state_id from si_partner
    where bp_id in (select record_key from si_status_event where status='Failed')""",
    "si_partner si_status_event",
)
def scan_by_keys(spark, folder):
    v = views(spark, folder)
    keys = v("si_status_event").filter("status = 'Failed'").select(
        F.col("record_key").alias("bp_id")
    )
    return src.by_keys(v("si_partner"), keys, "bp_id").select(
        "bp_id", "bp_name", "grp", "area", "state_id"
    )


@query(
    "point_lookup",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey=1000",
)
def point_lookup(spark, folder):
    row = src.by_id(views(spark, folder)("orders"), "o_orderkey", 1000)
    return row.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "today_slice",
    """select ref_id, emp_id, strftime(punch_time,'%Y-%m-%d %H:%M:%S') as punch_time from si_punch
    where punch_type='I' and cast(punch_time as date)=date '2024-01-15'""",
    "si_punch",
)
def today_slice(spark, folder):
    rows = src.day_slice(
        views(spark, folder)("si_punch"), "punch_time", "2024-01-15", F.col("punch_type") == "I"
    )
    return rows.select("ref_id", "emp_id", "punch_time")


@query(
    "constant_extract",
    """select item_id as sku_code, style as color_code, '' as file_name, '' as description,
    '' as base64_data from si_item where grp in ('ECONOMY')""",
    "si_item",
)
def constant_extract(spark, folder):
    return src.extract(
        views(spark, folder)("si_item"),
        F.col("grp").isin("ECONOMY"),
        {
            "sku_code": F.col("item_id"),
            "color_code": F.col("style"),
            "file_name": "",
            "description": "",
            "base64_data": "",
        },
    )


@query(
    "distinct_values",
    """select distinct rtrim(area) as area from si_partner
    where area is not null and rtrim(area)<>'' order by area""",
    "si_partner",
)
def distinct_values(spark, folder):
    return src.distinct_values(views(spark, folder)("si_partner"), "area")


@query(
    "suggest_values",
    """select distinct brand from si_item where valid='Y'
    and contains(lower(brand), trim(lower(' BRAND#1 ')))""",
    "si_item",
)
def suggest_values(spark, folder):
    values = src.distinct_values(
        views(spark, folder)("si_item"), "brand", F.col("valid") == "Y"
    )
    return src.suggest(values, "brand", " BRAND#1 ")


@query("chunked_extract", "select item_id, item_name, brand from si_item order by item_id", "si_item")
def chunked_extract(spark, folder):
    return src.extract_all(
        views(spark, folder)("si_item").select("item_id", "item_name", "brand"), "item_id"
    )


# ---- projections and filters -----------------------------------------------------


@query(
    "rename_project",
    """select item_id as product_code, item_name as product_name, grp as group_code,
    grp as short_desc, 'Stock' as record_type, 0 as popularity from si_item""",
    "si_item",
)
def rename_project(spark, folder):
    return src.extract(
        views(spark, folder)("si_item"),
        F.lit(True),
        {
            "product_code": F.col("item_id"),
            "product_name": F.col("item_name"),
            "group_code": F.col("grp"),
            "short_desc": F.col("grp"),
            "record_type": "Stock",
            "popularity": F.lit(0),
        },
    )


@query(
    "case_flag",
    """select item_id, case when valid='Y' then 1 else 0 end as is_active, valid='Y' as active
    from si_item""",
    "si_item",
)
def case_flag(spark, folder):
    return views(spark, folder)("si_item").select(
        "item_id",
        choose.flag(F.col("valid")).alias("is_active"),
        choose.flag_bool(F.col("valid")).alias("active"),
    )


@query(
    "pattern_class",
    """select doc_num, case when brand like '%#1%' then 'EAST' when brand like '%#2%' then 'WEST'
    end as division, case when brand like '%#1%' then 'EAST' else 'WEST' end as division_or_default
    from si_invoice""",
    "si_invoice",
)
def pattern_class(spark, folder):
    brand = F.col("brand")
    return views(spark, folder)("si_invoice").select(
        "doc_num",
        choose.classify_like(brand, [("%#1%", "EAST"), ("%#2%", "WEST")]).alias("division"),
        choose.classify_like(brand, [("%#1%", "EAST")], "WEST").alias("division_or_default"),
    )


@query(
    "exact_class",
    """select scheme_id, case basis when 'Quantity' then 'SC' when 'Percentage' then 'DIS' end
    as saving_type from si_scheme""",
    "si_scheme",
)
def exact_class(spark, folder):
    kinds = {"Quantity": "SC", "Percentage": "DIS"}
    return views(spark, folder)("si_scheme").select(
        "scheme_id", choose.lookup(F.col("basis"), kinds).alias("saving_type")
    )


@query(
    "conditional_source",
    """select item_id, case when brand='Brand#4' then 'CAT-'||style else item_name end as shown_name
    from si_item""",
    "si_item",
)
def conditional_source(spark, folder):
    shown = choose.pick(
        F.col("brand") == "Brand#4", F.concat(F.lit("CAT-"), F.col("style")), F.col("item_name")
    )
    return views(spark, folder)("si_item").select("item_id", shown.alias("shown_name"))


@query(
    "exclude_list",
    """select doc_num, brand from si_invoice
    where rtrim(brand) not in ('Brand#3','Brand#4','Brand#7')""",
    "si_invoice",
)
def exclude_list(spark, folder):
    rows = views(spark, folder)("si_invoice").withColumn("key", F.rtrim("brand"))
    return flt.exclude_values(rows, "key", ["Brand#3", "Brand#4", "Brand#7"]).select(
        "doc_num", "brand"
    )


@query(
    "include_list",
    "select trans_id, trans_type from si_journal where trans_type in ('-2','30')",
    "si_journal",
)
def include_list(spark, folder):
    rows = flt.include_values(views(spark, folder)("si_journal"), "trans_type", ["-2", "30"])
    return rows.select("trans_id", "trans_type")


@query("not_blank", "select bp_id, area from si_partner where rtrim(area)<>''", "si_partner")
def not_blank(spark, folder):
    return flt.not_blank(views(spark, folder)("si_partner"), "area").select("bp_id", "area")


@query(
    "valid_at",
    f"""select item_id, state_id, book_id, line_id, price from si_price_a
    where timestamp '{AS_OF}' between valid_from and valid_to""".replace(
        "line_id, price", "line_id, cast(price as double) as price"
    ),
    "si_price_a",
)
def valid_at(spark, folder):
    rows = flt.valid_at(
        views(spark, folder)("si_price_a"), "valid_from", "valid_to", moment(AS_OF)
    )
    return rows.select("item_id", "state_id", "book_id", "line_id", "price")


@query(
    "window_contained",
    """select scheme_id, basis from si_scheme
    where from_date>=timestamp '1997-01-01' and to_date<=timestamp '1998-12-31'""",
    "si_scheme",
)
def window_contained(spark, folder):
    rows = flt.contained(
        views(spark, folder)("si_scheme"),
        "from_date",
        "to_date",
        moment("1997-01-01 00:00:00"),
        moment("1998-12-31 00:00:00"),
    )
    return rows.select("scheme_id", "basis")


@query(
    "optional_filters",
    """select bp_id, bp_name, grp, push_status from (select bp_id, bp_name, grp, area,
    coalesce(push_status,'Pending') as push_status from si_partner
    left join si_status on cast(bp_id as varchar)=record_key)
    where (bp_name ilike '%00001%' or area ilike '%00001%') and push_status='Pending'
    and grp='HOUSEHOLD'""",
    "si_partner si_status",
)
def optional_filters(spark, folder):
    from outledger.operators.paging import overlay_status

    v = views(spark, folder)
    status = v("si_status").withColumn("master_type", F.lit("partners"))
    base = overlay_status(v("si_partner"), status, "bp_id", "partners")
    spec = flt.FilterSpec(
        search="00001",
        status="Pending",
        group="HOUSEHOLD",
        search_in=("bp_name", "area"),
        columns={"status": "push_status", "group": "grp"},
    )
    return flt.apply_filters(base, spec).select("bp_id", "bp_name", "grp", "push_status")


@query(
    "trigram_search",
    """select 'OLT' as needle, item_id, item_name, brand from si_item where item_name ilike '%OLT%' or brand ilike '%OLT%'
    union all select 'brand#1', item_id, item_name, brand from si_item
    where item_name ilike '%brand#1%' or brand ilike '%brand#1%'
    union all select '#2', item_id, item_name, brand from si_item where item_name ilike '%#2%' or brand ilike '%#2%'""",
    "si_item",
)
def trigram_search(spark, folder):
    items = views(spark, folder)("si_item").select("item_id", "item_name", "brand")
    path, columns = f"{run_dir(spark)}/postings-{uuid.uuid4().hex}", ["item_name", "brand"]
    search.store_postings(items, "item_id", columns, path)
    needles = ("OLT", "brand#1", "#2")  # the last one is too short for a trigram
    found = [search.search(spark, items, "item_id", columns, n, path).withColumn("needle", F.lit(n)) for n in needles]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "contains_search",
    "select item_id, item_name, brand from si_item where item_name ilike '%OLT%' or brand ilike '%OLT%'",
    "si_item",
)
def contains_search(spark, folder):
    rows = flt.search(views(spark, folder)("si_item"), ["item_name", "brand"], "OLT")
    return rows.select("item_id", "item_name", "brand")


@query(
    "date_range",
    """select ref_id, emp_id from si_punch
    where cast(punch_time as date) between date '2024-01-10' and date '2024-01-12'""",
    "si_punch",
)
def date_range(spark, folder):
    rows = flt.date_between(
        views(spark, folder)("si_punch"), "punch_time", "2024-01-10", "2024-01-12"
    )
    return rows.select("ref_id", "emp_id")


@query(
    "positive_only",
    """select item_id, whs, cast(on_hand as double) as on_hand from si_stock
    where cast(trunc(on_hand) as int) > 100""",
    "si_stock",
)
def positive_only(spark, folder):
    return flt.above(views(spark, folder)("si_stock"), "on_hand", 100, cast="int")


@query(
    "digits_only",
    """select trans_id, line_no, item_id, ref1,
    coalesce(regexp_full_match(ref1,'[0-9]+'),false) as digits from si_journal_line""",
    "si_journal_line",
)
def digits_only(spark, folder):
    from outledger.functions.text import is_digits

    return views(spark, folder)("si_journal_line").select(
        "trans_id", "line_no", "item_id", "ref1", is_digits(F.col("ref1")).alias("digits")
    )


@query(
    "nonzero_balance",
    """select trans_id, line_no, cast(balance as double) as balance from si_journal_line
    where balance<>0""",
    "si_journal_line",
)
def nonzero_balance(spark, folder):
    rows = flt.nonzero(views(spark, folder)("si_journal_line"), "balance")
    return rows.select("trans_id", "line_no", "balance")


@query(
    "missing_key_reject",
    """select 'accepted' as outcome, null as reason, count(*) as n from si_punch
    where emp_id is not null and punch_time is not null
    union all select 'rejected', case when emp_id is null then 'emp_id' else 'punch_time' end,
    count(*) from si_punch where emp_id is null or punch_time is null group by all""",
    "si_punch",
)
def missing_key_reject(spark, folder):
    good, bad = flt.split_valid(views(spark, folder)("si_punch"), ["emp_id", "punch_time"])
    accepted = good.agg(F.count("*").alias("n")).select(
        F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("reason"), "n"
    )
    rejected = bad.groupBy("reason").agg(F.count("*").alias("n")).select(
        F.lit("rejected").alias("outcome"), "reason", "n"
    )
    return accepted.unionByName(rejected)
